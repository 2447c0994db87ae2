"""SRC-1: named tables, and views derived from them by SQL.

A *binding* maps each logical table an operator expects (for example
``practice_locations``) to a SQL template over physical tables and other
views, written with ``{name}`` placeholders.  Spark resolves a placeholder to
a registered scan of the table (or to the sub-query of another view) and runs
it with ``spark.sql`` — Catalyst prunes columns and pushes filters into the
parquet scans.  The DuckDB oracle resolves the same text to CTEs, so both
sides derive identical inputs from the driver tables.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

_PLACEHOLDER = re.compile(r"\{([a-z_][a-z0-9_]*)\}")


def _refs(template: str) -> list[str]:
    return list(dict.fromkeys(_PLACEHOLDER.findall(template)))


class Catalog:
    """Tables under one folder plus named derived views."""

    def __init__(self, spark: SparkSession, root: str, views: dict[str, str] | None = None,
                 fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.views = dict(views or {})
        self._tag = hashlib.sha1(self.root.encode()).hexdigest()[:8]
        self._tables: dict[str, DataFrame] = {}
        self._view_dfs: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.{self.fmt}"

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.format(self.fmt).load(self.path(name))
        return self._tables[name]

    def table_ref(self, name: str) -> str:
        view = f"sluice_{self._tag}_{name}"
        self.table(name).createOrReplaceTempView(view)
        return view

    def _resolve(self, name: str) -> str:
        template = self.views[name]
        subs = {}
        for ref in _refs(template):
            subs[ref] = f"({self._resolve(ref)}) AS {ref}" if ref in self.views else f"{self.table_ref(ref)} AS {ref}"
        return _PLACEHOLDER.sub(lambda m: subs[m.group(1)], template)

    def view(self, name: str) -> DataFrame:
        if name not in self.views:
            return self.table(name)
        if name not in self._view_dfs:
            self._view_dfs[name] = self.spark.sql(self._resolve(name))
        return self._view_dfs[name]

    def stream_view(self, name: str) -> DataFrame:
        """The view over *streaming* scans of its tables (files of the table
        arriving in the folder); views over other views are not streamed."""
        template = self.views[name]
        subs = {}
        for ref in _refs(template):
            if ref in self.views:
                raise ValueError(f"view {name} reads view {ref}; stream the base view instead")
            schema = self.spark.read.format(self.fmt).load(self.path(ref)).schema
            sdf = (self.spark.readStream.format(self.fmt).schema(schema)
                   .option("pathGlobFilter", f"{ref}.{self.fmt}").load(self.root))
            vname = f"sluice_s_{self._tag}_{ref}"
            sdf.createOrReplaceTempView(vname)
            subs[ref] = f"{vname} AS {ref}"
        return self.spark.sql(_PLACEHOLDER.sub(lambda m: subs[m.group(1)], template))

    def __getitem__(self, name: str) -> DataFrame:
        return self.view(name)


def oracle_with(views: dict[str, str], names: list[str]) -> str:
    """``WITH`` clause for DuckDB defining ``names`` and every view they use."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in views:
            return
        for ref in _refs(views[n]):
            visit(ref)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return ""
    parts = [f"{n} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), views[n])})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n"

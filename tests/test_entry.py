"""Driver contract: entry, query/oracle registry, and every registered query
against its DuckDB oracle on the smallest driver tables."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from sluice.plans import driver

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events benchmark".split()


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _digest(cols, rows_):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows_)).encode()).hexdigest()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "rule_key" in df.columns and df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(driver.QUERIES) == set(driver.ORACLE) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    if not os.path.exists(SF):
        pytest.skip("driver tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(driver.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _digest(s_cols, s_rows) == _digest(o_cols, o_rows)

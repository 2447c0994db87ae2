"""SRC-4 / SRC-6: folder listings and line reads of chosen files.

``list_files`` is a Spark data source over a folder tree: the driver names
the folders of the first level only, one partition each, and the tasks list
what lies below.  Unlike Spark's file sources it also lists empty files.
``read_lines`` reads the lines of files that a DataFrame names, so which files are
opened follows from the data (newest file per run, files of some runs) and
no list passes through the driver; large files are read in byte ranges.

File systems are pyarrow's (local, HDFS, S3, GCS).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluice.session import ship_package

RANGE_BYTES = 64 << 20
BATCH_LINES = 20_000
LISTING = "path string, size long, modified_at timestamp"


def _opened(path: str):
    """(file system, its path) of a URI or a plain absolute path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool) -> None:
        self.path, self.deep = path, deep


class FolderReader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    def partitions(self) -> list[_Folder]:
        from pyarrow import fs

        system, path = _opened(self.root)
        below = system.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True))
        return [_Folder(path, False), *(_Folder(x.path, True) for x in below if x.type == fs.FileType.Directory)]

    def read(self, part: _Folder) -> Iterator[tuple]:
        from pyarrow import fs

        system, _ = _opened(self.root)
        waiting = [part.path]
        while waiting:
            for x in system.get_file_info(fs.FileSelector(waiting.pop(), recursive=False, allow_not_found=True)):
                if x.type == fs.FileType.Directory:
                    if part.deep:
                        waiting.append(x.path)
                elif x.type == fs.FileType.File:
                    yield x.path, x.size, x.mtime


class FolderSource(DataSource):
    """Format ``folder``: every file below a path, with its size and time."""

    @classmethod
    def name(cls) -> str:
        return "folder"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (without scheme), ``size``, ``modified_at`` of every file below
    ``root``, empty files included; none if the folder does not exist."""
    ship_package(spark)
    spark.dataSource.register(FolderSource)
    return spark.read.format("folder").load(root)


def _range_lines(source, begin: int, end: int) -> Iterator[tuple[int, str]]:
    """(offset, text) of the lines that start in [begin, end)."""
    at = begin
    if begin:
        source.seek(begin - 1)
        at = begin - 1 + len(_line(source))
    while at < end:
        line = _line(source)
        if not line:
            return
        yield at, line.rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace")
        at += len(line)


def _line(source) -> bytes:
    return source.readline()


def read_lines(files: DataFrame, path: str = "path", size: str = "size", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of the files named by ``files``: its columns, ``offset`` (of the
    line in its file, in bytes) and ``line``.  Bad bytes become U+FFFD."""
    import io

    keep = files.columns
    ship_package(files.sparkSession)
    ranges = files.withColumn("offset", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(size) - 1, F.lit(0)), F.lit(range_bytes))))
    ranges = ranges.where(F.col(size) > 0).repartition(F.xxhash64(path, "offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = [batch.column(c)[k] for c in keep]
                system, name = _opened(batch.column(path)[k].as_py())
                begin = batch.column("offset")[k].as_py()

                def out(lines: list[tuple[int, str]]) -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays(
                        [*(pa.array([v.as_py()] * len(lines), v.type) for v in row), pa.array([x for x, _ in lines], pa.int64()), pa.array([x for _, x in lines], pa.string())],
                        [*keep, "offset", "line"])

                with system.open_input_file(name) as raw, io.BufferedReader(raw, 1 << 20) as source:
                    held = []
                    for line in _range_lines(source, begin, begin + range_bytes):
                        held.append(line)
                        if len(held) >= BATCH_LINES:
                            yield out(held)
                            held = []
                    if held:
                        yield out(held)

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    return ranges.mapInArrow(run, StructType([*files.schema.fields, StructField("offset", LongType()), StructField("line", StringType())]))

"""Source trees: distributed listing, then reading of the files that are wanted.

``binaryFile`` leaves out names that start with ``_``, and with them every
``__init__.py``, so directories are listed by tasks of our own.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import filters
from loomline.session import materialize, qualified
from loomline.sources.files import open_filesystem

_BATCH_BYTES = 16 << 20
_ATTEMPTS = 3
_LISTED = "path string, is_dir boolean, size bigint"
_LISTED_ARROW = pa.schema([("path", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64())])
_CONTENT_ARROW = pa.schema([("path", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("error", pa.string())])


def _list_directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for directory in batch.column(0).to_pylist():
            system, plain = open_filesystem(directory)
            found = system.get_file_info(fs.FileSelector(plain, allow_not_found=True))
            prefix = directory.rstrip("/")
            visible = [i for i in found if not i.base_name.startswith(".")]
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{prefix}/{i.base_name}" for i in visible], pa.string()),
                pa.array([i.type == fs.FileType.Directory for i in visible], pa.bool_()),
                pa.array([i.size for i in visible], pa.int64()),
            ], schema=_LISTED_ARROW)


def list_code_tree(spark: SparkSession, roots: Sequence[str], suffix: str = ".py") -> DataFrame:
    """(path, size) of the visible files below ``roots`` whose names end with ``suffix``.

    One round per directory level. Each round lists its directories in parallel and is
    written once, so nothing is listed twice.
    """
    level = spark.createDataFrame(
        [(qualified(spark, root).rstrip("/"),) for root in roots], "path string")
    found = []
    while not level.isEmpty():
        listed = materialize(level.repartition("path").mapInArrow(_list_directories, _LISTED))
        found.append(listed.where(~F.col("is_dir") & F.endswith("path", F.lit(suffix))))
        level = listed.where("is_dir").select("path")
    return reduce(DataFrame.unionByName, found).select("path", "size")


def _read(path: str) -> tuple[bytes | None, str | None]:
    """Content, or what is wrong after the last attempt. A file that is gone is not tried again."""
    for attempt in range(_ATTEMPTS):
        try:
            system, plain = open_filesystem(path)
            with system.open_input_stream(plain) as stream:
                return stream.readall(), None
        except FileNotFoundError as problem:
            return None, type(problem).__name__
        except OSError as problem:
            error = type(problem).__name__
            time.sleep(0.2 * 2 ** attempt)
    return None, error


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], _CONTENT_ARROW.field(i).type) for i in range(4)],
            schema=_CONTENT_ARROW,
        )

    pending, held = [], 0
    for batch in batches:
        for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            content, error = _read(path)
            pending.append((path, size, content, error))
            held += len(content or b"")
            if held >= _BATCH_BYTES:
                yield emit(pending)
                pending, held = [], 0
    if pending:
        yield emit(pending)


def read_files(listed: DataFrame) -> DataFrame:
    """Add ``content`` to listed files, or ``error`` (and no content) if one can't be read."""
    return listed.select("path", "size").repartition("path").mapInArrow(
        _read_files, "path string, size bigint, content binary, error string"
    )


def scan_code_tree(spark: SparkSession, roots: Sequence[str], suffix: str = ".py",
                   low: int = filters.fv.MIN_FILE_BYTES,
                   high: int = filters.fv.MAX_FILE_BYTES) -> DataFrame:
    """(path, size, content) of source files. Paths and sizes are filtered before any read.

    Files that can't be read are left out; :func:`scan_with_rejects` names them.
    """
    return scan_with_rejects(spark, roots, suffix, low, high)[0]


def scan_with_rejects(spark: SparkSession, roots: Sequence[str], suffix: str = ".py",
                      low: int = filters.fv.MIN_FILE_BYTES,
                      high: int = filters.fv.MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(source files, rejects): rejects are (path, error) of wanted files that could not be read."""
    listed = list_code_tree(spark, roots, suffix)
    wanted = filters.filter_paths(listed).where(filters.byte_size_ok(F.col("size"), low, high))
    read = read_files(wanted)
    good = filters.filter_utf8(read.where("error is null").drop("error"))
    return good, read.where("error is not null").select("path", "error")

"""Helpers that the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import bound_batches, discard, workspace

#: White space that separates words, and the same as a Java or Python pattern.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by exact name.

    Other columns, also some whose names repeat or differ in case only, are left out.
    """
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    places = [df.columns.index(n) for n in names]
    by_place = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return by_place.select(*[F.col(f"_{p}").alias(n) for p, n in zip(places, names)])


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to Parquet in the shared folder and read back: lineage is cut, columns can be pruned."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def kept(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The same for a table that is deleted when the block ends."""
    path = workspace(df.sparkSession, purpose)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        discard(df.sparkSession, path)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts(amount: float, each: float) -> int:
    """Into how many parts of about ``each`` an ``amount`` goes."""
    return max(1, math.ceil(amount / each))


def word_list(text: Column) -> Column:
    """Words of a text that isn't null: runs of other characters than WORD_SPACE."""
    inner = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20, column: str = "text",
           ) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece has about ``size`` bytes of text; a row stays whole."""
    for batch in batches:
        at, held = 0, 0
        lengths = batch.column(column).cast(pa.large_binary())
        for i, value in enumerate(pa.compute.binary_length(lengths).to_pylist()):
            held += value or 0
            if held >= size:
                yield batch.slice(at, i + 1 - at)
                at, held = i + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


def release_memory() -> None:
    """Give back what a Python worker no longer uses: it lives on, idle, beside the next tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Have Spark delete a query's shuffle files when it has ended, from now on, unless the session says otherwise.

    A job of several written tables would else hold the shuffles of all of them until it ends.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.conf.get(name, None) in (None, "false"):
        spark.conf.set(name, "true")


def in_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` in small batches; the worker gives memory back at the end of a task."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    bound_batches(df.sparkSession)
    return df.mapInArrow(wrapped, schema)


def span_digest(spans: Column) -> Column:
    """kind:start:end of an array of such structs, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

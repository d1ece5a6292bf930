"""Sample tables and web-text shards."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.sources.files import open_filesystem


def with_content(df: DataFrame, content_col="content") -> DataFrame:
    """A missing content is the empty string, which the length filter drops later."""
    return df.withColumn(content_col, F.coalesce(content_col, F.lit("")))


def scan_samples(spark: SparkSession, path: str, format: str = "parquet", schema=None,
                 content_col="content") -> DataFrame:
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    return with_content(reader.load(path), content_col)


def combine_sources(local: DataFrame | None, remote: DataFrame | None) -> DataFrame:
    """Local rows and remote rows in one table with their ``origin``; either may be left out."""
    parts = []
    if local is not None:
        parts.append(local.withColumn("origin", F.lit("local")))
    if remote is not None:
        parts.append(remote.withColumn("origin", F.lit("remote")))
    if not parts:
        raise ValueError("no source given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def select_shards(df: DataFrame, shard_col: str, pinned: str, num_shards: int = -1) -> DataFrame:
    """Rows of the first ``num_shards`` shards by name (``train``) and of the pinned one (``val``).

    ``-1`` takes all shards. The choice is made on the distinct names, of which the
    chosen ones are at most ``num_shards``, so that broadcast is bounded.
    """
    split = F.when(F.col(shard_col) == pinned, "val").otherwise("train")
    if num_shards < 0:
        return df.withColumn("split", split)
    names = df.select(shard_col).distinct().where(F.col(shard_col) != pinned)
    chosen = names.orderBy(shard_col).limit(num_shards)
    wanted = df.join(
        F.broadcast(chosen.withColumn("_chosen", F.lit(True))), shard_col, "left"
    )
    return wanted.where(F.col("_chosen") | (F.col(shard_col) == pinned)).drop(
        "_chosen"
    ).withColumn("split", split)


def shard_paths(directory: str, pinned: str, num_shards: int = -1) -> tuple[list[str], str]:
    """(training shard paths, validation shard path) among the parquet files of a folder."""
    system, plain = open_filesystem(directory)
    names = sorted(
        i.base_name for i in system.get_file_info(fs.FileSelector(plain))
        if i.base_name.endswith(".parquet")
    )
    if pinned not in names:
        raise ValueError(f"validation shard {pinned} is missing")
    train = [n for n in names if n != pinned]
    if num_shards >= 0:
        train = train[:num_shards]
    if not train:
        raise ValueError("no training shards")
    base = directory.rstrip("/")
    return [f"{base}/{n}" for n in train], f"{base}/{pinned}"


def read_shards(spark: SparkSession, directory: str, pinned: str, num_shards: int = -1,
                text_col="text") -> DataFrame:
    """Texts of the chosen shards with ``split``, ``shard`` and ``row_no`` in the shard.

    Other shards are not opened.
    """
    train, val = shard_paths(directory, pinned, num_shards)
    rows = spark.read.parquet(*train, val).select(
        F.col(text_col).alias("text"), F.col("_metadata.file_name").alias("shard"),
        F.col("_metadata.row_index").alias("row_no"),
    )
    return rows.withColumn("split", F.when(F.col("shard") == pinned, "val").otherwise("train"))

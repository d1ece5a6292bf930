"""Token datasets on disk: parquet documents, and flat 16-bit part files with a manifest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv
from loomline.functions.hashing import DEFAULT_SEED, HASH_BITS, seeded_hash
from loomline.session import materialize, qualified
from loomline.sources.files import open_filesystem

MAX_TOKEN = 65_535
_MANIFEST = "split string, part int, path string, n_docs bigint, n_tokens bigint"
_MANIFEST_ARROW = pa.schema([
    ("split", pa.string()), ("part", pa.int32()), ("path", pa.string()),
    ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
])


def write_token_table(df: DataFrame, path: str) -> None:
    """Documents as parquet, one folder per split."""
    df.select("doc_id", "split", "tokens", "n_tokens").write.mode("overwrite").partitionBy(
        "split").parquet(path)


def read_token_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _part_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        system, plain = open_filesystem(folder)
        streams, paths, docs, tokens = {}, {}, {}, {}
        for batch in batches:
            splits = np.asarray(batch.column(0).to_pylist(), dtype=object)
            lists = batch.column(1)
            for split in dict.fromkeys(splits):
                chosen = lists.filter(pa.array(splits == split))
                ids = chosen.flatten().to_numpy(zero_copy_only=False)
                if ids.size and (ids.max() > MAX_TOKEN or ids.min() < 0):
                    raise ValueError(f"token id outside 0..{MAX_TOKEN}")
                if split not in streams:
                    # The attempt number keeps a speculative or retried task from
                    # writing into the file of another attempt.
                    name = f"split={split}/part-{part:06d}-{attempt}.bin"
                    system.create_dir(f"{plain}/split={split}", recursive=True)
                    streams[split] = system.open_output_stream(f"{plain}/{name}")
                    paths[split] = name
                    docs[split] = tokens[split] = 0
                streams[split].write(ids.astype("<u2").tobytes())
                docs[split] += len(chosen)
                tokens[split] += int(ids.size)
        for stream in streams.values():
            stream.close()
        names = list(paths)
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.string()), pa.array([part] * len(names), pa.int32()),
            pa.array([paths[s] for s in names], pa.string()),
            pa.array([docs[s] for s in names], pa.int64()),
            pa.array([tokens[s] for s in names], pa.int64()),
        ], schema=_MANIFEST_ARROW)

    return write


def _by_hash(df: DataFrame, id_col: str, seed: int | str, parts: int) -> DataFrame:
    """Documents in shuffled order. The hash is uniform: its top bits give the part number."""
    keyed = df.select(
        "split", "tokens", seeded_hash(seed, id_col).alias("_hash"), F.col(id_col).alias("_id")
    )
    part = F.shiftright(F.shiftright("_hash", HASH_BITS - 32) * F.lit(parts).cast("bigint"), 32)
    return keyed.repartitionById(parts, part.cast("int")).sortWithinPartitions(
        "split", "_hash", "_id"
    )


def _by_unit(df: DataFrame, unit: str, row: str, parts: int) -> DataFrame:
    """Documents in the order of (unit, row). A large unit becomes several parts.

    A range shuffle would read the tokens once more to sample them. The part
    is computed from the row counts of the units instead, one row per unit.
    """
    units = df.groupBy(unit).agg((F.max(row) + 1).alias("_rows"))
    total = units.agg(F.sum("_rows")).first()[0] or 0
    share = max(1, -(-total // parts))
    earlier = Window.orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.ceil(F.col("_rows") / share)
    units = materialize(units.select(
        unit, wanted.alias("_wanted"), F.coalesce(F.sum(wanted).over(earlier), F.lit(0)).alias("_first")
    ))
    count = units.agg(F.sum("_wanted")).first()[0] or 1
    part = (F.col("_first") + F.floor(F.col(row) / share)).cast("int")
    # As many rows as there are shard files, which the driver has listed before.
    placed = df.select("split", "tokens", unit, row).join(F.broadcast(units), unit)
    return placed.repartitionById(count, part).sortWithinPartitions("split", unit, row)


def write_token_dataset(df: DataFrame, path: str, id_col="doc_id",
                        seed: int | str = DEFAULT_SEED,
                        order: tuple[str, str] | None = None) -> None:
    """Write (split, tokens) as little-endian 16-bit part files.

    Documents come in shuffled order, or by ``order``: a column that names the
    unit they belong to (a shard) and one with their row number in it. Fails if
    a token does not fit. The manifest lists only the files of the task attempts
    that counted.
    """
    path = qualified(df.sparkSession, path)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _by_hash(df, id_col, seed, parts) if order is None else _by_unit(df, *order, parts)
    manifest = ordered.select("split", "tokens").mapInArrow(_part_writer(path), _MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Part files with the stream position of their first token. One row per part file."""
    path = qualified(spark, path)
    parts = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    earlier = (
        Window.partitionBy("split").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def _range_reader(folder: str):
    schema = pa.schema([
        ("split", pa.string()), ("start", pa.int64()), ("tokens", pa.list_(pa.int32())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, plain = open_filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{plain}/{row['path']}") as stream:
                    raw = stream.read_at(2 * row["n"], 2 * row["skip"])
                ids = np.frombuffer(raw, "<u2").astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["split"]], pa.string()),
                    pa.array([row["start"]], pa.int64()),
                    pa.array([ids], pa.list_(pa.int32())),
                ], schema=schema)

    return read


def read_token_dataset(spark: SparkSession, path: str, chunk_tokens: int = 1 << 20) -> DataFrame:
    """(split, start, tokens): chunks of at most ``chunk_tokens``, addressed by position.

    Big part files are read as many ranges in parallel.
    """
    path = qualified(spark, path)
    ranges = (
        read_manifest(spark, path).where("n_tokens > 0")
        .withColumn("skip", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.col("n_tokens") - 1, F.lit(chunk_tokens).cast("bigint"))))
        .select(
            "split", "path", (F.col("start") + F.col("skip")).alias("start"), "skip",
            F.least(F.lit(chunk_tokens).cast("bigint"), F.col("n_tokens") - F.col("skip")).alias("n"),
        )
    )
    return ranges.repartition("path", "skip").mapInArrow(
        _range_reader(path), "split string, start bigint, tokens array<int>"
    )


def corpus_meta(df: DataFrame, vocab_size: int = fv.CODE_VOCAB_SIZE, tokenizer: str = "bytes",
                lang_col: str | None = "lang", shard_col: str | None = None,
                source: str | None = None) -> DataFrame:
    """One row that describes an encoded corpus with ``split`` and ``n_tokens``."""
    train = F.col("split") == "train"
    val = F.col("split") == "val"

    def tokens(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n_tokens").cast("bigint"))), F.lit(0))

    columns = [
        tokens(train).alias("num_train_tokens"), tokens(val).alias("num_val_tokens"),
        F.count_if(train).alias("num_train_docs"), F.count_if(val).alias("num_val_docs"),
    ]
    if lang_col:
        columns.append(F.array_sort(F.collect_set(lang_col)).alias("languages"))
    if shard_col:
        columns.append(
            F.count_distinct(F.when(train, F.col(shard_col))).alias("num_train_shards")
        )
    meta = df.agg(*columns).withColumns({
        "vocab_size": F.lit(vocab_size), "tokenizer": F.lit(tokenizer),
    })
    return meta if source is None else meta.withColumn("source", F.lit(source))


def write_corpus_meta(meta: DataFrame, path: str) -> None:
    """The metadata row with the special tokens, as JSON."""
    special = F.from_json(
        F.to_json(F.map_from_entries(F.array(*[
            F.struct(F.lit(token), F.lit(token_id)) for token, token_id in fv.SPECIAL_TOKENS.items()
        ]))), "map<string,int>",
    )
    meta.withColumn("special_tokens", special).write.mode("overwrite").json(path)

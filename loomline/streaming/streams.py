"""Structured Streaming jobs. They reuse the batch operators.

All sinks are files in the shared folder, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from loomline.functions import fixed_values as fv
from loomline.functions.tokenizers import BYTES
from loomline.operators.caps import within_cutoffs
from loomline.operators.filters import char_length_ok, filter_char_length
from loomline.operators.tokens import encode_document
from loomline.session import materialize
from loomline.sources.samples import with_content


def read_arriving(spark: SparkSession, directory: str, schema: StructType | str,
                  glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the parquet files of a folder, each file once."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


def _append(stream: DataFrame, out: str, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_shards(spark: SparkSession, directory: str, schema, out: str, checkpoint: str, *,
                  once: bool = True, glob: str | None = "*.parquet",
                  files_per_batch: int | None = None) -> StreamingQuery:
    """Pick up shards as they arrive, with the shard's path on every row; done ones are skipped.

    Files of one write have equal names in every partition folder, so the whole path is the identity.
    """
    arriving = read_arriving(spark, directory, schema, glob, files_per_batch)
    named = arriving.withColumn("shard", F.col("_metadata.file_path"))
    return _append(named, out, checkpoint, once)


def shard_status(ingested: DataFrame, required: int) -> DataFrame:
    """Number of shards so far and whether there are enough to start."""
    return ingested.agg(F.count_distinct("shard").alias("n_shards")).withColumn(
        "ready", F.col("n_shards") >= required
    )


def prepare_rows(rows: DataFrame, tokenizer=BYTES, text_col="text", lang_col="lang",
                 high: int = fv.MAX_SAMPLE_CHARS) -> DataFrame:
    """Missing text to empty, length filter, encode. Stateless: same for batch and stream."""
    filled = with_content(rows, text_col)
    return encode_document(
        filter_char_length(filled, text_col, high=high), tokenizer, text_col, lang_col
    )


def stream_prepare(stream: DataFrame, out: str, checkpoint: str, *, tokenizer=BYTES,
                   once: bool = True) -> StreamingQuery:
    """Filter and encode rows as they come."""
    return _append(prepare_rows(stream, tokenizer), out, checkpoint, once)


def stream_cap_per_language(stream: DataFrame, out: str, checkpoint: str,
                            max_per_language: int, languages: Sequence[str], *,
                            id_col="doc_id", lang_col="lang", text_col="text",
                            high: int = fv.MAX_MULTILANG_CHARS, once: bool = True) -> StreamingQuery:
    """Accept rows of a language until ``max_per_language`` have been accepted.

    Accepted counts so far are a table written once per micro-batch, one row per
    language; a batch reads that of the batch before it, not all. Within a batch the cap is an id cutoff found by counting, so a
    frequent language is not funnelled through one keyed state. Replaying a
    batch rewrites the same folders.
    """
    spark = stream.sparkSession
    state = f"{out}-accepted"
    counts = f"{lang_col} string, n bigint"
    spark.createDataFrame([], counts).write.mode("overwrite").parquet(f"{state}/batch=-1")

    def accept(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = session.read.schema(counts).parquet(f"{state}/batch={batch_id - 1}")
        used = {row[lang_col]: row["n"] for row in before.collect()}  # one row per language
        room = {lang: max_per_language - used.get(lang, 0) for lang in languages}
        room = {lang: n for lang, n in room.items() if n > 0}
        fitting = batch.where(F.col(lang_col).isin(list(room))).where(
            char_length_ok(F.col(text_col), high=high)
        )
        if room:
            ids = materialize(fitting.select(lang_col, id_col))
            fitting = within_cutoffs(fitting, ids, room, id_col, lang_col)
        target = f"{out}/batch={batch_id}"
        fitting.write.mode("overwrite").parquet(target)
        accepted = session.read.schema(fitting.schema).parquet(target).groupBy(lang_col).agg(
            F.count("*").alias("n")
        )
        accepted.union(before).groupBy(lang_col).agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(accept).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_metrics(steps: DataFrame, tokens_per_step: int, window: str = "1 hour",
                     delay: str = "10 minutes", ts_col="ts", loss_col="loss") -> DataFrame:
    """Mean loss and tokens per second of each tumbling window."""
    span = F.window(ts_col, window)
    grouped = steps.withWatermark(ts_col, delay).groupBy(span.alias("window")).agg(
        F.count("*").alias("n_steps"), F.avg(loss_col).alias("mean_loss")
    )
    seconds = F.unix_micros("window.end") - F.unix_micros("window.start")
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "n_steps", "mean_loss",
        (F.col("n_steps") * F.lit(tokens_per_step) / (seconds / 1e6)).alias("tokens_per_second"),
    )


def stream_run_metrics(steps: DataFrame, out: str, checkpoint: str, tokens_per_step: int, *,
                       once: bool = True, **options) -> StreamingQuery:
    """Live window metrics. A window is written when the watermark has passed its end."""
    return _append(windowed_metrics(steps, tokens_per_step, **options), out, checkpoint, once)


class LateRows(StreamingQueryListener):
    """Counts what all queries of a session drop for coming after the watermark, from every progress report.

    ``recentProgress`` forgets all but the last reports; a listener sees each.
    Spark reports rows after partial aggregation: late rows of one window and
    task count once, so this is a lower bound, and 0 only if nothing was dropped.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.id)] = self.dropped.get(str(progress.id), 0) + sum(
            operator.numRowsDroppedByWatermark for operator in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def count_late_rows(spark: SparkSession) -> LateRows:
    """Start counting; ``dropped`` of the result has a number per query id."""
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener

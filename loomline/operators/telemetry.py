"""Run telemetry: log parsing, smoothing, checkpoints, throughput, comparison.

Steps are whole numbers from 0 inside a run. A run may hold a large share of all
rows: every scan goes bucket by bucket within the run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.operators.ordering import rank_within, totals_before
from loomline.session import materialize

# --- fixed values: shapes of the log lines -------------------------------------
_NUMBER = r"([-+]?(?:\d+\.?\d*(?:[eE][-+]?\d+)?|nan|inf))"
LOG_SHAPES = {
    "iter": rf"^iter (\d+): loss {_NUMBER}, time {_NUMBER}ms, mfu {_NUMBER}%$",
    "eval": rf"^step (\d+): train loss {_NUMBER}, val loss {_NUMBER}$",
    "step": (
        rf"^step (\d+) \({_NUMBER}%\) \| loss: {_NUMBER} \| lrm: {_NUMBER} \| dt: {_NUMBER}ms"
        rf" \| tok/sec: ([\d,]+) \| mfu: {_NUMBER}% \| epoch: (\d+) \| remaining: {_NUMBER}s$"
    ),
    "summary": (
        r"^(val_bpb|training_seconds|total_seconds|peak_vram_mb|mfu_percent|total_tokens_M"
        r"|num_steps|num_params_M|depth):\s+(\S+)$"
    ),
}
LOG_FIELDS = {
    "iter": ["step", "loss", "time_ms", "mfu"],
    "eval": ["step", "train_loss", "val_loss"],
    "step": ["step", "pct_done", "loss", "lrm", "time_ms", "tok_per_sec", "mfu", "epoch",
             "remaining_s"],
    "summary": ["key", "value"],
}
_LONG_FIELDS = {"step", "tok_per_sec", "epoch"}
_TEXT_FIELDS = {"key", "value"}


def parse_run_log(df: DataFrame, line_col="line") -> DataFrame:
    """Typed columns of every known line shape. ``shape`` is NULL for unknown lines."""
    line = F.trim(F.regexp_replace(line_col, r"[\r\n]", ""))
    shape: Column = F.lit(None).cast("string")
    for name, pattern in reversed(LOG_SHAPES.items()):
        shape = F.when(F.rlike(line, F.lit(pattern)), name).otherwise(shape)
    parsed = df.withColumn("_line", line).withColumn("shape", shape)

    def field(name: str) -> Column:
        value: Column = F.lit(None).cast("string")
        for kind, names in LOG_FIELDS.items():
            if name in names:
                value = F.when(
                    F.col("shape") == kind,
                    F.regexp_extract("_line", LOG_SHAPES[kind], names.index(name) + 1),
                ).otherwise(value)
        if name in _TEXT_FIELDS:
            return value
        if name in _LONG_FIELDS:
            return F.regexp_replace(value, ",", "").try_cast("bigint")
        return value.try_cast("double")

    names = list(dict.fromkeys(n for fields in LOG_FIELDS.values() for n in fields))
    return parsed.select(df["*"], "shape", *[field(n).alias(n) for n in names])


def log_shape_counts(parsed: DataFrame) -> DataFrame:
    """Lines per shape; lines of no known shape are counted as ``unparsed``."""
    return parsed.groupBy(F.coalesce("shape", F.lit("unparsed")).alias("shape")).agg(
        F.count("*").alias("n_lines")
    )


def number_steps(df: DataFrame, order: Sequence[str], run_col="run") -> DataFrame:
    """Add ``step``, the 0-based position within the run, for tables that have none."""
    return rank_within(df, [run_col], list(order), "step")


#: Bucket ends that are carried along in one step, and steps above each other: enough for 10^13 steps a run.
_FANOUT, _LEVELS = 128, 5


def _carried(ends: DataFrame, run_col: str, decay: float, level: int = 0) -> DataFrame:
    """(run, _bucket, _carry): the average at the end of the bucket before, from all earlier ends.

    ``ends`` has one value per bucket; each bucket multiplies what was before by
    ``decay``. Buckets are folded in groups of ``_FANOUT``, the groups' own ends
    by the same rule one level up, so no list is long and nothing is left out.
    """
    group = F.floor(F.col("_bucket") / _FANOUT)
    lists = ends.groupBy(run_col, group.alias("_group")).agg(
        F.array_sort(F.collect_list(F.struct("_bucket", "_end"))).alias("_ends"))
    start = F.struct(
        F.lit(0.0).alias("value"), (F.col("_group") * _FANOUT - 1).alias("at"),
        F.array().cast("array<struct<_bucket:bigint,_carry:double>>").alias("out"))

    def fold(a: Column, e: Column) -> Column:
        before = a["value"] * F.pow(F.lit(decay), e["_bucket"] - 1 - a["at"])
        return F.struct(
            (before * decay + e["_end"]).alias("value"), e["_bucket"].alias("at"),
            F.concat(a["out"], F.array(F.struct(
                e["_bucket"].alias("_bucket"), before.alias("_carry")))).alias("out"))

    folded = lists.select(run_col, "_group", F.aggregate("_ends", start, fold).alias("_f"))
    inside = folded.select(run_col, "_group", F.inline("_f.out"))
    if level + 1 == _LEVELS:
        return inside.drop("_group")
    tail = F.pow(F.lit(decay), F.col("_group") * _FANOUT + _FANOUT - 1 - F.col("_f.at"))
    above = _carried(
        folded.select(run_col, F.col("_group").alias("_bucket"), (F.col("_f.value") * tail).alias("_end")),
        run_col, decay ** _FANOUT, level + 1,
    ).select(run_col, F.col("_bucket").alias("_group"), F.col("_carry").alias("_above"))
    since = F.pow(F.lit(decay), F.col("_bucket") - F.col("_group") * _FANOUT)
    return inside.join(above, [run_col, "_group"]).select(
        run_col, "_bucket", (F.col("_carry") + F.col("_above") * since).alias("_carry"))


def _decayed(df: DataFrame, run_col: str, beta: float, local: Column, width: int) -> DataFrame:
    """Exponential average started at zero: adds ``_ema``.

    Inside a bucket of ``width`` steps a running sum of ``x * beta^-i`` is scaled
    back. Older buckets arrive through the average at their end, see ``_carried``.
    """
    at = F.pmod("step", F.lit(width))
    inside = (
        Window.partitionBy(run_col, "_bucket").orderBy("step")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    scaled = F.sum(local * F.pow(F.lit(beta), -at)).over(inside) * F.pow(F.lit(beta), at)
    ends = df.groupBy(run_col, "_bucket").agg(
        F.sum(local * F.pow(F.lit(beta), F.lit(width - 1) - at)).alias("_end")
    )
    arriving = _carried(materialize(ends), run_col, beta ** width)
    return (
        df.withColumn("_local", scaled)
        .join(arriving, [run_col, "_bucket"], "left")
        .withColumn("_ema", F.col("_local")
                    + F.coalesce("_carry", F.lit(0.0)) * F.pow(F.lit(beta), at + 1))
        .drop("_local", "_carry")
    )


def _safe_width(beta: float, width: int) -> int:
    """Bucket width for which ``beta^-width`` stays far from overflow."""
    return max(1, min(width, int(460 / -math.log(beta))))


def smoothed_loss(df: DataFrame, beta: float = 0.9, limit: float = 100.0, run_col="run",
                  loss_col="loss", width: int = 512) -> DataFrame:
    """Bias-corrected exponential average of the loss.

    A run ends at its first NaN or too large loss: that row is marked
    ``failed`` and has no smoothed value, later rows are dropped.
    """
    width = _safe_width(beta, width)
    loss = F.col(loss_col)
    bad = F.isnan(loss) | (loss > limit) | loss.isNull()
    flagged = df.withColumns({"_bucket": F.floor(F.col("step") / width), "failed": bad})
    flagged = totals_before(
        flagged, "_bucket", ["step"], {"_bad_before": ("max", F.col("failed"))}, group=[run_col],
        fanout=4096,
    ).where(~F.coalesce("_bad_before", F.lit(False))).drop("_bad_before")
    weighted = F.when(F.col("failed"), 0.0).otherwise(loss * (1 - beta))
    averaged = _decayed(flagged, run_col, beta, weighted, width)
    corrected = F.col("_ema") / (1 - F.pow(F.lit(beta), F.col("step") + 1))
    return averaged.withColumn(
        "smoothed", F.when(~F.col("failed"), corrected)
    ).drop("_ema", "_bucket")


def smoothed_mfu(df: DataFrame, beta: float = 0.9, warmup: int = 5, run_col="run", mfu_col="mfu",
                 width: int = 512) -> DataFrame:
    """Exponential average that starts at the first value after ``warmup`` steps.

    Without bias correction; -1 during the warm-up.
    """
    width = _safe_width(beta, width)
    first = F.when(F.col("step") == warmup, F.col(mfu_col))
    local = F.coalesce(first, F.col(mfu_col) * (1 - beta))
    counted = df.where(F.col("step") >= warmup).withColumn(
        "_bucket", F.floor(F.col("step") / width)
    )
    averaged = _decayed(counted, run_col, beta, local, width)
    early = df.where(F.col("step") < warmup).withColumn("running_mfu", F.lit(-1.0))
    return averaged.withColumnRenamed("_ema", "running_mfu").drop("_bucket").unionByName(early)


def best_checkpoint(evals: DataFrame, always_save: bool = True, run_col="run",
                    val_loss_col="val_loss", width: int = 1024) -> DataFrame:
    """Running best validation loss and whether a checkpoint is saved at each evaluation.

    Every evaluation is saved with ``always_save``, else only improvements.
    Step 0 never is. A NaN or missing loss is no improvement and no best loss.
    """
    loss = F.when(~F.isnan(val_loss_col), F.col(val_loss_col))
    scanned = totals_before(
        evals.withColumn("_bucket", F.floor(F.col("step") / width)), "_bucket", ["step"],
        {"_best_before": ("min", loss)}, group=[run_col], fanout=4096,
    ).drop("_bucket")
    improved = loss.isNotNull() & (
        F.col("_best_before").isNull() | (loss < F.col("_best_before")))
    return scanned.withColumns({
        "best_val_loss": F.least("_best_before", loss),
        "improved": improved,
        "saved": (F.lit(always_save) | improved) & (F.col("step") > 0),
    }).drop("_best_before")


def throughput(steps: DataFrame, tokens_per_step: int, run_col="run", seconds_col="seconds",
               untimed_until: int = 10) -> DataFrame:
    """Tokens per second of each run over the steps after ``untimed_until``."""
    timed = F.col("step") > untimed_until
    return steps.groupBy(run_col).agg(
        F.count("*").alias("n_steps"),
        F.count_if(timed).alias("timed_steps"),
        F.sum(F.when(timed, F.col(seconds_col))).alias("timed_seconds"),
    ).withColumn(
        "tokens_per_second",
        F.col("timed_steps") * F.lit(tokens_per_step) / F.nullif("timed_seconds", F.lit(0.0)),
    )


def run_comparison(losses: DataFrame, run_col="run", split_col="split", loss_col="loss") -> DataFrame:
    """Runs side by side: mean loss of both splits, gap and perplexities."""
    wide = losses.groupBy(run_col).pivot(split_col, ["train", "val"]).agg(F.avg(loss_col))
    return wide.select(
        run_col,
        F.col("train").alias("train_loss"),
        F.col("val").alias("val_loss"),
        (F.col("val") - F.col("train")).alias("gap"),
        F.exp("train").alias("train_perplexity"),
        F.exp("val").alias("val_perplexity"),
    )

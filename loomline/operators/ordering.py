"""Exact ranks and running sums without a single-task sort.

``sum() over (order by ...)`` with no partition key sends every row to one
task, and with a skewed key a third of them. Here the order is cut into buckets
that follow it. Each bucket is summed with map-side combine, the short table of
bucket sums is scanned, and rows are scanned inside their own bucket only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.hashing import BUCKET_BITS, HASH_BITS, hash_bucket, seeded_hash
from loomline.functions.lookup import lookup
from loomline.session import materialize

_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}
_MERGE = {
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
    "min": F.least,
}
PART, ROW = "_part", "_row"


def totals_before(
    df: DataFrame,
    bucket: str,
    order: Sequence[Column | str],
    totals: Mapping[str, tuple[str, Column]],
    *,
    group: Sequence[str] = (),
    whole: bool = False,
    fanout: int | None = None,
    few_buckets: bool = False,
) -> DataFrame:
    """Add, for every row, running totals of the rows before it.

    ``bucket`` must be monotone in ``order`` within a group. ``totals`` maps an
    output column to ``("sum" | "max" | "min", value)``. ``whole`` adds
    ``<name>_all``, the total over the group. ``fanout`` scans the bucket table
    itself in coarse buckets, for streams with very many of them (integer
    buckets only). ``few_buckets`` promises at most 2^16 buckets for a handful
    of groups, and so a broadcast of bounded size.
    """
    keys = [*group, bucket]
    totals = dict(totals)
    per_bucket = df.groupBy(*keys).agg(
        *[_AGGREGATE[kind](value).alias(name) for name, (kind, value) in totals.items()]
    )
    carried = {name: f"_carry_{name}" for name in totals}
    if fanout is None:
        earlier = (
            Window.partitionBy(*group).orderBy(bucket)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = per_bucket.select(
            *keys,
            *[
                _AGGREGATE[kind](name).over(earlier).alias(carried[name])
                for name, (kind, _) in totals.items()
            ],
            *[
                _AGGREGATE[kind](name).over(Window.partitionBy(*group)).alias(f"{name}_all")
                for name, (kind, _) in totals.items()
                if whole
            ],
        )
    else:
        coarse = materialize(per_bucket).withColumn("_coarse", F.floor(F.col(bucket) / fanout))
        carry = totals_before(
            coarse,
            "_coarse",
            [bucket],
            {carried[name]: (kind, F.col(name)) for name, (kind, _) in totals.items()},
            group=group,
        ).select(*keys, *carried.values())
    inside = (
        Window.partitionBy(*keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.select(
        "*", *[_AGGREGATE[kind](value).over(inside).alias(name)
               for name, (kind, value) in totals.items()]
    )
    # Rows are partitioned by the keys already. The short table comes to them.
    carry = F.broadcast(carry) if few_buckets else carry.hint("shuffle_hash")
    joined = local.join(carry, keys)
    merged = {
        name: _MERGE[kind](F.col(carried[name]), F.col(name))
        for name, (kind, _) in totals.items()
    }
    return joined.withColumns(merged).drop(*carried.values())


def range_sorted(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partition and sort by ``order``; add the partition number and row number.

    For orders that are neither a hash nor a dense integer. The table is
    checkpointed, since the sampled range borders must not be drawn twice. The
    partition number then serves as the bucket of :func:`totals_before`.
    """
    local_row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({PART: F.spark_partition_id(), ROW: local_row})
    )
    return materialize(ranged)


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """1-based rank over the whole table. One range shuffle, no single-task sort."""
    ranged = range_sorted(df, order)
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the number of partitions.
    offsets = ranged.groupBy(PART).agg(F.count("*").alias("_n")).select(
        PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        ranged.join(F.broadcast(offsets), PART)
        .withColumn(name, F.col("_offset") + F.col(ROW) + 1)
        .drop(PART, ROW, "_offset")
    )


def rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str
) -> DataFrame:
    """0-based position inside a group. A hot group is spread over many partitions."""
    ranged = range_sorted(df, [*group, *order])
    segments = ranged.groupBy(PART, *group).agg(
        F.min(ROW).alias("_first"), F.count("*").alias("_n")
    )
    earlier = (
        Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    segments = segments.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return (
        ranged.join(segments.drop("_n"), [PART, *group])
        .withColumn(name, F.col("_before") + F.col(ROW) - F.col("_first"))
        .drop(PART, ROW, "_first", "_before")
    )


def in_hash_order(
    ids: DataFrame,
    id_col: str,
    seed: int | str,
    totals: Mapping[str, tuple[str, Column]],
    group: Sequence[str] = (),
) -> DataFrame:
    """Running totals before each row in the order of the seeded hash of its id.

    Meant for narrow tables. The hash is uniform: its top bits are the buckets.
    Their table is broadcast for the whole table or its two splits only, 2^17
    rows at most; more groups are joined.
    """
    keyed = ids.withColumn("_hash", seeded_hash(seed, id_col))
    keyed = keyed.withColumn("_bucket", hash_bucket("_hash"))
    return totals_before(
        keyed, "_bucket", ["_hash", id_col], totals, group=group,
        few_buckets=list(group) in ([], ["split"]),
    ).drop("_hash", "_bucket")


def hash_position(df: DataFrame, id_col: str, seed: int | str, name: str = "position") -> DataFrame:
    """0-based position in the order of the seeded hash. Ids must be unique.

    Positions are computed on the ids alone and joined back, so the wide rows
    are shuffled once, evenly, and not sorted.
    """
    placed = in_hash_order(df.select(id_col), id_col, seed, {name: ("sum", F.lit(1))})
    return df.join(placed, id_col)


def _single(rows: int, id_value) -> None:
    if rows > 1:
        raise ValueError(f"ids must be unique: {id_value} occurs {rows} times at the cut")


def hash_cutoff(df: DataFrame, id_col: str, seed: int | str, ratio: float) -> tuple | None:
    """(hash, id) of the last of the first ``max(1, int(N * ratio))`` rows in hash order.

    Three passes over the id column: two count the rows by the upper and then
    the next 16 bits of the hash, the last ranks the rows that have both in
    common with the cut (N / 2^32). The result is a pair of literals, so that
    plans built on it stay small. None for an empty table. An id that occurs
    several times at the cut is refused: no exact split exists then.
    """
    keyed = df.select(seeded_hash(seed, id_col).alias("hash"), F.col(id_col).alias("id"))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)

    def locate(rows: DataFrame, shift: int, wanted: Column | None) -> tuple | None:
        counted = rows.groupBy(F.shiftright("hash", shift).alias("bucket")).agg(F.count("*").alias("n"))
        if wanted is None:
            wanted = F.greatest(F.lit(1), F.floor(F.sum("n").over(Window.partitionBy()) * F.lit(ratio)))
        cut = (
            counted.select("bucket", "n", F.sum("n").over(running).alias("upto"), wanted.alias("wanted"))
            .where("upto >= wanted")
            .agg(F.min(F.struct("bucket", F.expr("wanted - upto + n").alias("inside"))).alias("cut"))
            .select("cut.*").first()
        )
        return None if cut is None or cut["bucket"] is None else (cut["bucket"], cut["inside"])

    shift = HASH_BITS - BUCKET_BITS
    cut = locate(keyed, shift, None)
    if cut is None:
        return None
    for finer in (shift - BUCKET_BITS,):
        keyed = keyed.where(F.shiftright("hash", shift) == cut[0])
        cut, shift = locate(keyed, finer, F.lit(cut[1])), finer
    rows = (
        keyed.where(F.shiftright("hash", shift) == cut[0])
        .groupBy("hash", "id").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(
            Window.orderBy("hash", "id").rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("upto") >= cut[1]).orderBy("hash", "id").limit(1).first()
    )
    _single(rows["n"], rows["id"])
    return rows["hash"], rows["id"]


def smallest_ids(
    df: DataFrame, id_col: str, count: int | Mapping, group: str | None = None
) -> DataFrame:
    """The id of the ``count``-th row in id order, per group: columns (group, cutoff).

    ``count`` may differ per group, as a small dictionary of positive numbers.
    Groups with fewer rows are absent. Works by counting, not by sorting: the
    ids' bits are counted 16 at a time from the first that differs at all, each
    time among the ids that agree with the cut so far, until it is one id. Ids
    must be integers; one that occurs several times at a cut is refused.
    """
    kind = df.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column, not {kind.simpleString()}")
    group_col = F.lit(0) if group is None else F.col(group)
    rows = df.select(group_col.alias("_g"), F.col(id_col).cast("bigint").alias("_id")).where("_id is not null")
    lowest, highest = rows.agg(F.min("_id"), F.max("_id")).first()
    bits = 64 if (lowest or 0) < 0 <= (highest or 0) else ((lowest or 0) ^ (highest or 0)).bit_length()
    wanted = lookup(count, F.col("_g")) if isinstance(count, Mapping) else F.lit(count)
    cut = rows.select("_g").distinct().select("_g", wanted.cast("bigint").alias("need"))
    shift, agreed = max(bits, 1), None
    while shift > 0:
        shift = max(0, shift - BUCKET_BITS)
        agreeing = rows.join(cut, "_g")
        if agreed is not None:
            agreeing = agreeing.where(F.col("_prefix") == F.shiftright("_id", agreed))
        running = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        counted = agreeing.groupBy("_g", F.shiftright("_id", shift).alias("_b")).agg(
            F.count("*").alias("n"), F.max("need").alias("need"))
        cut = materialize(
            counted.withColumn("upto", F.sum("n").over(running)).where("upto >= need")
            .groupBy("_g").agg(F.min(F.struct(
                F.col("_b"), F.expr("need - upto + n").alias("need"), F.col("n"))).alias("cut"))
            .select("_g", F.col("cut._b").alias("_prefix"), "cut.need", "cut.n"))
        agreed = shift
    several = cut.where("n > 1").select("_prefix", "n").first()
    if several is not None:
        _single(several["n"], several["_prefix"])
    return cut.select(F.col("_g").alias(group or "_g"), F.col("_prefix").alias("cutoff"))

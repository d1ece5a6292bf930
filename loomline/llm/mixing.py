"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.hashing import seeded_hash
from loomline.llm.common import only
from loomline.session import materialize

DEFAULT_SEED = 42
#: Share of a source: its size to this power, in proportion.
TEMPERATURE = 0.5
#: A Poisson count with a larger mean is drawn as a sum of counts with equal smaller means.
LARGEST_MEAN = 500.0
#: So many sources at most are sent to every task; beyond it the rates are joined by salted key.
BROADCAST_SOURCES = 10_000
SALTS = 64


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
                 temperature: float = TEMPERATURE, total: float | None = None) -> DataFrame:
    """source, n_docs, size (characters) and rate: the mean number of copies of its documents.

    rate = weight / sum of weights * total / size. ``weights`` are shares by source (others get
    0); without them a source has its size to the power ``temperature``. ``total`` is the wanted
    number of characters, that of the input by default. A source without characters keeps its
    documents once on average. A null source is a source of its own.
    """
    sizes = only(docs, "source", "text").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(share))).otherwise(weight)
    weighted = materialize(sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0)))
    sums = weighted.agg(F.sum("weight"), F.sum("size")).first()
    if weighted.filter("weight < 0 or isnan(weight)").limit(1).count():
        raise ValueError("weights must not be negative")
    wanted = F.lit(float(sums[1] or 0) if total is None else float(total))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.col("weight") / F.lit(float(sums[0] or 1) or 1.0) * wanted / F.col("size"))
    return weighted.select("source", "n_docs", "size", rate.alias("rate"))


def poisson_steps(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until what is left is below 2 to the power -60.

    ``mean`` is at most LARGEST_MEAN. The first term is positive: exp(-500) is a normal double.
    """
    last = F.ceil(mean + 10 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * mean / k)).alias("cdf")),
        lambda a: a["cdf"])


def poisson_count(seed: int, key: Column, draws: Column, steps: Column) -> Column:
    """The inverse of the Poisson distribution at the hash of (seed, draw, key), summed over draws."""
    def unit(j: Column) -> Column:  # as functions.hashing.unit_draw, with a draw number
        digest = F.md5(F.concat(F.lit(f"{seed}:poisson:"), j.cast("string"), F.lit(":"), key))
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").cast("double") / F.lit(2.0 ** 60)

    return F.aggregate(
        F.sequence(F.lit(1), draws), F.lit(0).cast("bigint"),
        lambda n, j: n + F.size(F.filter(steps, lambda c: c <= unit(j))))


def replicate(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
              temperature: float = TEMPERATURE, total: float | None = None,
              seed: int = DEFAULT_SEED) -> DataFrame:
    """Repeat every document a Poisson number of times and shuffle all copies.

    The columns of the input come first, with copy (1, 2, ...), rate and shuffle_key behind; input
    columns of these three names are left out. The count depends on seed and doc_id only: repeated
    rows get equal counts, rows without doc_id the count of the text 'null'. Rows come in the order
    of shuffle_key within partitions that are dealt by it, so any prefix of the output is a random
    mixture. The texts are shuffled once; no key is hot, since copies are dealt by the hash of
    doc_id and copy. An empty table gives an empty table.
    """
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in ("copy", "rate", "shuffle_key")]
    doc_id, text, src = (f"_{docs.columns.index(c)}" for c in ("doc_id", "text", "source"))
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(*[f"_{i}" for i in kept])
    rates = materialize(source_rates(docs, weights, temperature, total).select(
        "source", "rate",
        F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int").alias("draws"),
    ).withColumn("steps", poisson_steps(F.col("rate") / F.col("draws"))))
    if rates.count() <= BROADCAST_SOURCES:
        rated = rows.join(F.broadcast(rates), F.col(src).eqNullSafe(F.col("source")))
    else:
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
        rated = rows.withColumn("salt", F.pmod(F.xxhash64(doc_id, text), F.lit(SALTS))).join(
            rates.withColumn("of_salt", F.explode(salts)),
            F.col(src).eqNullSafe(F.col("source")) & (F.col("salt") == F.col("of_salt")))
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    copies = (rated.withColumn("n", poisson_count(seed, key, F.col("draws"), F.col("steps")))
              .filter("n > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
              .withColumn("shuffle_key", seeded_hash(f"{seed}:order", F.concat_ws(
                  ":", key, F.col("copy").cast("string")))))
    return (copies.select(*[f"_{i}" for i in kept], "copy", "rate", "shuffle_key")
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key")
            .toDF(*[docs.columns[i] for i in kept], "copy", "rate", "shuffle_key"))


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = only(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "source", "text")
    return replicate(docs).select("doc_id", "source", "text", "copy", "shuffle_key")


OP5_SQL = """
with sizes as (
  select source, coalesce(sum(length(text)), 0)::double as size from documents group by source),
weighted as (
  select *, case when size > 0 then pow(size, 0.5) else 0 end as weight from sizes),
rates as (
  select source, case when size = 0 then 1.0
    else weight / (select sum(weight) from weighted) * (select sum(size) from weighted) / size end as rate
  from weighted),
draws as (select *, greatest(1, ceil(rate / 500.0))::int as m from rates),
means as (select *, rate / m as mean from draws),
cdf as (
  select source, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1)))
    over (partition by source order by k) as upto
  from means, unnest(generate_series(0, ceil(mean + 10 * sqrt(mean) + 30)::bigint)) as s(k)),
units as (
  select d.doc_id, d.source, d.text, j,
    ('0x' || substr(md5('42:poisson:' || j || ':' || d.doc_id), 1, 15))::bigint::double
      / 1152921504606846976.0 as u
  from documents d join means m on d.source is not distinct from m.source,
    unnest(generate_series(1, m.m)) as g(j)),
counts as (
  select u.doc_id, u.source, u.text, count(c.k) as n
  from units u join cdf c on u.source is not distinct from c.source and c.upto <= u.u
  group by all)
select doc_id, source, text, copy,
  ('0x' || substr(md5('42:order:' || doc_id || ':' || copy), 1, 15))::bigint as shuffle_key
from counts, unnest(generate_series(1, n)) as g(copy)
"""

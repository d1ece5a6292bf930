"""Ranks and running sums against brute force, with one group that holds most rows."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from loomline.functions.hashing import seeded_hash
from loomline.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = []
    for group, size in [("hot", 900), ("b", 60), ("c", 1)]:
        rows += [(group, step, rng.randint(-5, 9)) for step in range(size)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, step long, v long").repartition(6)


@pytest.mark.parametrize("fanout", [None, 3])
@pytest.mark.parametrize("width", [1, 7, 5000])
def test_totals_before(skewed, width, fanout):
    rows, df = skewed
    bucketed = df.withColumn("b", F.floor(F.col("step") / width))
    got = ordering.totals_before(
        bucketed, "b", ["step"],
        {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("min", F.col("v"))},
        group=["g"], fanout=fanout,
    ).collect()
    by_key = {(r.g, r.step): (r.s, r.m, r.l) for r in got}
    assert len(by_key) == len(rows)
    for group in {r[0] for r in rows}:
        values = [v for _, _, v in sorted(r for r in rows if r[0] == group)]
        for step in range(len(values)):
            head = values[:step]
            expected = (sum(head), max(head, default=None), min(head, default=None))
            assert by_key[group, step] == expected


def test_group_totals(skewed):
    rows, df = skewed
    got = ordering.totals_before(
        df.withColumn("b", F.floor(F.col("step") / 50)), "b", ["step"],
        {"s": ("sum", F.lit(1))}, group=["g"], whole=True,
    ).select("g", "s_all").distinct().collect()
    assert {tuple(r) for r in got} == {("hot", 900), ("b", 60), ("c", 1)}


def test_global_rank(spark):
    rows = [(random.Random(i).choice("abc"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i long").repartition(7)
    got = {(r.k, r.i): r["rank"] for r in ordering.global_rank(df, [F.desc("k"), F.asc("i")]).collect()}
    ordered = sorted(rows, key=lambda r: (-ord(r[0]), r[1]))
    assert got == {row: place for place, row in enumerate(ordered, start=1)}


def test_rank_within_spreads_a_hot_group(skewed):
    rows, df = skewed
    got = ordering.rank_within(df, ["g"], ["step"], "at").collect()
    assert len(got) == len(rows)
    assert all(r["at"] == r["step"] for r in got)


@pytest.mark.parametrize("stride", [1, 3, 10**12])
@pytest.mark.parametrize("count", [1, 2, 499, 500, 501])
def test_smallest_ids(spark, stride, count):
    values = [i * stride - 40 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "i long").repartition(5)
    got = [r.cutoff for r in ordering.smallest_ids(df, "i", count).collect()]
    assert got == ([values[count - 1]] if count <= 500 else [])


@pytest.mark.parametrize("n", [1, 2, 19, 20, 21, 700])
def test_hash_cutoff_and_position(spark, n):
    df = spark.range(n).repartition(3)
    hashed = sorted((r[1], r[0]) for r in df.select("id", seeded_hash(7, "id")).collect())
    assert ordering.hash_cutoff(df, "id", 7, 0.05) == hashed[max(1, int(n * 0.05)) - 1]
    got = {r.id: r.position for r in ordering.hash_position(df, "id", 7).collect()}
    assert got == {key[1]: place for place, key in enumerate(hashed)}


def test_hash_cutoff_of_nothing(spark):
    assert ordering.hash_cutoff(spark.range(0), "id", 7, 0.05) is None


def test_smallest_ids_with_an_outlier_and_negative_ids(spark):
    for ids in (list(range(3000)) + [1 << 62], [-5, -(1 << 62), 3, 9, 1 << 61]):
        df = spark.createDataFrame([(i,) for i in ids], "id long")
        for count in (1, 2, len(ids) - 1, len(ids)):
            assert ordering.smallest_ids(df, "id", count).first().cutoff == sorted(ids)[count - 1]
        assert ordering.smallest_ids(df, "id", len(ids) + 1).first() is None


def test_repeated_and_text_ids_are_refused_where_they_matter(spark):
    twice = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id long")
    assert ordering.smallest_ids(twice, "id", 1).first().cutoff == 1
    with pytest.raises(ValueError, match="unique"):
        ordering.smallest_ids(twice, "id", 2)
    with pytest.raises(TypeError, match="integer"):
        ordering.smallest_ids(spark.createDataFrame([("a",)], "id string"), "id", 1)
    with pytest.raises(ValueError, match="unique"):
        ordering.hash_cutoff(spark.createDataFrame([(7,)] * 6, "id long"), "id", 42, 0.5)

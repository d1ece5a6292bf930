"""Nearest vectors and best-fit packing against plain versions."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import best_fit, retrieval

SF = "/root/testdata/sf0.001"


def nearest(rows, queries, k):
    fine = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = []
    for q in queries:
        if q not in fine:
            continue
        scored = [(-round(float(fine[q] @ v / np.linalg.norm(v) / np.linalg.norm(fine[q])), 9), i)
                  for i, v in fine.items() if i != q]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def vectors(seed, n, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    rows = [(i, (centres[i % 5] + rng.normal(size=width) * 0.2).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(n // 3)]  # a third are copies
    return rows + [(5000, None), (5001, [0.0] * width), (5002, [float("nan")] + [1.0] * (width - 1)),
                   (5003, [None] + [1.0] * (width - 1)), (5004, [float("inf")] * width)]


@pytest.mark.parametrize("lists, block, probes, k", [(None, 20_000, 4, 10), (12, 15, 1, 5), (30, 7, 2, 40), (1, 9, 1, 3)])
def test_topk_is_exact(spark, monkeypatch, lists, block, probes, k):
    monkeypatch.setattr(retrieval, "BLOCK", block)
    monkeypatch.setattr(retrieval, "FIRST_PROBES", probes)
    monkeypatch.setattr(retrieval, "PRODUCTS", 50)
    rows = vectors(lists or 3, 120)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("list", F.lit("x")).repartition(5)
    asked = [i for i, _ in rows if i % 10 == 0] + [5001, 5002]
    got = retrieval.vector_topk(df, df.where(F.col("vec_id").isin(asked)), k, n_lists=lists)
    got = sorted((r.query, r["rank"], r.id, r.cosine) for r in got.collect())
    expected = nearest(rows, asked, k)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], atol=2e-9)


def test_topk_of_few_and_none(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r)[:3] for r in retrieval.vector_topk(few, few, 10).orderBy("query").collect()] == [(1, 1, 2), (2, 1, 1)]
    assert retrieval.vector_topk(few.limit(0), few, 3).count() == 0
    assert retrieval.vector_topk(few, few.limit(0), 3).count() == 0


def test_some_lists_are_left_out(spark):
    """Well separated clusters: the bound spares most lists."""
    rng = np.random.default_rng(1)
    centres = np.eye(8)
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.01).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    seen = []
    real = retrieval._compare

    def counting(index, probes, k):
        seen.append(probes.count())
        return real(index, probes, k)

    retrieval._compare = counting
    try:
        retrieval.vector_topk(df, df.where("vec_id < 40"), 5, n_lists=8).count()
    finally:
        retrieval._compare = real
    assert seen[0] == 160 and seen[1] == 0


def test_best_fit_is_that_of_a_plain_search():
    rng = random.Random(1)
    for n in (0, 1, 5, 200):
        lengths = [rng.randint(1, 50) for _ in range(n)]
        space, rows = [], [0] * n
        for i in sorted(range(n), key=lambda i: (-lengths[i], i)):
            fits = [(s, r) for r, s in enumerate(space) if s >= lengths[i]]
            if fits:
                rows[i] = min(fits)[1]
            else:
                rows[i] = len(space)
                space.append(50)
            space[rows[i]] -= lengths[i]
        assert best_fit.best_fit(lengths, 50) == rows


@pytest.mark.parametrize("cell", [20_000, 30])
def test_packing_keeps_every_token_once(spark, monkeypatch, cell):
    monkeypatch.setattr(best_fit, "CELL_DOCUMENTS", cell)
    rng = random.Random(7)
    lengths = [(i, rng.choice([0, 1, 99, 100, 101, 250, rng.randint(1, 60)])) for i in range(500)]
    lengths += [(None, 30), (None, 30), (7, 45), (900, None), (901, 1000)]
    df = spark.createDataFrame(lengths, "doc_id bigint, n bigint").withColumn("row", F.lit(1))
    packed = best_fit.pack_best_fit(df, F.col("n"), 100)
    rows = packed.collect()
    assert sum(r.length for r in rows) == sum(n or 0 for _, n in lengths)
    of_row = collections.defaultdict(list)
    for r in rows:
        of_row[r.row_id].append(r)
    for members in of_row.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 100
    once = collections.Counter(d for d, _ in lengths)
    for d, n in lengths:
        if once[d] == 1:
            own = sorted((r.start, r.length) for r in rows if r.doc_id == d)
            assert [s for s, _ in own] == list(range(0, n or 0, 100)) and sum(x for _, x in own) == (n or 0)
    report = best_fit.fill_report(packed, 100).first()
    assert report.n_rows == len(of_row) and report.fullest == 100 and report.fill > (0.95 if cell > 100 else 0.9)
    assert best_fit.pack_best_fit(df.limit(0), F.col("n"), 100).count() == 0


def test_packing_of_the_documents_is_tight(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    report = best_fit.fill_report(best_fit.pack_best_fit(docs, F.octet_length("text") + 1, 2048), 2048).first()
    assert report.fullest <= 2048 and report.fill > 0.97

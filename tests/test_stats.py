import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import stats

TEXTS = [("en", "The cat saw the dog. The dog ran"), ("en", "a dog"), ("fr", "le chat le chien le chat"),
         ("fr", "mot"), ("fr", "")]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, lang, text, "val" if i == 1 else "train") for i, (lang, text) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, split string")


def words_of(text):
    return [w.strip(".").lower() for w in text.split()]


def test_token_frequency(texts):
    counts = Counter(w for _, t in TEXTS for w in words_of(t))
    ordered = sorted(counts.items(), key=lambda p: (-p[1], p[0]))
    got = sorted((r["rank"], r.token, r.n) for r in stats.token_frequency(texts).collect())
    assert got == [(i, w, n) for i, (w, n) in enumerate(ordered, start=1)]


def test_bigrams_and_topk(texts):
    pairs = Counter()
    for _, t in TEXTS:
        w = words_of(t)
        pairs.update(zip(w, w[1:]))
    counted = stats.next_token_counts(texts)
    assert {(r.token, r.next_token): r.n for r in counted.collect()} == dict(pairs)
    top = stats.next_token_topk(counted, 2).where("token = 'the'").orderBy("rank").collect()
    assert [(r.next_token, r.n) for r in top] == [("dog", 2), ("cat", 1)]
    assert top[0].prob == pytest.approx(2 / 3)


def test_perplexity(texts):
    pairs, contexts, vocabulary = Counter(), Counter(), set()
    for _, t in TEXTS:
        w = words_of(t)
        vocabulary |= set(w)
        pairs.update(zip(w, w[1:]))
        contexts.update(w[:-1])
    for row in stats.perplexity_by_class(texts).collect():
        nats = [
            -math.log((pairs[a, b] + 1) / (contexts[a] + len(vocabulary)))
            for lang, t in TEXTS if lang == row.lang
            for a, b in zip(words_of(t), words_of(t)[1:])
        ]
        assert row.n_pairs == len(nats)
        assert row.perplexity == pytest.approx(math.exp(sum(nats) / len(nats)))


def test_dominance(texts):
    rows = {r.split: r for r in stats.dominance_audit(texts).collect()}
    train = Counter(w for i, (_, t) in enumerate(TEXTS) if i != 1 for w in words_of(t))
    top = max(train.items(), key=lambda p: (p[1], p[0]))
    assert (rows["train"].top_token, rows["train"].top_n) == top
    assert rows["train"].share == rows["train"].constant_share
    assert rows["val"].constant_share == 0.0 and rows["val"].top_token == "dog"


def filtered(logits, temperature, penalty, seen, top_k, top_p):
    """The filter as arrays: surviving item -> probability."""
    z = np.array(logits) / temperature
    z = np.where(seen, z / penalty, z)
    keep = np.ones(len(z), bool)
    if top_k is not None:
        keep &= z >= np.sort(z)[::-1][min(top_k, len(z)) - 1]
    order = [i for i in np.lexsort((np.arange(len(z)), -z)) if keep[i]]
    p = np.exp(z[order] - z.max())
    p /= p.sum()
    if top_p is not None:
        stay = np.cumsum(p) - p <= top_p
        order, p = [i for i, s in zip(order, stay) if s], p[stay] / p[stay].sum()
    return dict(zip(order, p))


@pytest.mark.parametrize("options", [
    dict(), dict(top_k=3), dict(top_p=0.6), dict(temperature=0.5, repetition_penalty=1.7, top_k=4, top_p=0.9),
    dict(top_k=1), dict(top_p=0.0), dict(top_k=1000),
])
def test_sample_candidates(spark, options):
    rng = np.random.default_rng(3)
    groups = {
        1: rng.normal(size=12).round(1).tolist(),  # ties
        2: [-1.0, -1.0, -1.0, -2.0, -2.0],  # ties at the limit, negative scores
        3: [9.0, 0.0, 0.0],  # one item above p alone
        4: [0.5],
    }
    rows = [(g, i, v, i % 2 == 0) for g, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "grp long, item int, logit double, seen boolean").repartition(5)
    got = stats.sample_candidates(df, **options).collect()
    for g, vs in groups.items():
        expected = filtered(vs, options.get("temperature", 1.0), options.get("repetition_penalty", 1.0),
                            [i % 2 == 0 for i in range(len(vs))], options.get("top_k"), options.get("top_p"))
        mine = {r.item: r.prob for r in got if r.grp == g}
        assert mine.keys() == expected.keys()
        for item, prob in expected.items():
            assert mine[item] == pytest.approx(prob)
        assert sum(r.drawn for r in got if r.grp == g) == 1


def test_draws_follow_the_probabilities(spark):
    df = spark.range(4000).select(
        F.col("id").alias("grp"), F.explode(F.array(*[F.struct(
            F.lit(i).alias("item"), F.lit(math.log(w)).alias("logit")) for i, w in enumerate((6, 3, 1))
        ])).alias("c")).select("grp", "c.*")
    drawn = stats.sample_candidates(df, seen_col=None).where("drawn")
    counts = {r.item: r["count"] for r in drawn.groupBy("item").count().collect()}
    assert sum(counts.values()) == 4000
    assert [counts[i] / 4000 for i in range(3)] == pytest.approx([0.6, 0.3, 0.1], abs=0.03)


def test_greedy(spark):
    df = spark.createDataFrame([(1, 5, 0.1), (1, 6, 0.3), (2, 9, -4.0)], "grp int, item int, logit double")
    assert {tuple(r) for r in stats.greedy_candidates(df).collect()} == {(1, 6), (2, 9)}


@pytest.fixture(scope="module")
def losses(spark):
    rows = [("train", 0, 2.0, 4, 1), ("train", 0, 4.0, 2, 1), ("train", 1, 1.0, 3, 2), ("val", 0, 7.0, 0, 1),
            ("val", 0, 3.0, 5, 3)]
    return spark.createDataFrame(rows, "split string, batch int, nats double, nbytes int, n int")


def test_split_loss_is_a_mean_of_means(losses):
    plain = {r.split: r.loss_nats for r in stats.split_loss(losses).collect()}
    assert plain == {"train": 2.0, "val": 5.0}
    weighted = {r.split: r.loss_nats for r in stats.split_loss(losses, weight_col="n").collect()}
    assert weighted == {"train": 2.0, "val": 4.0}


def test_bits_per_byte_leaves_out_tokens_without_bytes(losses):
    row = stats.bits_per_byte(losses, weight_col="n").first()
    assert row.total_nats == 2 + 4 + 2 + 9 and row.total_bytes == 4 + 2 + 6 + 15
    assert row.bits_per_byte == pytest.approx(17 / (27 * math.log(2)))


def test_compression_against_uniform(spark):
    uniform = spark.createDataFrame([("train", math.log(50304))], "split string, nats double")
    row = stats.compression_report(uniform, 50304).first()
    assert row.bits_per_token == pytest.approx(math.log2(50304)) and row.compression_ratio == pytest.approx(1)


def test_token_budget(spark):
    runs = spark.createDataFrame([("big", 135_300_000)], "run string, n_params long")
    row = stats.token_budget(runs, F.lit(64_600_000)).first()
    assert row.tokens_required == 2_706_000_000 and not row.enough
    assert row.shortfall_factor == pytest.approx(41.9, abs=0.05)


def test_corpus_stats_totals(texts):
    rows = stats.corpus_stats(texts, F.length("text"), F.octet_length("text")).collect()
    total = next(r for r in rows if r.split is None)
    assert total.n_docs == 5 and total.n_tokens == sum(len(t) for _, t in TEXTS)
    assert len(rows) == 1 + 2 + 3

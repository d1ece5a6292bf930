"""Operators over a whole corpus: mixing, n-gram model, set join, embeddings, and the pipeline."""

import collections
import math
import random
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomline.llm import embeddings, graph, mixing, ngram_lm, set_join, unit_memory
from loomline.llm import words as hashed
from tests.llm.conftest import DOCS, SF, lower, words


def test_packed_numbers_come_back():
    for n in (0, 1, 7, 1000):
        x = np.sort(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
        assert (hashed.unpack(hashed.pack(x)) == x).all()


def shingles(text):
    w = words(lower(text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingle_sets_have_the_right_sizes(texts, monkeypatch):
    tried = [None, "", " ", "a", "A b", "a b c d e", "a b c d e f ", "x " * 40, "é É", "a\x1cb c"] + list(texts.values())
    for step in (1 << 21, 50):
        monkeypatch.setattr(hashed, "STEP", step)
        got = hashed.shingle_sets(pa.array(["x", *tried], pa.string()).slice(1))
        assert [len(s) for s in got] == [len(shingles(t)) for t in tried]


def traced(run):
    """MB that stand at most and that stay."""
    tracemalloc.start()
    try:
        run()
        stays, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    return most / 1e6, stays / 1e6


def test_hashing_needs_little_memory_beside_the_text(monkeypatch):
    monkeypatch.setattr(hashed, "_powers", {})
    data = np.random.default_rng(3).integers(97, 123, 4 << 20).astype(np.uint8)
    data[5::6] = 32
    ends = np.arange(6, len(data), 6)
    most, stays = traced(lambda: unit_memory.hashes(data, ends - 6, ends))
    assert most < 40 and stays < 10  # two results of 6 MB; they were 224 and 134
    text = pa.array([data[:2 << 20].tobytes().decode()])
    most, stays = traced(lambda: [len(words) for _, words, _ in hashed.hashed_words(text)])
    assert most < 40 and stays < 10  # they were 82 and 34


def test_hashes_do_not_depend_on_the_blocks(texts, monkeypatch):
    tried = pa.array(["x" * 300, None, " ", *texts.values(), "a " * 200])
    data = np.frombuffer("".join(texts.values()).encode(), np.uint8)[:20_000]
    ends = np.sort(np.random.default_rng(4).choice(np.arange(1, len(data) + 1), 900, replace=False))
    starts = np.append(0, ends[:-1])
    found = []
    for block in (1 << 30, 1 << 18, 50, 1):
        monkeypatch.setattr(hashed, "_powers", {})
        monkeypatch.setattr(hashed, "BLOCK", min(block, 1 << 22))
        sets = [s.tolist() for s in hashed.shingle_sets(tried)]
        found.append((sets, [x.tolist() for x in unit_memory.hashes(data, starts, ends)]))
    assert all(x == found[0] for x in found)
    # the polynomial itself, of one range
    value = 0
    for byte in reversed(data[starts[7]:ends[7]].tolist()):
        value = (value * hashed._BASE + int(hashed._BYTE[byte])) % (1 << 64)
    assert int(hashed.polynomials(data, starts, ends, hashed._BYTE, hashed._BASE)[7]) == value


def components_of(links, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    expected = components_of(links, {x for p in links for x in p if p[0] != p[1]})
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == expected
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_copies(rng, n, size=60):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            copy[rng.randrange(size)] = f"n{rng.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def brute_join(rows):
    sets = [(i, frozenset(shingles(t))) for i, t in rows]
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                links.append((i, j))
    roots = components_of(links, {i for i, _ in rows})
    return sorted((i, len(s), roots[i]) for i, s in sets)


def test_set_join_is_exact(spark, texts, monkeypatch):
    rng = random.Random(4)
    shared = " ".join(f"s{i}" for i in range(55))
    tried = [t for _ in range(12) for t in near_copies(rng, 6)] + near_copies(rng, 60, 90)
    tried += [f"{shared} own {rng.random()} {rng.random()}" for _ in range(30)] + ["a b c", "A  b C", "a b", "", " "]
    tried += [" ".join(f"c{j}" for j in range(i, i + 40)) for i in range(0, 60, 3)]  # a chain of links
    rows = list(enumerate(tried, 1000)) + list(texts.items())
    # groups joined whole, with a leader, and block by block
    for piece, led, share in ((2_000_000, 10**9, 16 << 20), (2_000_000, 500, 16 << 20), (1500, 400, 1 << 15)):
        monkeypatch.setattr(set_join, "PIECE_SHINGLES", piece)
        monkeypatch.setattr(set_join, "LED_SHINGLES", led)
        monkeypatch.setattr(set_join, "SHARE_BYTES", share)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        assert sorted(map(tuple, set_join.cluster(docs).collect())) == brute_join(rows)


def test_joiner_derives_answers_and_skips_blocks():
    rng = random.Random(6)
    joiner, sets = set_join.Joiner(), []
    base = list(range(200))
    for _ in range(60):
        sets.append(sorted(set(base) - set(rng.sample(base, 6)) | {rng.randint(1000, 10**6)}))
    other = list(range(60)) + list(range(5000, 5140))  # common prefixes, but no link
    sets += [sorted(set(other) - set(rng.sample(other, 4))) for _ in range(20)]
    for s in sorted(sets, key=len):
        joiner.add(len(s), s)
    assert joiner.compared < 800 and joiner.derived > 400  # of 3160 pairs
    assert len({joiner.find(i) for i in range(80)}) == 2


def test_template_pages_are_not_compared_with_each_other():
    for vary in (0, 6):
        rng, joiner = random.Random(1), set_join.Joiner()
        own = [10 + (rng.randint(0, vary) if vary else 0) for _ in range(8000)]
        began = time.process_time()
        for i, n in sorted(enumerate(own), key=lambda x: x[1]):  # in pairs of copies, thirty shingles are everybody's
            joiner.add(30 + n, [1000 + i // 2 * 100 + k for k in range(n)] + list(range(30)))
        assert time.process_time() - began < 10 and joiner.compared < 3 * 8000
        assert len(joiner.links) == 4000 and all(not f or len(f) < 10 for f in joiner.failed)


def test_deduplicated_decides_by_row(spark):
    a, b = "one two three four five six seven", "other words make up this very text"
    rows = [(1, a), (2, a + " eight"), (3, b),  # the second has three of four shingles in common with the first
            (3, a), (None, b), (None, "a third one"), (4, ""), (4, ""), (5, None), (6, a)]
    left = set_join.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, [
        (1, a), (3, b), (None, "a third one"), (4, ""), (4, ""), (5, None)]))


def test_set_join_odd_rows(spark, odd, nothing):
    got = set_join.cluster(odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    assert all(r.component_id == r.doc_id for r in got)
    assert set_join.cluster(nothing).count() == 0
    several = [(9, "a b c d e f g"), (3, "a b c d e f g"), (9, "p q r s t u v"), (2, "p q r s t u v"), (None, "a b c d e f g")]
    roots = {(r.doc_id, r.component_id) for r in set_join.cluster(
        spark.createDataFrame(several, "doc_id bigint, text string")).collect()}
    assert roots == {(9, 2), (3, 2), (2, 2), (None, None)}
    left = set_join.deduplicated(odd)
    assert left.columns == odd.columns and left.count() == odd.count() - 1


def test_poisson_counts(spark):
    for mean in (0.0, 0.3, 2.5, 40.0, 480.0):
        n = spark.range(4000).select(mixing.poisson_count(
            1, F.col("id").cast("string"), F.lit(1), mixing.poisson_steps(F.lit(mean))).alias("n")).toPandas()["n"]
        assert abs(n.mean() - mean) <= 4 * math.sqrt(max(mean, 0.01) / 4000)
        assert mean == 0 or abs(n.var() / mean - 1) < 0.15


def test_mixing_reaches_the_weights(spark, monkeypatch):
    rows = [(i, "x" * 50, None, "big" if i % 3 else "small", 50) for i in range(9000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.replicate(docs, {"big": 1.0, "small": 3.0})
    shares = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(shares["small"] / (shares["small"] + shares["big"]) - 0.75) < 0.02
    assert abs(sum(shares.values()) - 9000) < 400
    again = {tuple(r) for r in mixing.replicate(docs.repartition(7), {"big": 1.0, "small": 3.0}).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # the other way gives the same rows
    assert {tuple(r) for r in mixing.replicate(docs, {"big": 1.0, "small": 3.0}).collect()} == again


def test_mixing_large_means_and_odd_rows(spark, odd, nothing):
    docs = spark.createDataFrame([(1, "ab", None, "s", 2), (2, "abc", None, "t", 3)], DOCS)
    got = mixing.replicate(docs, total=12_000.0)
    n = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert 2000 < n[1] < 4000 and 1500 < n[2] < 3000
    assert got.select("doc_id", "copy").distinct().count() == got.count()
    mixed = mixing.replicate(odd)
    assert mixed.columns == [c for c in odd.columns if c != "copy"] + ["copy", "rate", "shuffle_key"]
    assert mixing.replicate(nothing).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_is_kneser_ney(spark, monkeypatch, order):
    for name, size in (("PAIR_SHARE_BYTES", 1 << 16), ("WORD_SHARE_BYTES", 1 << 17), ("CHUNK_BYTES", 1 << 16),
                       ("SPLIT_BYTES", 1 << 13), ("NARROW", 3)):
        monkeypatch.setattr(ngram_lm, name, size)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    end = "</s>"
    tokens = {r.doc_id: words(lower(r.text or "")) + [end] for r in docs.collect()}
    known = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    monkeypatch.setattr(ngram_lm, "QUERY_ORDER", order)
    got = {r.doc_id: r for r in ngram_lm.op7_ngram_lm(spark, SF).collect()}
    c, pairs, triples = collections.Counter(), collections.Counter(), collections.Counter()
    for i in known:
        c.update(tokens[i])
        pairs.update(zip([end] + tokens[i], tokens[i]))
        triples.update(zip([end, end] + tokens[i], [end] + tokens[i], tokens[i]))
    n, v = sum(c.values()), len(c)
    if order == 3:
        pairs = collections.Counter((b, w) for _, b, w in triples)
    of = lambda counts: ngram_lm.discounts_of([sum(x == k for x in counts) for k in (1, 2, 3, 4)])
    cut = lambda x, by: (0, *by)[min(x, 3)]
    follows = collections.Counter(w for _, w in pairs)
    d, e, f = of(list(pairs.values())), of(list(follows.values())), of(list(triples.values()))
    total, left, total3, left3 = (collections.Counter() for _ in range(4))
    for (u, _), x in pairs.items():
        total[u] += x
        left[u] += cut(x, d)
    for (t, u, _), x in triples.items():
        total3[t, u] += x
        left3[t, u] += cut(x, f)
    rest = sum(cut(x, e) for x in follows.values()) / len(pairs)
    q = lambda w: max(follows[w] - cut(follows[w], e), 0) / len(pairs) + rest / (v + 1)

    def p(t, u, w):
        x = pairs[u, w]
        below = (max(x - cut(x, d), 0) + left[u] * q(w)) / total[u] if u in total else q(w)
        if order == 2 or (t, u) not in total3:
            return below
        x = triples[t, u, w]
        return (max(x - cut(x, f), 0) + left3[t, u] * below) / total3[t, u]

    for t, u in ((end, end), max(total3, key=total3.get), ("none", "the"), ("none", "none")):
        assert sum(p(t, u, w) for w in c) + p(t, u, "no such word") == pytest.approx(1)
    for i, own in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known) == (len(own), sum(w in c for w in own))
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert r.score == pytest.approx(sum(
            math.log10(p(t, u, w)) for t, u, w in zip([end, end] + own, [end] + own, own)), rel=1e-9)
        assert r.train_tokens == n and r.held_out == (i not in known)


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_odd_rows(spark, odd, nothing, order):
    model = ngram_lm.train(odd, order=order)
    rows = ngram_lm.score(odd, model).collect()
    assert len(rows) == odd.count() and all(r.score < 0 for r in rows)
    same = [r.score for r in rows if r.doc_id == 5]
    assert same[0] == pytest.approx(same[1])
    assert ngram_lm.score(nothing, model).count() == 0
    empty = ngram_lm.score(odd, ngram_lm.train(nothing, order=order)).collect()
    assert all(r.n_known == 0 and r.score == pytest.approx(0) for r in empty)


def test_registered_language_model_reads_two_words_before(spark, tmp_path):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    known = [i for i in range(100) if not held(i)][:60]
    probes = dict(zip([i for i in range(100) if held(i)], ["a x b", "a x d", "c x d", "c x b"]))
    texts = [(i, "a x b" if k % 2 else "c x d") for k, i in enumerate(known)] + list(probes.items()) + [(None, "a x b"), (None, "c x d")]
    spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in texts], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = ngram_lm.op7_ngram_lm(spark, str(tmp_path)).collect()
    score = {probes[r.doc_id]: r.score for r in rows if r.held_out}
    # by one word before all four are alike
    assert score["a x b"] == pytest.approx(score["c x d"]) and score["a x d"] == pytest.approx(score["c x b"])
    assert score["a x b"] > score["a x d"] + 1
    # a text without an id isn't held out, so it is learned from
    assert len(rows) == len(texts) and {r.held_out for r in rows if r.doc_id is None} == {False}
    assert {r.train_tokens for r in rows} == {4 * (len(known) + 2)}


def test_language_model_looks_up_in_steps(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = ngram_lm.train(docs, order=3)
    scores = lambda: {r.doc_id: r.score for r in ngram_lm.score(docs, model).collect()}
    once = scores()
    assert max(ngram_lm._lookups(model, model.n_tokens)) == 1
    for name, size in (("CHUNK_BYTES", 1 << 14), ("SPLIT_BYTES", 1 << 14), ("LOOKUP_RUNS", 500)):
        monkeypatch.setattr(ngram_lm, name, size)
    assert min(ngram_lm._lookups(model, model.n_tokens)[:-1]) > 1
    assert scores() == pytest.approx(once, rel=1e-12)
    model = ngram_lm.Model(0, 0, None, [0], 1, 10**7, None, None, order=3, splits=[0, 2], split_tokens=[10, 10**7])
    assert ngram_lm._lookups(model, 10**7)[0] == 1 < ngram_lm._lookups(model, 10**7)[1]


def test_language_model_files_in_other_stores_are_copied(tmp_path, monkeypatch):
    stored = ngram_lm.store(str(tmp_path), "a", {"x": np.arange(5, dtype="<i8")})
    real = ngram_lm.open_filesystem

    class Wrapped:
        def __init__(self, inner):
            self.open_input_stream = inner.open_input_stream

    monkeypatch.setattr(ngram_lm, "open_filesystem", lambda p: (Wrapped(real(p)[0]), real(p)[1]))
    assert ngram_lm.mapped.__wrapped__(*stored[0][1:]).tolist() == [0, 1, 2, 3, 4]


def vectors(seed=8):
    rng = np.random.default_rng(seed)
    out = []
    for size, noise in [(1, 0)] * 300 + [(4, 0.02)] * 20 + [(50, 0.01), (25, 0.035), (40, 0.0)]:
        center = rng.standard_normal(32)
        for _ in range(size):
            out.append((center + noise * rng.standard_normal(32) * np.linalg.norm(center) / np.sqrt(32)))
    return [x.astype(np.float32).tolist() for x in out]


@pytest.mark.parametrize("block", [1500, 16])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = list(enumerate(vectors()))
    got = {r.vec_id: r for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)).collect()}
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = sum(got[i].n_links for i in range(len(rows)))
    assert 0.98 * near.sum() <= links <= near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in got)
    roots = components_of(list(zip(*np.nonzero(near))), range(len(rows)))
    assert all(got[i].component_id == roots[i] and got[i].kept == (roots[i] == i) for i in got)


def test_embedding_odd_rows(spark):
    a, b = [1.0, 2.0], [2.0, 4.0]
    rows = [(1, a), (2, b), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (None, a), (7, []),
            (8, a), (8, a), (9, [1.0, 2.0, 0.0]), (10, [float("inf"), 0.0]), (11, [1e-30, 2e-30]), (12, [3e37, 6e37])]
    got = sorted(map(tuple, embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()), key=str)
    linked = {r[0]: r[1:] for r in got if r[0] in (1, 2, 8, 11, 12)}
    assert linked == {i: (4, 1, i == 1) for i in (1, 2, 8, 11, 12)}
    assert {r[0]: r[1:] for r in got if r[0] in (3, 4, 5, 6, 7, 9, 10)} == {i: (0, i, True) for i in (3, 4, 5, 6, 7, 9, 10)}
    assert [r for r in got if r[0] is None] == [(None, 0, None, False)]
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embeddings.near_duplicates(none).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    roots = {r[0]: r[2] for r in brute_join([(r.doc_id, r.text) for r in docs.collect()])}
    first, *_ = stages = [f for _, f in corpus_pipeline.STAGES]
    kept = first(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    single = stages[1](spark, kept, SF)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(roots.values()))
    masked = stages[2](spark, single, SF)
    assert masked.columns == docs.columns and masked.count() == single.count()
    mixed = stages[3](spark, masked, SF)
    assert mixed.columns == docs.columns
    before = {r.doc_id: r.text for r in masked.collect()}
    import public_tokenizers as P

    from loomline.llm.bpe import Bpe
    coder = Bpe(P.path(corpus_pipeline.VOCABULARY), P.PATTERN)
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == mixed.count()
    assert all(coder.decode(r.ids).decode() == before[r.doc_id] and r.n_tokens == len(r.ids) for r in got)


def test_pipeline_stages_take_odd_rows(spark, odd, nothing):
    docs = odd.drop("copy")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, nothing, SF).count() == 0

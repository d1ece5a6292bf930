"""Evaluation passages, unsafe terms and the quality model against plain versions."""

import random
import re

import pyarrow as pa
import pytest

from loomline.functions.grams import BloomFilter, Terms
from loomline.operators import quality_model, screening

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_terms_of_odd_texts():
    tried = [None, "", "a", "A-b, É漢\x00c 1_2", "  x  ", "x" * 50, "end."]
    found = Terms.of(pa.array(["before", *tried]).slice(1))
    for i, text in enumerate(tried):
        own = range(found.by_text[i], found.by_text[i + 1])
        assert [found.gram(k, 1).decode() for k in own] == terms(text)
    assert Terms.of(pa.array([], pa.string())).by_text.tolist() == [0]


def test_bloom_filter_keeps_all_members():
    import numpy as np
    rng = np.random.default_rng(1)
    members, others = rng.integers(0, 2**63, (2, 5000), dtype=np.uint64)
    bloom = BloomFilter(members)
    assert (bloom.candidates(members) == np.arange(5000)).all()
    assert len(bloom.candidates(others)) < 250


def shared(docs, items, n=13, shortest=8):
    out = []
    for d, text in docs:
        t = terms(text)
        covered, with_hits = set(), set()
        for i, item in items:
            own = terms(item)
            if len(own) < shortest:
                continue
            size = min(n, len(own))
            for k in range(len(own) - size + 1):
                for at in range(len(t) - size + 1):
                    if t[at:at + size] == own[k:k + size]:
                        covered |= set(range(at, at + size))
                        with_hits.add(i)
        spans = []
        for w in sorted(covered):
            if spans and spans[-1][1] == w:
                spans[-1][1] = w + 1
            else:
                spans.append([w, w + 1])
        out.append((d, len(t), len(with_hits), len(covered), ",".join(f"{a}:{b}" for a, b in spans), bool(with_hits)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, step", [(200_000, 4 << 20), (7, 50)])
def test_contamination_is_exact(spark, monkeypatch, block, step):
    monkeypatch.setattr(screening, "BLOCK_GRAMS", block)
    monkeypatch.setattr(screening, "STEP_BYTES", step)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 25)))) for i in range(12)]
    items += [(50, None), (51, "one two three"), (52, items[0][1]), (None, "a b c d e f g h")]
    docs = []
    for d in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if d % 3 == 0:
            words[5:5] = items[rng.randrange(12)][1].upper().replace(" ", ", ").split(" ")
        docs.append((d, " ".join(words)))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, "x A b. c\nd e--f g h")]
    found = screening.decontaminate_eval(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == shared(docs, items) and sum(r[-1] for r in got) > 20


def test_contamination_with_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert screening.decontaminate_eval(docs, items).collect()[0].contaminated is False
    assert screening.decontaminate_eval(docs.limit(0), items).count() == 0


def test_planted_passages_are_found(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    whole = {d for d, t in texts.items() for i in items.collect() if i.text in (t or "")}
    found = {r.doc_id for r in screening.decontaminate_eval(docs, items).where("contaminated").collect()}
    assert whole and whole <= found and len(found - whole) <= 0.02 * len(texts)


def plain_hits(text, patterns, allowed):
    low = text.lower()
    edge = lambda s, e: not re.match(r"[\w]", low[s - 1:s] or " ") and not re.match(r"[\w]", low[e:e + 1] or " ")
    places = lambda p: [m.start() for m in re.finditer(f"(?={re.escape(p)})", low)]
    good = [(s, s + len(p)) for p in allowed for s in places(p) if edge(s, s + len(p))]
    return sorted((s, s + len(p), p) for p in patterns for s in places(p) if edge(s, s + len(p))
                  and not any(a <= s and s + len(p) <= b for a, b in good))


def test_unsafe_spans_are_whole_words_outside_allowed_phrases():
    rng = random.Random(2)
    patterns, allowed = ("bad", "bad dog", "ugly", "é x"), ("bad dog food", "not bad")
    for _ in range(400):
        text = "".join(rng.choice(["bad", "Bad", " ", " dog", " food", "not ", "ugly", "_", "é", " x", ",", "1"]) for _ in range(12))
        assert screening.unsafe_spans(text, patterns, allowed) == plain_hits(text, patterns, allowed)


def test_gate_verdicts(spark):
    rows = [(1, "All is well"), (2, "BAD thing"), (3, "bad and ugly, bad"), (4, None), (5, ""), (6, "badly İ ugliest")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_hits, r.n_terms, r.verdict) for r in screening.safety_gate(docs, ["Bad", "ugly", ""]).collect()}
    assert got == {1: (0, 0, "pass"), 2: (1, 1, "review"), 3: (3, 2, "reject"), 4: (0, 0, "pass"), 5: (0, 0, "pass"),
                   6: (0, 0, "pass")}
    assert {r.verdict for r in screening.safety_gate(docs, []).collect()} == {"pass"}


def test_terms_learnt_from_labels_find_unlabelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 4 <> 2")
    terms_ = [r.term for r in screening.unsafe_terms(docs, train).collect()]
    assert 5 <= len(terms_) <= 100
    gate = screening.safety_gate(docs, terms_).join(labels.where("doc_id % 4 = 2"), "doc_id")
    counts = {(r.toxic, r.caught): r["count"] for r in gate.selectExpr("toxic", "n_terms > 0 as caught").groupBy("toxic", "caught").count().collect()}
    caught, missed = counts.get((1, True), 0), counts.get((1, False), 0)
    # a third of the documents labelled as toxic hold none of the words that mark the others
    assert caught >= 0.5 * (caught + missed) > 0
    assert counts.get((0, True), 0) <= 0.02 * counts.get((0, False), 0)


def test_quality_model_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit_quality(docs, labels)
    scored = quality_model.quality_model(docs, model)
    assert scored.count() == docs.count()
    counts = {(r.label, r.score): r.n for r in quality_model.held_out_report(scored, labels).collect()}
    total = sum(counts.values())
    right = sum(n for (label, score), n in counts.items() if (score >= 3) == (label == 1))
    majority = max(sum(n for (label, _), n in counts.items() if label == x) for x in (0, 1))
    assert total > 50 and right > majority and right >= 0.9 * total
    low = [score for (label, score), n in counts.items() for _ in range(n) if label == 0]
    high = [score for (label, score), n in counts.items() for _ in range(n) if label == 1]
    assert sum(high) / len(high) > sum(low) / len(low) + 2
    # held-out labels are not used, and odd rows are scored
    changed = labels.selectExpr("doc_id", "1 - quality as quality").where(quality_model.held_out()).union(
        labels.select("doc_id", "quality").where(~quality_model.held_out()))
    again = quality_model.fit_quality(docs, changed)
    assert again.stages[-1].coefficients.toArray().tolist() == model.stages[-1].coefficients.toArray().tolist()
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "   \n "), (2, "x" * 100_000)], "doc_id bigint, text string")
    assert all(0 <= r.score <= 5 for r in quality_model.quality_model(odd, model).collect())

"""Ranked search, conversation trie and packing against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomline.llm import packing, prefix_trie, search
from tests.llm.conftest import SF, lower, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=10):
    """(item number, rank, doc_id, score) by the formula, one document at a time."""
    counts = [(d, collections.Counter(TERM.findall(lower(t or "")))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for i, text in enumerate(items):
        scores = []
        for d, c in counts:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in TERM.findall(lower(text or "")) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    a = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit("x"))
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").withColumn("rank", F.lit(1))
    return sorted(map(tuple, search.rank_documents(a, b, **options).collect()), key=repr)


SEARCHED = (
    [(i, f"common w{i % 7} W{i % 3}-x{i % 5}é {'common ' * (i % 4)}") for i in range(300)]
    + [(1000 + i, "one text that stands here often") for i in range(40)]  # ties
    + [(7, "one text that stands here often"), (None, "one text that stands here often"), (None, None), (8, ""),
       (9, "!!! ..."), (2000, "common " * 5000 + "rare end"), (2001, "ÉÀ É éÀ 漢字 1a2b")])
SOUGHT = ["common w1", "one text often often", "RARE", None, "", "...", "é x1é É éÀ 漢字", "one text often often",
          " ".join(f"w{i}" for i in range(7)) + " common" * 20, "1a2b"]


@pytest.mark.parametrize("limits", [{}, {"UPDATES": 7, "INDEX_BYTES": 40, "MERGE_GROUPS": 2}])
def test_ranked_search_is_exact(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(search, name, value)
    assert found(spark, SEARCHED, SOUGHT) == ranked(SEARCHED, SOUGHT)


def test_ranked_search_k_and_nothing(spark):
    assert found(spark, SEARCHED, SOUGHT, k=3) == ranked(SEARCHED, SOUGHT, 3)
    assert found(spark, [], SOUGHT) == [] and found(spark, SEARCHED, []) == []
    assert found(spark, [(1, None)], ["a"]) == [] and found(spark, SEARCHED, [None, ""]) == []


def test_ranked_search_odd_rows(odd, spark):
    items = spark.createDataFrame([(None, "twice the same"), (1, "id")], "item_id bigint, text string")
    rows = search.rank_documents(odd, items).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in rows if r.item_id is None] == [(None, 1, 5), (None, 2, 5)]
    assert [(r.rank, r.doc_id) for r in rows if r.item_id == 1] == [(1, None)]


def nodes_of(turns):
    """The contract of the trie, said plainly, over (conv_id, turn, role, text)."""
    lists = collections.defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            lists[c].append((turn is not None, turn or 0, digest, role, text))
    lists = {c: [t[3:] for t in sorted(x)] for c, x in lists.items()}
    full = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(lists.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, s in full.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * len(words(p[-1][1])) if p else 0
    return sorted(
        (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(who) if full[c] == p).encode()).hexdigest())
        for p, who in members.items())


def tried_turns(seed, n):
    """Few distinct turns, so that long prefixes are shared, and a third of the conversations alike."""
    rng = random.Random(seed)
    out = []
    for c in range(n):
        alike = c % 3 == 0
        for t in range(4 if alike else rng.randint(1, 7)):
            role = "user" if alike else rng.choice(["user", "assistant", None, ""])
            text = f"same words {t}" if alike else rng.choice(["a b", "c", None, "", "a  b", "d e\x1cf"])
            out.append((c, None if rng.random() < 0.02 else t, role, text))
    out += [(500, 1, "user", "x y"), (500, 1, "user", "x y"), (500, 1, "user", "b"), (None, 1, "user", "lost"),
            (501, None, None, None), (-5, 1, "user", "below"), (-20, 1, "user", "zero")]
    rng.shuffle(out)
    return out


def trie_of(spark, turns):
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumn("words", F.lit("x")).withColumn("depth", F.lit(0.5))
    return sorted(map(tuple, prefix_trie.trie(df).collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("seed, n, task, piece", [(1, 60, 50_000, 65_536), (2, 300, 40, 65_536), (3, 200, 6, 2)])
def test_trie_is_exact(spark, monkeypatch, seed, n, task, piece):
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", task)
    monkeypatch.setattr(prefix_trie, "ENDS_PIECE", piece)
    turns = tried_turns(seed, n)
    assert trie_of(spark, turns) == nodes_of(turns)


def test_trie_of_copies_only(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", 5)
    turns = [(c, t, "user", f"turn {t}") for c in range(0, 400, 20) for t in range(3)]
    assert trie_of(spark, turns) == nodes_of(turns)


def test_trie_of_nothing_and_of_one_long_conversation(spark):
    assert trie_of(spark, []) == []
    turns = [(40, t, "user", f"{t} words here") for t in range(3000)]
    rows = trie_of(spark, turns)
    assert len(rows) == 3001 and all(r[3] == 1 and r[5] == 1 and r[6] == 0 for r in rows)


def test_range_minimum_searches():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 64, 100):
        values = rng.integers(0, 5, n)
        table = prefix_trie.RangeMinimum(values)
        at, least = np.repeat(np.arange(n), 7), np.tile(np.arange(-1, 6), n)
        for i, d, r, low in zip(at, least, table.right(at, least), table.left(at, least)):
            assert r == max([j for j in range(i, n) if all(values[i + 1:j + 1] >= d)])
            assert low == min([j for j in range(i + 1) if all(values[j + 1:i + 1] >= d)])


PATH = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    None, "", " ", "\n\t", "Hello, WORLD's don't 123 4.5", "<|endoftext|> a<|startoftext|>b", "É́é ́x à",
    "ΑΣ ΣΑΣ İstanbul ǅ ß ﬁ ①", "a\x85b\xa0c d\x1ce\x1f", "漢字 かな 한국어 \U0001F600‍\U0001F525", "x" * 5000,
    "ªº µ²¼ ×÷ àÿ įĮ", "'s 'll 'LL ’s", "\x00 \x7f �", "word " * 3000, "a" * 2047, "the " * 2047, "the " * 2046, "the " * 2048,
    "the " * 4096]


def check_packing(pieces, texts, tiers=packing.TIERS, with_ids=False):
    """Every id once, gapless sequences, right digests; returns tokens and padding."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in texts.items()}
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
    assert set(of_doc) == set(ids)
    for d, rows in of_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            own = ids[d][at:at + r.length]
            assert (r.start, r.doc_tokens) == (at, len(ids[d])) and len(own) == r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
            assert not with_ids or list(r.ids) == own
            at += r.length
        assert at == len(ids[d])
    padding = 0
    for rows in of_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= tiers[-1] and {r.window for r in rows} == {packing.padded(at, tiers)}
        padding += packing.padded(at, tiers) - at
    return sum(map(len, ids.values())), padding


def test_packing_holds_every_token_once(spark, documents, texts, monkeypatch):
    odd = {10_000 + i: t for i, t in enumerate(ODD_TEXTS)}
    docs = documents.select("doc_id", "text").union(
        spark.createDataFrame(list(odd.items()), "doc_id bigint, text string"))
    for cell, with_ids in ((16 << 20, False), (50_000, True)):
        monkeypatch.setattr(packing, "CELL_BYTES", cell)
        rows = packing.pack(docs, PATH, with_ids=with_ids).collect()
        tokens, padding = check_packing(rows, {**texts, **odd}, with_ids=with_ids)
        cells = {r.sequence_id >> 32 for r in rows}
        assert padding == 0 and len({r.sequence_id for r in rows if r.window < 256}) <= 8 * len(cells)


def test_packing_steps_have_equal_sizes(spark, documents):
    rows = packing.pack(documents, PATH, step_tokens=4096).select("sequence_id", "window", "step").distinct().collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.step] += r.window
    assert set(list(sorted(sizes.items()))[:-1]) and all(s == 4096 for _, s in sorted(sizes.items())[:-1])


def test_plan_uses_shorter_tiers_first():
    rng = random.Random(4)
    for n in (0, 1, 2, 50, 400):
        lengths = [rng.choice([rng.randint(1, 2047), rng.randint(1, 300), 256, 1024]) for _ in range(n)]
        sequences = packing.plan(lengths)
        have = collections.defaultdict(list)
        for s in sequences:
            for i, a, k in s:
                have[i] += range(a, a + k)
        assert {i: sorted(x) for i, x in have.items()} == {i: list(range(x)) for i, x in enumerate(lengths)}
        totals = [sum(k for _, _, k in s) for s in sequences]
        assert all(t & (t - 1) == 0 for t in totals) and sum(t not in packing.TIERS for t in totals) <= 10
    assert packing.plan([1500, 500, 48, 700]) == [
        [(0, 0, 1500), (1, 0, 500), (2, 0, 48)], [(3, 0, 512)], [(3, 512, 128)], [(3, 640, 32)], [(3, 672, 16)],
        [(3, 688, 8)], [(3, 696, 4)]]


def test_packing_odd_rows(spark, odd, nothing):
    assert packing.pack(nothing, PATH).count() == 0
    rows = packing.pack(odd, PATH).collect()
    assert sum(r.doc_id == 5 for r in rows) >= 2 and sum(r.doc_id is None for r in rows) >= 2
    lengths = [r.length for r in rows]
    assert min(lengths) >= 1
    with pytest.raises(ValueError):
        packing.pack(odd, PATH, tiers=(300, 2048))


def test_words_are_encoded_as_in_whole_texts(texts):
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.WordEncoder(PATH)
    assert encoder.by_word
    for text in [t for t in [*ODD_TEXTS, *texts.values()] if t]:
        assert encoder.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    other = packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.encode("a  b c".encode()).tolist() == plain.encode("a  b c", add_special_tokens=False).ids


def test_queries_read_the_given_tables(spark):
    assert search.op11_ranked_search(spark, SF).count() > 0
    rows = packing.op13_packing(spark, SF)
    assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

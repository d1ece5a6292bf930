import pytest
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv
from loomline.functions.hashing import seeded_hash
from loomline.operators import sequence


def docs(spark, token_lists, partitions=4):
    rows = [(i, "train", tokens) for i, tokens in enumerate(token_lists)]
    return spark.createDataFrame(
        rows, "doc_id long, split string, tokens array<int>"
    ).repartition(partitions)


def placed(df):
    return sequence.document_spans(df, F.size("tokens"))


def stream_of(spark, token_lists):
    order = {r[0]: r[1] for r in spark.range(len(token_lists)).select(
        "id", seeded_hash(42, "id")).collect()}
    return [t for i in sorted(order, key=lambda i: (order[i], i)) for t in token_lists[i]]


LISTS = [[i] * (i % 9) + [fv.EOT] for i in range(60)] + [list(range(1000, 1400)) + [fv.EOT]]


@pytest.mark.parametrize("n", [1, 2, 19, 20, 21, 400])
def test_split_is_exact_and_independent_of_partitions(spark, n):
    counts = set()
    for partitions in (1, 7):
        split = sequence.split_train_val(
            spark.range(n).withColumnRenamed("id", "doc_id").repartition(partitions))
        val = frozenset(r.doc_id for r in split.where("split = 'val'").collect())
        assert len(val) == max(1, int(n * 0.05))
        counts.add(val)
    assert len(counts) == 1


def test_shuffle_is_a_permutation(spark):
    df = spark.range(300).withColumnRenamed("id", "doc_id")
    places = {r.doc_id: r.position for r in sequence.shuffle_documents(df).collect()}
    assert sorted(places.values()) == list(range(300))
    other = {r.doc_id: r.position for r in sequence.shuffle_documents(df, seed=1).collect()}
    assert places != other and any(places[i] != i for i in places)


def test_flatten_follows_the_shuffled_order(spark):
    rows = sequence.flatten_token_stream(placed(docs(spark, LISTS))).collect()
    by_pos = sorted((r.pos, r.token) for r in rows)
    assert [p for p, _ in by_pos] == list(range(len(by_pos)))
    assert [t for _, t in by_pos] == stream_of(spark, LISTS)


@pytest.mark.parametrize("size", [1, 5, 64, 5000])
def test_pack_concat_keeps_every_token_in_order(spark, size):
    packed = sequence.pack_concat(placed(docs(spark, LISTS)), size).collect()
    blocks = [r.tokens for r in sorted(packed, key=lambda r: r.block_no)]
    assert [t for b in blocks for t in b] == stream_of(spark, LISTS)
    assert all(len(b) == size for b in blocks[:-1])


@pytest.mark.parametrize("size", [1, 3, 50, 5000])
def test_split_stream_recovers_documents(spark, size):
    tail = stream_of(spark, LISTS) + [5, 6, 7]
    stream = spark.createDataFrame(
        [("train", p, t) for p, t in enumerate(tail)], "split string, pos long, token int")
    found = sequence.split_stream_at_eot(sequence.blocks_of_stream(stream, size)).collect()
    expected, current = [], []
    for t in tail:
        current.append(t)
        if t == fv.EOT:
            expected.append(current)
            current = []
    expected.append(current)
    got = {}
    for r in sorted(found, key=lambda r: (r.doc_no, r.piece_no)):
        got.setdefault(r.doc_no, []).extend(r.tokens)
    assert [got[i] for i in sorted(got)] == expected
    small = sequence.split_stream_at_eot(sequence.blocks_of_stream(stream, size), blocks_per_piece=2)
    sizes = {r.doc_no: (r.n_tokens, r.n_pieces) for r in sequence.stream_documents(small).collect()}
    starts = [sum(map(len, expected[:i])) for i in range(len(expected))]
    assert sizes == {
        i: (len(t), ((starts[i] + len(t) - 1) // size - starts[i] // size) // 2 + 1)
        for i, t in enumerate(expected)}


def test_a_stream_without_ends_comes_in_pieces(spark):
    stream = spark.createDataFrame(
        [("train", p, p % 7) for p in range(1000)], "split string, pos long, token int")
    found = sequence.split_stream_at_eot(
        sequence.blocks_of_stream(stream, 10), blocks_per_piece=8).collect()
    assert {r.doc_no for r in found} == {0}
    assert max(r.n_tokens for r in found) == 80
    joined = [t for r in sorted(found, key=lambda r: r.piece_no) for t in r.tokens]
    assert joined == [p % 7 for p in range(1000)]


def test_sample_blocks_are_stretches_of_the_stream(spark):
    stream = stream_of(spark, LISTS)
    size = 16
    blocks = sequence.pack_concat(placed(docs(spark, LISTS)), size)
    draws = spark.range(200).withColumnRenamed("id", "draw")
    windows = sequence.sample_blocks(blocks, draws, F.lit(len(stream)), size).collect()
    assert len(windows) == 200
    for w in windows:
        assert 0 <= w.start < len(stream) - size
        assert w.tokens == stream[w.start:w.start + size + 1]
    pairs = sequence.lm_pairs(sequence.sample_blocks(blocks, draws, F.lit(len(stream)), size))
    for r in pairs.collect():
        assert len(r.x) == len(r.y) == size and r.x[1:] == r.y[:-1]


def test_fim_cuts_into_three_parts(spark):
    lists = [list(range(n)) for n in (0, 1, 2)] + [list(range(10, 10 + n)) for n in range(3, 200)]
    done = sequence.fim_transform(docs(spark, lists), "doc_id", fim_rate=1.0).collect()
    modes = set()
    for r in done:
        original = lists[r.doc_id]
        modes.add(r.mode)
        if len(original) < 3:
            assert r.mode == "none" and r.tokens == original
            continue
        p, m, s = (r.tokens.index(t) for t in (fv.FIM_PREFIX, fv.FIM_MIDDLE, fv.FIM_SUFFIX))
        if r.mode == "psm":
            prefix, suffix, middle = r.tokens[p + 1:s], r.tokens[s + 1:m], r.tokens[m + 1:]
        else:
            suffix, prefix, middle = r.tokens[s + 1:p], r.tokens[p + 1:m], r.tokens[m + 1:]
        assert prefix and middle and suffix
        assert prefix + middle + suffix == original
    assert modes == {"none", "psm", "spm"}


def test_fim_rates(spark):
    lists = [list(range(20))] * 400
    none = sequence.fim_transform(docs(spark, lists), "doc_id", fim_rate=0.0)
    assert none.where("mode <> 'none'").count() == 0
    half = sequence.fim_transform(docs(spark, lists), "doc_id", fim_rate=0.5, spm_rate=0.0)
    counts = {r["mode"]: r["count"] for r in half.groupBy("mode").count().collect()}
    assert set(counts) == {"none", "psm"} and 150 < counts["psm"] < 250


@pytest.mark.parametrize("extra", [-10, -4, 0, 1, 3])
def test_pad_and_mask(spark, extra):
    size = 12
    tokens = list(range(1, size + extra + 1))
    row = sequence.fim_pad_mask(docs(spark, [tokens]), size).first()
    fitted = (tokens + [fv.FIM_PAD] * size)[:size]
    assert row.x == fitted[:-1]
    assert row.y == [-1 if t == fv.FIM_PAD else t for t in fitted[1:]]
    assert len(row.x) == len(row.y) == size - 1


@pytest.mark.parametrize("per_piece, missing", [(8, ()), (100, ()), (1, ()), (8, range(900, 2100))])
def test_documents_over_stretches_of_blocks(spark, per_piece, missing):
    """5,000 blocks: documents, and pieces of them, lie over the ends of the stretches of 1,024 or more blocks."""
    ends = {3, 4, 700, 2046, 2047, 2048, 4097, 6145, 9000, 9999}
    token = F.when(F.col("pos").isin(sorted(ends)), fv.EOT).otherwise(F.col("pos") % 7)
    stream = spark.range(10_003).select(F.lit("train").alias("split"), F.col("id").alias("pos"),
                                        token.cast("int").alias("token"))
    blocks = sequence.blocks_of_stream(stream, 2).where(~F.col("block_no").isin([*missing]) if missing else F.lit(True))
    wanted, doc, begun = {}, 0, 0
    for pos in range(10_003):
        if pos // 2 in missing:
            continue
        wanted.setdefault((doc, (pos // 2 - begun) // per_piece), []).append(fv.EOT if pos in ends else pos % 7)
        if pos in ends:
            doc, begun = doc + 1, pos // 2 + pos % 2
    found = sequence.split_stream_at_eot(blocks, blocks_per_piece=per_piece)
    got = {(r.doc_no, r.piece_no): r for r in found.collect()}
    assert {k: r.tokens for k, r in got.items()} == wanted
    assert all(r.n_tokens == len(r.tokens) for r in got.values())
    sizes = {r.doc_no: (r.n_pieces, r.n_tokens) for r in sequence.stream_documents(found).collect()}
    assert sizes == {d: (sum(k[0] == d for k in wanted), sum(len(v) for k, v in wanted.items() if k[0] == d))
                     for d in {k[0] for k in wanted}}


def test_a_split_shuffles_its_tokens_once_and_lengths_without_them(spark):
    def shuffles(df):
        lines = df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()
        return [x for x in lines[1].splitlines() if "Exchange hashpartitioning" in x], lines[0]

    blocks = spark.createDataFrame([("train", 0, [1, fv.EOT]), ("train", 1, [2])],
                                   "split string, block_no long, tokens array<int>")
    found = sequence.split_stream_at_eot(blocks)
    assert not any("doc_no" in x for x in shuffles(found)[0])
    assert "slice(" not in shuffles(sequence.stream_documents(found))[1]
    assert "slice(" in shuffles(found)[1]

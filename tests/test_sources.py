import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv
from loomline.operators import sequence, tokens
from loomline.plans import prepare
from loomline.sources import samples, token_dataset, tree


@pytest.fixture(scope="module")
def code_tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    body = "x = 1  # padding padding\n" * 10
    for name in ("a.py", "__init__.py", "_private/__init__.py", "__pycache__/c.py",
                 "x.egg-info/d.py", ".hidden/e.py", ".dot.py", "tests/test_f.py", "deep/er/g.py",
                 "notes.txt"):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    (root / "tiny.py").write_text("x = 1\n")
    (root / "edge.py").write_text("y" * 100)
    (root / "huge.py").write_text("z" * 100_001)
    (root / "bad.py").write_bytes(b"\xff" + body.encode())
    (root / "later.py").write_bytes(b"x" * 9000 + b"\xff")
    (root / "deep" / "crlf.py").write_bytes(b"a = 1\r\n" * 30)
    return root


def test_scan_code_tree(spark, code_tree):
    found = {r.path: r for r in tree.scan_code_tree(spark, [str(code_tree)]).collect()}
    names = {p[len(str(code_tree)) + 1:] for p in found}
    assert names == {"a.py", "__init__.py", "_private/__init__.py", "tests/test_f.py", "deep/er/g.py",
                     "edge.py", "later.py", "deep/crlf.py"}
    for path, row in found.items():
        content = open(path, "rb").read()
        assert row.content == content and row.size == len(content)


def test_missing_root_is_empty(spark, tmp_path):
    assert tree.list_code_tree(spark, [str(tmp_path / "none")]).count() == 0


def corpus(spark, n=50):
    rows = [(i, "src" + str(i % 3), f"text {i} é" * (i % 7 + 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    encoded = tokens.encode_document(df, envelope="text")
    return sequence.split_train_val(encoded, 0.2)


def test_flat_files_round_trip(spark, tmp_path):
    df = corpus(spark)
    out = str(tmp_path / "tokens")
    token_dataset.write_token_dataset(df, out)
    spans = sequence.document_spans(df, F.size("tokens"))
    expected = {(r.split, r.pos): r.token for r in sequence.flatten_token_stream(spans).collect()}
    for chunk in (13, 1 << 20):
        back = token_dataset.read_token_dataset(spark, out, chunk).collect()
        got = {(r.split, r.start + i): t for r in back for i, t in enumerate(r.tokens)}
        assert got == expected
        assert max(len(r.tokens) for r in back) <= chunk
    manifest = token_dataset.read_manifest(spark, out).collect()
    assert sum(r.n_docs for r in manifest) == 50


def test_column_order_of_flat_files(spark, tmp_path):
    df = spark.createDataFrame([("train", "b", 0, [3]), ("train", "a", 1, [2]), ("train", "a", 0, [1])],
                               "split string, shard string, row_no long, tokens array<int>")
    token_dataset.write_token_dataset(df, str(tmp_path / "t"), order=("shard", "row_no"))
    back = token_dataset.read_token_dataset(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [t for r in back for t in r.tokens] == [1, 2, 3]


def test_one_large_unit_becomes_many_parts(spark, tmp_path):
    rows = [("train", "m", i, [i]) for i in range(900)] + [("train", u, i, [1000 + i]) for u in "az" for i in range(5)]
    df = spark.createDataFrame(rows, "split string, shard string, row_no long, tokens array<int>").repartition(3)
    token_dataset.write_token_dataset(df, str(tmp_path / "t"), order=("shard", "row_no"))
    manifest = token_dataset.read_manifest(spark, str(tmp_path / "t")).collect()
    assert max(r.n_docs for r in manifest) <= 114 and len(manifest) >= 8
    back = token_dataset.read_token_dataset(spark, str(tmp_path / "t")).orderBy("start").collect()
    small = list(range(1000, 1005))
    assert [t for r in back for t in r.tokens] == small + list(range(900)) + small


def test_token_that_does_not_fit_fails(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", [1, 65_536])], "doc_id long, split string, tokens array<int>")
    with pytest.raises(PySparkException):
        token_dataset.write_token_dataset(df, str(tmp_path / "t"))


def test_token_table_round_trip(spark, tmp_path):
    df = corpus(spark)
    token_dataset.write_token_table(df, str(tmp_path / "t"))
    back = token_dataset.read_token_table(spark, str(tmp_path / "t"))
    assert {(r.doc_id, r.split, tuple(r.tokens)) for r in back.collect()} == {
        (r.doc_id, r.split, tuple(r.tokens)) for r in df.collect()}


def test_meta_json(spark, tmp_path):
    meta = token_dataset.corpus_meta(corpus(spark), lang_col=None, shard_col="source")
    token_dataset.write_corpus_meta(meta, str(tmp_path / "m"))
    part = next((tmp_path / "m").glob("*.json"))
    written = json.loads(part.read_text())
    assert written["special_tokens"] == fv.SPECIAL_TOKENS
    assert written["num_val_docs"] == 10 and written["num_train_docs"] == 40
    assert written["vocab_size"] == 50304 and written["num_train_shards"] == 3


def test_combine_needs_a_source(spark):
    with pytest.raises(ValueError):
        samples.combine_sources(None, None)
    one = samples.combine_sources(spark.range(2), None)
    assert {r.origin for r in one.collect()} == {"local"}


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shards")
    for number in (0, 1, 2, 9):
        rows = [(f"shard {number} row {i}",) for i in range(5)] + [("  ",), (None,)]
        spark.createDataFrame(rows, "text string").toPandas().to_parquet(
            folder / f"shard_{number:05d}.parquet")
    (folder / "shard_00003.parquet.tmp").write_text("half")
    return folder


def test_shard_paths(shards):
    train, val = samples.shard_paths(str(shards), "shard_00009.parquet", 2)
    assert [p[-13:] for p in train] == ["00000.parquet", "00001.parquet"] and val.endswith("9.parquet")
    assert len(samples.shard_paths(str(shards), "shard_00009.parquet")[0]) == 3
    with pytest.raises(ValueError):
        samples.shard_paths(str(shards), "shard_00077.parquet")


def test_select_shards_by_column(spark):
    df = spark.createDataFrame([(s,) for s in "dabcde"], "shard string")
    got = samples.select_shards(df, "shard", "b", 2).collect()
    assert sorted((r.shard, r.split) for r in got) == [("a", "train"), ("b", "val"), ("c", "train")]
    assert samples.select_shards(df, "shard", "b").count() == 6


def read_text(spark, out, split):
    chunks = token_dataset.read_token_dataset(spark, f"{out}/tokens").where(F.col("split") == split)
    return [t for r in chunks.orderBy("start").collect() for t in r.tokens]


def test_prepare_text_shards_keeps_the_order(spark, shards, tmp_path):
    meta = prepare.prepare_text_shards(spark, str(shards), str(tmp_path / "o"),
                                       pinned="shard_00009.parquet", num_shards=2).first()
    text = bytes(t for t in read_text(spark, tmp_path / "o", "train") if t != fv.EOT).decode()
    assert text == "".join(f"shard {n} row {i}" for n in (0, 1) for i in range(5))
    assert meta.num_train_shards == 2 and meta.vocab_size == 50257
    assert read_text(spark, tmp_path / "o", "val").count(fv.EOT) == 5


def test_prepare_python_code_from_both_sources(spark, code_tree, tmp_path):
    rows = [(i, "s" * (150 + i)) for i in range(12)] + [(12, None)]
    table = spark.createDataFrame(rows, "doc_id long, content string")
    meta = prepare.prepare_python_code(
        spark, str(tmp_path / "o"), source="both", code_dirs=[str(code_tree)], sample_table=table,
        max_samples=10, ratio=0.1).first()
    assert meta.num_train_docs + meta.num_val_docs == 8 + 10
    assert meta.num_val_docs == 1 and meta.languages == ["python"]
    train = read_text(spark, tmp_path / "o", "train")
    assert train.count(fv.EOT) == 17 == train.count(fv.LANGUAGE_IDS["python"])
    assert 13 not in train  # carriage returns are gone


def test_prepare_multilang(spark, tmp_path):
    rows = [(i, "c" * 200, ["python", "c++", "cobol"][i % 3]) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, content string, dataset_lang string")
    meta = prepare.prepare_multilang_code(
        table, str(tmp_path / "o"), languages=["python", "cpp"], max_per_language=8).first()
    assert meta.num_train_docs + meta.num_val_docs == 16
    assert meta.languages == ["cpp", "python"]

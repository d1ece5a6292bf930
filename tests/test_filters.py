import random

import pytest
from pyspark.sql import functions as F

from loomline.operators import caps, filters
from loomline.functions.tokenizers import BYTES


def ids(df):
    return {r[0] for r in df.select("id").collect()}


@pytest.fixture(scope="module")
def lengths(spark):
    sizes = [99, 100, 101, 49_999, 50_000, 99_999, 100_000, 100_001]
    rows = [(f"a{n}", "x" * n) for n in sizes] + [("e50", "é" * 50), ("e49", "é" * 49)]
    return spark.createDataFrame(rows, "id string, text string")


def test_byte_size_is_inclusive(lengths):
    kept = ids(filters.filter_byte_size(lengths))
    assert kept == {"a100", "a101", "a49999", "a50000", "a99999", "a100000", "e50"}


def test_char_length_is_exclusive(lengths):
    assert ids(filters.filter_char_length(lengths)) == {"a101", "a49999", "a50000", "a99999"}
    assert ids(filters.filter_char_length(lengths, high=50_000)) == {"a101", "a49999"}


def test_blank_agrees_with_strip(spark):
    texts = ["", " \t\n", "  ", "\x1c\x1d\x1e\x1f", "\x85", "​", "᠎", "a",
             " b ", "　x", "\n\n \n", "\x00"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, None)]
    kept = ids(filters.filter_blank(spark.createDataFrame(rows, "id int, text string")))
    assert kept == {i for i, t in enumerate(texts) if t.strip()}


def reader_accepts(path):
    try:
        with open(path, encoding="utf-8") as f:
            f.read(100)
        return True
    except UnicodeDecodeError:
        return False


def test_utf8_probe_agrees_with_a_text_reader(spark, tmp_path):
    rng = random.Random(5)
    long_text = ("aé€😀" * 3000).encode()
    samples = [
        b"", b"plain", b"\xc3\x28", b"ok" * 60 + b"\xe2\x82", b"short\xe2\x82", b"\xff",
        long_text, long_text + b"\xff", b"x" * 8191 + "é".encode(), b"x" * 8190 + "€".encode(),
        b"x" * 8189 + "😀".encode(), b"x" * 8191 + b"\xc3\x28", b"x" * 8192 + b"\xff",
        b"x" * 8190 + b"\xe0\x80\x80", b"x" * 8190 + b"\xed\xa0\x80", b"x" * 8191 + b"\x80",
        b"y" * 99 + b"\xe2", b"y" * 100 + b"\xe2", "é".encode() * 99 + b"\xf0\x9f",
    ]
    for _ in range(60):
        body = bytearray(("aé€😀" * rng.randint(1, 1200)).encode()[: rng.randint(1, 9000)])
        if rng.random() < 0.3:
            body[rng.randrange(len(body))] = rng.choice([0x80, 0xC3, 0xE2, 0xF0, 0xFF])
        samples.append(bytes(body))
    expected = set()
    for i, content in enumerate(samples):
        path = tmp_path / str(i)
        path.write_bytes(content)
        if reader_accepts(path):
            expected.add(i)
    df = spark.createDataFrame(
        [(i, bytearray(c)) for i, c in enumerate(samples)], "id int, content binary"
    )
    assert ids(filters.filter_utf8(df)) == expected
    assert 0 < len(expected) < len(samples)


def test_lossy_text_drops_bad_bytes_and_unifies_line_ends(spark):
    raw = [b"a\r\nb\rc\n", b"bad\xff byte\r\n", "é€".encode() + b"\xe2\x82", None]
    df = spark.createDataFrame([(c and bytearray(c),) for c in raw], "content binary")
    got = [r[0] for r in df.select(filters.lossy_text(F.col("content"))).collect()]
    assert got == ["a\nb\nc\n", "bad byte\n", "é€", None]


def test_paths_keep_tests_and_drop_build_products(spark):
    paths = ["p/a.py", "p/__pycache__/c.py", "p/x.egg-info/d.py", "p/tests/test_f.py", "p/__init__.py"]
    df = spark.createDataFrame([(p, p) for p in paths], "id string, path string")
    assert ids(filters.filter_paths(df)) == {"p/a.py", "p/tests/test_f.py", "p/__init__.py"}


def test_funnel_is_cumulative(spark):
    df = spark.range(100)
    rows = filters.filter_funnel(df, {
        "even": F.col("id") % 2 == 0, "small": F.col("id") < 10, "unknown": F.lit(None) == 1,
    }).collect()
    assert [(r.stage, r.rows_left) for r in rows] == [
        ("input", 100), ("even", 50), ("small", 5), ("unknown", 0)]


def test_cap_examined_counts_raw_rows(spark):
    rows = [(i, "x" * (200 if i % 2 else 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = caps.cap_examined(df, 11)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 7, 9]
    assert caps.cap_examined(df, 1000).count() == 25


def test_cap_per_language_counts_accepted_rows(spark):
    rows = [(i * 7_000_000_007, "en" if i % 3 else "de", "x" * (200 if i % 2 else 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    kept = caps.cap_per_language(df, 20, ["en", "de", "none"]).collect()
    for lang in ("en", "de"):
        expected = [r[0] for r in rows if r[1] == lang and len(r[2]) > 100][:20]
        assert sorted(r.doc_id for r in kept if r.lang == lang) == expected
    assert caps.cap_per_language(df, 10_000, ["en", "de"]).count() == 150


def test_select_languages_maps_names_and_skips_missing(spark):
    df = spark.createDataFrame([(1, "c++"), (2, "python"), (3, "java")], "id int, dataset_lang string")
    got = {(r.id, r.lang) for r in caps.select_languages(df, ["cpp", "java", "nothing"]).collect()}
    assert got == {(1, "cpp"), (3, "java")}


def test_quarantine_keeps_the_job_running(spark):
    df = spark.createDataFrame(
        [(1, bytearray(b"fine")), (2, bytearray(b"\xff")), (3, None)], "id int, content binary"
    )
    good, bad = caps.quarantine_failures(df, BYTES)
    assert [(r.id, r.tokens) for r in good.collect()] == [(1, list(b"fine"))]
    assert {(r.id, r.error) for r in bad.collect()} == {
        (2, "UnicodeDecodeError"), (3, "MissingContent")}

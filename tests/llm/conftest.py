import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    long = "abcdef" * 30_000 + " " + "x y z " * 20_000 + "end"
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (None, "a text without an id", "en", "a", 20),
        (None, None, None, None, None), (3, " \t\n ", "en", "a", 4), (4, long, "de", "b", len(long)),
        (5, "twice the same row here it is", "en", "b", 29), (5, "twice the same row here it is", "en", "b", 29),
        (6, "password=abcdefghijkl12 mail me@example.org", "en", None, 40), (7, "!!! ??? 123", "fr", "a", 11),
        (8, "é\U0001F600 ok line\x85next", "fr", "c", 14),
    ]
    extra = [(*r, "spans", 0.5, True, 7) for r in rows]
    return spark.createDataFrame(extra, DOCS + ", spans string, score double, kept boolean, copy int")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)

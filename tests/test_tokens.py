import base64

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv
from loomline.functions.tokenizers import BYTES, BpeTokenizer
from loomline.operators import caps, tokens


@pytest.fixture(scope="module")
def bpe(tmp_path_factory):
    """All single bytes and three merges, in the ranks format of ``tiktoken``."""
    path = tmp_path_factory.mktemp("ranks") / "ranks.tiktoken"
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b" a"]
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(pieces)))
    return BpeTokenizer("small", str(path), r"\s+\S+|\S+|\s+")


def test_fixed_tables():
    assert len(fv.SPECIAL_TOKENS) == 23
    assert sorted(fv.SPECIAL_TOKENS.values()) == list(range(50256, 50279))
    assert len(fv.EXTENSION_LANGUAGE) == 29
    assert set(fv.EXTENSION_LANGUAGE.values()) | {"other"} == set(fv.LANGUAGE_IDS)


def test_detect_language(spark):
    cases = {
        "A.PY": "python", "x.tar.gz": "other", ".bashrc": "other", "noext": "other",
        "y.TSX": "typescript", "z.hpp": "cpp", "a.b/noext": "other", "d.py/x": "other",
        "..py": "other", ".a.py": "python", "dir/.hidden/m.rs": "rust", "x.": "other",
        "a.py.": "other", "...md": "other", "q.Markdown": "markdown",
    }
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    assert {r.path: r.lang for r in tokens.detect_language(df).collect()} == cases


def test_unknown_language_differs_in_the_two_lookups(spark):
    df = spark.createDataFrame([("python",), ("cobol",), (None,)], "lang string")
    ids = {r.lang: r.lang_id for r in tokens.lang_token_id(df).collect()}
    assert ids == {"python": 50263, "cobol": 50278, None: 50278}
    rows = spark.createDataFrame([("hi", "python"), ("hi", "cobol"), ("hi", None)], "text string, lang string")
    got = {r.lang: r.tokens for r in tokens.encode_document(rows).collect()}
    assert got["python"] == [50261, 50263, 104, 105, 50262, 50256]
    assert got["cobol"] == got[None] == [50261, 104, 105, 50262, 50256]


def test_text_envelope_and_prompts(spark):
    df = spark.createDataFrame([("hé", "go", "a", "b")], "text string, lang string, prefix string, suffix string")
    assert tokens.encode_document(df, envelope="text").first().tokens == [104, 195, 169, 50256]
    assert tokens.build_completion_prompt(df).first().prompt == [50261, 50269, 104, 195, 169]
    assert tokens.build_completion_prompt(df, lang_col=None).first().prompt == [50261, 104, 195, 169]
    assert tokens.build_fim_prompt(df).first().prompt == [50257, 97, 50259, 98, 50258]


def test_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "id int, text string")
    got = {r.id: r.tokens for r in tokens.tokenize_corpus(df).collect()}
    assert got == {1: [], 2: None, 3: [120]}


def test_bpe_in_batches(spark, bpe):
    texts = ["abc ab a", "<|endoftext|>", "", "é ab"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    rows = tokens.detokenize_audit(tokens.tokenize_corpus(df, bpe), bpe).collect()
    by_text = {r.text: r for r in rows}
    assert by_text["abc ab a"].tokens == [257, 32, 256, 258]
    assert all(r.round_trips for r in rows)
    # Text that looks like a special token stays text.
    assert max(by_text["<|endoftext|>"].tokens) < fv.FIRST_SPECIAL


def test_bpe_ids_must_stay_below_the_special_ones(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 50256\n")
    with pytest.raises(ValueError):
        BpeTokenizer("big", str(path), r"\S+|\s+").encode_one("a")


def test_decode_cut_character(spark):
    ids = [104, 195, fv.OTHER_LANGUAGE, 169, fv.EOT]
    df = spark.createDataFrame([("hé", ids), ("h", [104])], "text string, tokens array<int>")
    run = tokens.detokenize_audit(df).collect()
    assert [(r.decoded, r.round_trips) for r in run] == [("h��", False), ("h", True)]
    raw = tokens.detokenize_audit(df, raw=True).collect()
    assert [(r.decoded, r.round_trips) for r in raw] == [("hé", True), ("h", True)]


def test_truncate(spark):
    cases = [([1, fv.CODE_END, 2, fv.EOT], [1]), ([fv.EOT, 1], []), ([1, 2], [1, 2]), ([], []),
             ([5, fv.EOT, fv.CODE_END], [5])]
    df = spark.createDataFrame([(i, a, "x\n\n\ny\n\n\nz") for i, (a, _) in enumerate(cases)],
                               "i int, tokens array<int>, text string")
    rows = {r.i: r for r in tokens.truncate_at_stop(df).collect()}
    assert [rows[i].kept_tokens for i in range(len(cases))] == [b for _, b in cases]
    assert {r.kept_text for r in rows.values()} == {"x"}
    plain = spark.createDataFrame([([1], "a\n\nb")], "tokens array<int>, text string")
    assert tokens.truncate_at_stop(plain).first().kept_text == "a\n\nb"


@pytest.mark.parametrize("block_size", [1, 2, 5, 100])
def test_context_equals_the_turn_by_turn_loop(spark, block_size):
    said = ["", "", "hé", "you", "", "x" * 40, "q", "", "long answer " * 3, "end"]
    turns = [(c, t, "user" if (t + c) % 2 == 0 else "assistant", said[(t * 7 + c) % 10] or None)
             for c in range(3) for t in range(40 if c == 0 else 6)]
    expected, context = {}, {}
    for conv, turn, role, text in turns:
        before, text = context.get(conv, ""), text or ""
        prompt = (before + "\n" + text) if (before and role == "user") else before + text
        context[conv] = prompt[-3 * block_size:]
        expected[conv, turn] = context[conv]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = tokens.conversation_context(df.repartition(5), block_size, turns_per_bucket=7).collect()
    assert {(r.conv_id, r.turn): r.context for r in got} == expected


ROWS, BYTES_HELD = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unbounded(spark):
    """A session in which no operator has bounded the batches yet."""
    before = {name: spark.conf.get(name, None) for name in (ROWS, BYTES_HELD)}
    for name in before:
        spark.conf.unset(name)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("operator", ["encode_document", "tokenize_corpus", "build_completion_prompt",
                                      "build_fim_prompt", "quarantine_report", "quarantine_failures"])
def test_texts_come_to_python_in_bounded_batches(unbounded, operator):
    class Sized:
        """The token of a text is the size of its batch; more than it may hold fails."""

        def encode(self, text):
            @F.arrow_udf("array<int>")
            def sizes(texts: pa.Array) -> pa.Array:
                return Sized().encode_batch(texts)

            return sizes(text)

        def encode_batch(self, texts):
            sizes = [len(texts), texts.nbytes]
            if sizes[0] > 1000 or sizes[1] > 9 << 20:
                raise SystemExit(f"a batch of {sizes}")
            return pa.array([[1]] * len(texts), pa.list_(pa.int32()))

    rows = unbounded.range(4000).coalesce(1).select("id", F.when(F.col("id") < 3000, "x").otherwise(
        F.repeat(F.lit("long "), 10_000)).alias("text"))
    rows = rows.withColumns({"content": F.encode("text", "UTF-8"), "prefix": F.col("text"), "suffix": F.lit(""),
                             "lang": F.lit("python")})
    if operator == "quarantine_report":
        assert caps.quarantine_report(rows, Sized()).first()["n_rows"] == 4000
    elif operator == "quarantine_failures":
        assert caps.quarantine_failures(rows.select("id", "content"), Sized())[0].count() == 4000
    else:
        done = getattr(tokens, operator)(rows, Sized())
        assert done.agg(F.count(F.col(done.columns[-1]))).first()[0] == 4000


def test_tokens_are_decoded_in_bounded_batches(unbounded):
    df = unbounded.createDataFrame([([104, 105], "hi")], "tokens array<int>, text string")
    assert tokens.detokenize_audit(df).first().round_trips
    assert int(unbounded.conf.get(ROWS)) <= 1000 and int(unbounded.conf.get(BYTES_HELD)) <= 8 << 20


def test_a_session_keeps_its_own_smaller_batches(unbounded):
    unbounded.conf.set(ROWS, "7")
    unbounded.conf.set(BYTES_HELD, "4096")
    tokens.tokenize_corpus(unbounded.createDataFrame([("hi",)], "text string"))
    assert (unbounded.conf.get(ROWS), unbounded.conf.get(BYTES_HELD)) == ("7", "4096")

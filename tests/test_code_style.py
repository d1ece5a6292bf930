import ast
import io
import keyword
import re
import tokenize

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomline.operators import code_style, stats

DOCS = "doc_id long, text string"
SOURCE = '''import os, sys
from re import sub as swap


def total(items, tmp2):
    """Sum of 'items'  # not a comment"""
    a1 = 0  # a sum, "quoted
    for item in items:
        a1 += item.value * len(tmp2) + 0x1f
    label = f"{a1} of {os.name}" + 'it\\'s # text'
    été = """not a
    docstring"""
    print(label, été)
    return swap("x", str(a1), label)
'''


def one(spark, operator, text, **options):
    return operator(spark.createDataFrame([(1, text)], DOCS), **options).collect()


def test_tokens_are_the_whole_text(spark):
    texts = [SOURCE, "", '"""', "'" * 7, '"a\\', "x = 'a\nb'", "# only", "\r\n\t\u2028\U0001f600.é.5e3", '"' + "\\x" * 50_000 + '"',
             '"""' + "a\n" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = df.select("doc_id", code_style.lexed(df.text).alias("t")).collect()
    assert ["".join(r.t) for r in sorted(got)] == ["\n" + t for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab1_.\"'#\\\n\t fé", max_size=40), max_size=30))
def test_tokens_join_for_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = df.select("doc_id", code_style.lexed(df.text).alias("t")).collect()
    assert ["".join(r.t) for r in sorted(got)] == ["\n" + t for t in texts]


def test_counts_agree_with_the_language_s_own_lexer(spark):
    (got,) = one(spark, code_style.style_noise, SOURCE)
    own = list(tokenize.generate_tokens(io.StringIO(SOURCE).readline))
    comments = sum(t.type == tokenize.COMMENT for t in own)
    assert got.n_comments == comments + 1  # and the docstring
    assert (got.n_weak_names, got.n_prints) == (sum(t.string in ("a1", "tmp2") for t in own if t.type == tokenize.NAME) - 1, 1)
    assert (got.n_tab_lines, got.n_lines, got.noisy) == (0, SOURCE.count("\n") + 1, True)


def test_noise_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "\tif x:\n    y"), (4, "x\n" * 30), (5, "# note\n" + "x = 1\n" * 30)]
    got = {r.doc_id: r for r in code_style.style_noise(spark.createDataFrame(rows, DOCS)).collect()}
    assert {k: r.noisy for k, r in got.items()} == {1: False, 2: False, 3: True, 4: True, 5: False}
    assert got[1].n_lines == got[2].n_lines == 1 and got[3].n_tab_lines == got[3].n_blank_lines == 1


def _shape(source):
    """The tree without names, constants and docstrings' words."""
    return [type(node).__name__ for node in ast.walk(ast.parse(source))]


def test_worse_copy_runs_alike(spark):
    (got,) = one(spark, code_style.degrade_pairs, SOURCE)
    assert got.chosen == SOURCE and _shape(got.rejected) == _shape(SOURCE)
    comments = [t for t in tokenize.generate_tokens(io.StringIO(got.rejected).readline) if t.type == tokenize.COMMENT]
    assert not comments and "Sum of" not in got.rejected and got.n_dropped == 2
    names = {n.id for n in ast.walk(ast.parse(got.rejected)) if isinstance(n, ast.Name)}
    assert {"a1", "os", "swap", "len", "str", "print"} <= names  # used in the f-string, imported, built in
    assert not names & {"items", "item", "tmp2", "label", "été"}
    before = [n.id for n in ast.walk(ast.parse(SOURCE)) if isinstance(n, ast.Name)]
    after = [n.id for n in ast.walk(ast.parse(got.rejected)) if isinstance(n, ast.Name)]
    renaming = set(zip(before, after))
    assert len(renaming) == len({a for a, _ in renaming}) == len({b for _, b in renaming})


def test_worse_copy_is_seeded_and_only_where_it_differs(spark):
    rows = [(1, "x = y"), (2, None), (3, ""), (4, "1 + 2"), (5, "x = y")]
    df = spark.createDataFrame(rows, DOCS)
    first, again, other = ({r.doc_id: r.rejected for r in code_style.degrade_pairs(d, seed).collect()}
                           for d, seed in ((df, 0), (df.repartition(3), 0), (df, 1)))
    assert first == again and set(first) == {1, 5} and first[1] == first[5] != other[1]


def _clean(text):
    text = re.sub("\r\n|\r", "\n", text).replace("\t", "    ")
    text = re.sub("\n{4,}", "\n\n\n", "\n".join(x.rstrip(" ") for x in text.split("\n"))).rstrip("\n")
    return text and text + "\n"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("a \t\r\né", max_size=40), max_size=30))
def test_clean_pairs_equal_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r for r in code_style.normalize_pairs(df).collect()}
    assert {k: (r.dirty, r.clean) for k, r in got.items()} == {
        k: (t, _clean(t)) for k, t in enumerate(texts) if _clean(t) != t}
    again = spark.createDataFrame([(k, r.clean) for k, r in got.items()], DOCS)
    assert code_style.normalize_pairs(again).count() == 0


def test_long_runs_are_linear(spark):
    (got,) = one(spark, code_style.normalize_pairs, " " * 1_000_000 + "x" + "\n" * 1_000_000)
    assert len(got.clean) == 1_000_002 and got.n_blank_runs == 1
    (got,) = one(spark, code_style.style_noise, "'" + "a.b#" * 200_000 + "\n" + "print(x)\n" * 50_000)
    assert got.n_prints == 50_000


def test_generated_files(spark):
    plain = "a line of some words, as long as others are\n" * 50
    rows = [(k, plain) for k in range(20)] + [
        (30, "x=1;" * 1000), (31, "# DO NOT EDIT\n" + plain), (32, plain + "do not edit"), (33, "0,1,2\n" * 300),
        (34, None), (35, "")]
    got = {r.doc_id: r for r in code_style.flag_generated(spark.createDataFrame(rows, DOCS)).collect()}
    assert {k: r.reason for k, r in got.items() if r.reason} == {30: "minified", 31: "marked", 33: "data"}
    assert len(got) == len(rows) and got[34].distance == got[35].distance == 0
    assert got[0].distance < 0.2 and got[30].distance > 0.6
    empty = spark.createDataFrame([], DOCS)
    assert code_style.flag_generated(empty).count() == 0


def test_grid_of_all_combinations(spark):
    rows = [("x", "1")] * 3 + [("y", None)] + [("z", "1")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = {(r.a, r.b): r for r in stats.diversity_grid(df, {"a": ["x", "y"], "b": ["1", "2"]}, 2).collect()}
    whole = got[None, None]
    assert (whole.n_rows, whole.n_cells, whole.n_empty, whole.n_short, whole.n_outside) == (5, 4, 3, 6, 2)
    assert (got["x", None].n_empty, got["x", "1"].n_short, got["x", "2"].n_rows) == (1, 0, 0)
    assert got["y", "(none)"].n_cells == 0 and got["y", "(none)"].n_outside == 1
    assert len(got) == 4 + 2 + 3 + 3 + 1  # cells, outside, by a, by b, all
    nothing = stats.diversity_grid(df.where("false"), {"a": ["x", "y"], "b": ["1"]}).collect()
    assert sum(r.n_empty for r in nothing if r.a and r.b) == 2


def _counts(tokens):
    """The counts of style_noise, token by token."""
    some = lambda pattern: sum(bool(re.search(pattern, t)) for t in tokens)
    sub = lambda pattern: re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U" + m[1].zfill(8), pattern)
    return {"n_names": sum(bool(re.search(f"^(?:{sub(code_style.NAME)})\\Z", t)) and not keyword.iskeyword(t) for t in tokens),
            "n_weak_names": some(code_style.WEAK_NAME[:-1] + r"[\x85\u2028\u2029]?\Z"), "n_prints": some("^" + code_style.DEBUG_PRINT),
            "n_comments": some("^#") + some("^" + code_style.DOCSTRING),
            "n_tab_lines": some("^\\n[ \\t]*\\t"), "n_blank_lines": some("^\\n[ \\t]* ")}


WORDS = ["a1", "tmp2", "tmp2x", "if", "iffy", "None", "val", "é", "\U0001f600", "print(", "print (", ".a1", "f", "0x1", ";", "import ",
         '"""', "'''", '"', "'", "\\", "#", "\n", "\n\t", "\n ", " ", "(", "a1\u2028", "x\u0085", "$1", "from "]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=25).map("".join), max_size=30))
def test_marks_count_as_the_tokens_do(spark, texts):
    df = spark.createDataFrame(list(enumerate([*texts, SOURCE, "".join(WORDS)])), DOCS)
    found = code_style.style_noise(df).withColumn("t", code_style.lexed(df.text)).collect()
    for r in found:
        assert {k: r[k] for k in _counts([])} == _counts(r.t), r.text


def test_style_noise_makes_no_list_of_tokens(spark):
    plan = code_style.style_noise(spark.createDataFrame([(1, "x")], DOCS))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan

"""Screens and rewrites of source texts: generated files, style noise, clean copies and worse copies.

Everything is a column expression over whole texts: no shuffle but for the corpus profile, no
Python. A missing text counts as empty; where pairs are made it gives none.
"""

from __future__ import annotations

import builtins
import keyword
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.session import materialize

#: Upper ends of the line lengths of a profile's classes; longer lines are one more class.
LINE_CLASSES = (0, 20, 40, 80, 160, 320, 1000)
#: What generators write at the head of their files.
GENERATED_MARK = r"(?i)(?:do not edit|auto-?generated|generated by|@generated)"

# Names may hold any character beyond ASCII.
NAME = r"[A-Za-z_\x{80}-\x{10FFFF}][A-Za-z0-9_\x{80}-\x{10FFFF}]*"
DOCSTRING = r'\n[ \t]*[rRuU]?(?:"""[\s\S]*?"""|' r"'''[\s\S]*?''')"
STRING = (r'[rRbBuUfF]{0,2}(?:"""[\s\S]*?"""|' r"'''[\s\S]*?'''"
          r'|"[^"\\\n]*(?:\\[\s\S][^"\\\n]*)*"' r"|'[^'\\\n]*(?:\\[\s\S][^'\\\n]*)*')")
IMPORT = r"\n[ \t]*(?:from|import)[ \t][^#\n]*"
DEBUG_PRINT = r"(?:print|console\.log)[ \t]*\("
#: One token at a time: what starts first wins, then what is listed first. Every character is in one token,
#: so a quote in a comment or a # in a string means nothing.
LEXER = "|".join((DOCSTRING, IMPORT, r"\n[ \t]*", STRING, r"#[^\n]*", DEBUG_PRINT, NAME, r"\." + NAME,
                  r"[0-9][A-Za-z0-9_.]*", r"[^A-Za-z0-9_\x{80}-\x{10FFFF}.\"'#\n]+", r"[\s\S]"))


def _one_of(words: Sequence[str]) -> str:
    """A pattern for any of some words, by their first letter: most others are out after one character."""
    first = sorted({w[0] for w in words})
    return "|".join(f"{c}(?:{'|'.join(sorted((w[1:] for w in words if w[0] == c), reverse=True))})" for c in first)


#: Names without meaning: a letter with a number, or a placeholder.
WEAK_NAME = r"^(?:[a-z][0-9]+|(?:tmp|temp|foo|bar|baz|qux|var|val|aa|bb|xx)[0-9]*)$"
#: The same tokens with groups: the first quote of a docstring and the white space before it, that before an import and
#: before another line, what begins a comment, the parenthesis of debug output, the first character of a weak name, twice,
#: and that of another name that is no keyword.
_IN_NAME = r"[A-Za-z0-9_\x{80}-\x{10FFFF}]"
MARKED_LEXER = "|".join((
    r"(\n[ \t]*)" r'[rRuU]?(?:(")""[\s\S]*?"""|' r"(')''[\s\S]*?''')", r"(\n[ \t]*)(?:from|import)[ \t][^#\n]*",
    r"(\n[ \t]*)", STRING, r"(#)[^\n]*", r"(?:print|console\.log)[ \t]*(\()",
    f"(?:{_one_of(keyword.kwlist)})(?!{_IN_NAME})",
    f"(?={WEAK_NAME[1:-1]}" r"[\x{85}\x{2028}\x{2029}]?" f"(?!{_IN_NAME}))(([a-z])){_IN_NAME}*",
    f"({NAME[:NAME.index(']') + 1]}){_IN_NAME}*", LEXER.split(f"|{NAME}|", 1)[1]))
#: Names that a worse copy keeps, so that it still runs.
KEPT_NAMES = tuple(sorted({*keyword.kwlist, *dir(builtins), "self", "cls"}))


def lexed(text: Column) -> Column:
    """Tokens of a text, a line break put before it; joined they are that text.

    Repetitions are possessive here: the same matches, and no recursion on long strings.
    """
    return F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit(_possessive(LEXER)), F.lit(0))


def _possessive(pattern: str) -> str:
    return pattern.replace(r"\\\n]*)*", r"\\\n]*)*+")


def _marks(text: Column) -> Column:
    """Of each token of a text a ``;`` and the groups of MARKED_LEXER; no group can hold a ``;``."""
    groups = "".join(f"${k}" for k in range(1, 11))
    return F.regexp_replace(F.concat(F.lit("\n"), text), F.lit(_possessive(MARKED_LEXER)), F.lit(";" + groups))


def _count(tokens: Column, test) -> Column:
    return F.size(F.filter(tokens, test)).cast("bigint")


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row, not once a token."""
    return F.transform(F.array(value), body)[0]


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _changed(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows whose columns differ. The row number keeps the test above them: pushed below, it would compute them twice."""
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.where((F.col("_row") >= 0) & (F.col(before) != F.col(after))).drop("_row")


def style_noise(df: DataFrame, max_weak: float = 0.2, min_lines: int = 20, text_col="text") -> DataFrame:
    """Add counts of style signals of each text, and ``noisy``.

    ``n_names`` and ``n_weak_names`` (a1, tmp2), ``n_prints`` (debug output), ``n_comments`` (with
    docstrings), ``n_tab_lines`` and ``n_blank_lines`` (lines indented by tabs, by blanks), ``n_lines``. Strings
    and comments are told apart first, so a name in a comment is none. A text is noisy with debug output, with
    both kinds of indent, with more than ``max_weak`` weak names, or with ``min_lines`` lines and no comment.
    """
    marked = df.withColumn("_t", _marks(_text(text_col)))
    count = lambda pattern: F.regexp_count("_t", F.lit(pattern)).cast("bigint")
    # Nothing but a mark holds its character, so removing that counts the marks. What is left then are names.
    without = lambda text, mark: F.replace(text, F.lit(mark))
    seen = lambda mark: (F.length("_t") - F.length(without(F.col("_t"), mark))).cast("bigint")
    letters = reduce(without, ";(#\"'\n \t", F.col("_t"))
    counted = marked.withColumns({
        "n_names": F.length(letters).cast("bigint"),
        "n_weak_names": count(";[a-z][a-z]"),
        "n_prints": seen("("),
        "n_comments": seen("#") + seen('"') + seen("'"),
        "n_tab_lines": count(r"\n *\t"),
        "n_blank_lines": count(r"\n\t* "),
        "n_lines": (F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"))) + 1).cast("bigint"),
    }).drop("_t").withColumns({"n_lines": F.coalesce("n_lines", F.lit(1).cast("bigint")),
                               "n_names": F.col("n_names") - F.col("n_weak_names")})  # those stand there twice
    return counted.withColumn("noisy", (F.col("n_prints") > 0)
                              | ((F.col("n_tab_lines") > 0) & (F.col("n_blank_lines") > 0))
                              | (F.col("n_weak_names") > max_weak * F.col("n_names"))
                              | ((F.col("n_comments") == 0) & (F.col("n_lines") >= min_lines)))


def degrade_pairs(df: DataFrame, seed: int | str = 0, kept: Sequence[str] = KEPT_NAMES,
                  id_col="doc_id", text_col="text") -> DataFrame:
    """(``chosen``, ``rejected``) of each text that a worse copy differs from: the text and that copy.

    The copy has no comments, empty docstrings (a body that has nothing else stays a body) and names without
    meaning. A name becomes ``v`` with 48 bits of its seeded hash, the same wherever it stands. Names in ``kept``,
    imported names, names in f-strings and names behind a point stay.
    """
    tokens = lexed(_text(text_col))
    quoted = lambda t: t.rlike(f"^{IMPORT}") | t.rlike("^[rR]?[fF][rR]?[\"']")
    fixed = df.where(F.col(text_col).isNotNull()).withColumn("_t", tokens)
    own = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", F.filter("_t", quoted)), F.lit(NAME), F.lit(0)))

    def renamed(t: Column, own: Column) -> Column:
        return t.rlike(f"^(?:{NAME})$") & ~t.isin(list(kept)) & ~F.array_contains(own, t)

    def worse(t: Column, own: Column) -> Column:
        return (F.when(t.startswith("#"), F.lit(""))
                .when(t.rlike(f"^{DOCSTRING}"), F.concat(F.regexp_extract(t, r"^\n[ \t]*", 0), F.lit('""')))
                .when(renamed(t, own), F.concat(F.lit("v"), F.substring(F.md5(F.concat(F.lit(f"{seed}:"), t)), 1, 12)))
                .otherwise(t))

    copies = fixed.select(
        id_col, F.col(text_col).alias("chosen"),
        F.substr(_once(own, lambda n: F.array_join(F.transform("_t", lambda t: worse(t, n)), "")), F.lit(2)).alias("rejected"),
        _count(F.col("_t"), lambda t: t.startswith("#") | t.rlike(f"^{DOCSTRING}")).alias("n_dropped"),
        _once(own, lambda n: _count(F.col("_t"), lambda t: renamed(t, n))).alias("n_renamed"))
    return _changed(copies, "chosen", "rejected")


def normalize_pairs(df: DataFrame, tab: int = 4, blank_lines: int = 2, id_col="doc_id",
                    text_col="text") -> DataFrame:
    """(``dirty``, ``clean``) of each text that the clean-up changes, with the number of edits of each rule.

    In this order: line ends become ``\\n`` (``n_line_ends``), tabs become blanks (``n_tabs``), blanks at the end of
    a line go (``n_trailing`` lines), more than ``blank_lines`` empty lines in a row become that many
    (``n_blank_runs``), and the text ends with one line end (``ended``). Cleaning what is clean changes nothing.
    """
    lines = "\\r\\n|\\r"
    most = blank_lines + 1
    unix = F.regexp_replace(text_col, lines, "\n")
    spaced = F.replace(unix, F.lit("\t"), F.lit(" " * tab))
    steps = df.where(F.col(text_col).isNotNull()).select(
        id_col, F.col(text_col).alias("dirty"), F.split(spaced, "\n").alias("_lines")).withColumn(
        "_trimmed", F.transform("_lines", lambda x: F.rtrim(x))).withColumn(
        "_joined", F.array_join("_trimmed", "\n")).withColumn(
        "_short", F.regexp_replace("_joined", f"\\n{{{most + 1},}}", "\n" * most))
    body = F.rtrim(F.col("_short"), F.lit("\n"))
    cleaned = steps.withColumn("clean", F.when(body == "", "").otherwise(F.concat(body, F.lit("\n"))))
    return _changed(cleaned, "dirty", "clean").select(
        id_col, "dirty", "clean",
        F.regexp_count("dirty", F.lit(lines)).cast("bigint").alias("n_line_ends"),
        (F.length("dirty") - F.length(F.replace(F.col("dirty"), F.lit("\t")))).cast("bigint").alias("n_tabs"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x) != x)).cast("bigint").alias("n_trailing"),
        F.regexp_count("_joined", F.lit(f"\\n{{{most + 1},}}")).cast("bigint").alias("n_blank_runs"),
        (F.col("clean") != F.col("_short")).alias("ended"))


def flag_generated(df: DataFrame, min_distance: float = 0.5, longest: int = 1000, min_letters: float = 0.25,
                   head_lines: int = 5, id_col="doc_id", text_col="text") -> DataFrame:
    """Profile of each text's lines, its distance to the corpus profile, and ``reason`` where it looks generated.

    A profile is the share of characters in lines of each class of length; the corpus profile is that of all
    texts together, one row of sums; the profiles, narrow, are written once for both uses. ``distance`` is the total variation between both, 0 to 1. Reasons, the first
    that holds: ``marked`` (a generator's mark in the first lines), ``minified`` (a line of ``longest`` characters
    or more, and ``min_distance``), ``data`` (less than ``min_letters`` of the characters are letters, and
    ``min_distance``). An empty text has distance 0 and no reason.
    """
    each = df.select(id_col, _text(text_col).alias("_text")).withColumn(
        "_n", F.transform(F.split("_text", "\n"), lambda x: F.length(x).cast("bigint")))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)
    bounds = [-1, *LINE_CLASSES, None]
    classes = [f"_c{k}" for k in range(len(bounds) - 1)]
    inside = lambda low, high: lambda x: (x > low) if high is None else (x > low) & (x <= high)
    marked = F.substring_index("_text", "\n", head_lines).rlike(GENERATED_MARK)
    profiles = each.select(
        id_col, F.size("_n").cast("bigint").alias("n_lines"), F.array_max("_n").alias("longest_line"),
        F.regexp_count("_text", F.lit(r"[\p{L}]")).cast("bigint").alias("n_letters"), marked.alias("_marked"),
        *[total(F.filter("_n", inside(low, high))).alias(c) for c, low, high in zip(classes, bounds, bounds[1:])],
    ).withColumn("n_chars", sum((F.col(c) for c in classes[1:]), F.col(classes[0])))
    profiles = materialize(profiles)
    # one row of sums
    corpus = profiles.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint") for c in (*classes, "n_chars")]).first()
    apart = F.lit(0.0)
    for c, n in zip(classes, corpus):
        apart = apart + F.abs(F.col(c) / F.nullif("n_chars", F.lit(0)) - F.lit(n / max(corpus[-1], 1)))
    distance = F.when(F.col("n_chars") > 0, F.round(apart / 2, 6)).otherwise(F.lit(0.0))
    far = F.col("distance") >= min_distance
    return profiles.withColumn("distance", distance).withColumn("reason", (
        F.when(F.col("_marked"), "marked")
        .when(far & (F.col("longest_line") >= longest), "minified")
        .when(far & (F.col("n_letters") < min_letters * F.col("n_chars")), "data"))).select(
        id_col, "n_lines", "longest_line", "n_letters", "n_chars", "distance", "reason")

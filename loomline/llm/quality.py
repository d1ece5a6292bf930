"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import WORD_SPACE, only, word_list, written

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
#: Frequent short words of the languages in scope.
FUNCTION_WORDS = (
    "the of and to in is that it for on was with as by this "
    "der die und das ist nicht von mit für auf eine "
    "le la les et des est une que dans pour qui "
    "el los las es por con una para del se no su"
).split()
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def _repeats(windows: DataFrame) -> DataFrame:
    """Replace windows (hashes) by n_repeat_words: words covered by windows found twice or more.

    Equal hashes are neighbours after sorting. Each array is a column of its own before a lambda
    looks into it, so none is computed again for every element.
    """
    rest = [c for c in windows.columns if c != "windows"]
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = windows.select(*rest, F.when(some, F.array_sort(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("placed"))
    starts = placed.select(*rest, F.sort_array(F.array_compact(F.transform("placed", lambda s, j: F.when(
        ((j > 0) & (F.get("placed", j - 1)["h"] == s["h"]))
        | (F.get("placed", j + 1)["h"] == s["h"]), s["i"])))).alias("starts"))
    covered = F.aggregate(  # steps between sorted starts, three words at most
        "starts", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("end")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(3), s + 3 - a["end"])).alias("n"),
                              (s + 3).alias("end")),
        lambda a: a["n"])
    return starts.select(*rest, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def measures(docs: DataFrame) -> DataFrame:
    """Counts of each text (null: empty), computed in the JVM without a shuffle.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (contract of the query),
    and n_lines, n_capitals, n_digits, n_function (distinct function words).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda c, chars: F.length(c) - F.length(F.translate(c, chars, ""))
    split = only(docs, "doc_id", "text").select(
        "doc_id", text.alias("text"), word_list(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "").alias("lines"))
    windows = split.select(
        "doc_id", F.size("words").alias("n_words"),
        F.length(F.translate("text", WORD_SPACE, "")).alias("word_chars"),
        without(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        without(F.col("text"), CAPITALS).alias("n_capitals"),
        without(F.col("text"), DIGITS).alias("n_digits"),
        F.size(F.array_intersect(
            F.col("words"), F.array(*[F.lit(w) for w in FUNCTION_WORDS]))).alias("n_function"),
        F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        )).alias("windows"))
    return _repeats(windows).select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_capitals", "n_digits",
        "n_function", "n_repeat_words")])


def _vote(good: Column, bad: Column) -> Column:
    """1 for good, -1 for bad, 0 to abstain."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules, on the columns of ``measures``. Shares are of words, lines or characters.

    A rule that looks for one defect abstains where there is none: that is no evidence of quality.
    Few symbols beside words, and function words as in running prose, are.
    """
    c = F.col
    words, chars = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("word_chars"), F.lit(1))
    lines, never = F.greatest(c("n_lines"), F.lit(1)), F.lit(False)
    longer = c("n_words") >= 100
    return {
        "length": _vote(never, c("n_words") < MIN_WORDS),
        "symbols": _vote(c("n_symbols") * 50 <= words, c("n_symbols") * 5 > words),
        "function_words": _vote(c("n_function") >= F.when(longer, 6).otherwise(3),
                                c("n_function") <= F.when(longer, 3).otherwise(0)),
        "word_length": _vote(never, (chars < words * 2) | (chars > words * 14)),
        "repetition": _vote(never, c("n_repeat_words") * 100 > words * 30),
        "lines": _vote(never, c("n_dup_lines") * 10 > lines * 3),
        "capitals": _vote(never, c("n_capitals") * 10 > chars * 4),
        "digits": _vote(never, c("n_digits") * 10 > chars * 3),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200,
        tolerance: float = 1e-9) -> tuple[float, list[float]]:
    """Share of good texts and each rule's accuracy when it votes, from counted vote patterns.

    Expectation-maximisation of the model in which rules vote independently given the class.
    A rule is taken to be right more often than not and never to be sure (0.55 to 0.99), and the
    share of good texts to lie in 0.05 to 0.95, so the classes can't change places and an empty
    table gives the starting values.
    """
    share, accuracy = 0.8, [0.8] * rules
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        good = 0.0
        right, cast = [1.0] * rules, [2.0] * rules  # one vote of either kind beforehand
        for pattern, n in patterns:
            p = posterior(pattern, share, accuracy)
            good += n * p
            for r, v in enumerate(pattern):
                if v:
                    cast[r] += n
                    right[r] += n * (p if v > 0 else 1 - p)
        new = [min(0.99, max(0.55, a / b)) for a, b in zip(right, cast)]
        new_share = min(0.95, max(0.05, good / total))
        moved = max(abs(new_share - share), *(abs(a - b) for a, b in zip(new, accuracy)))
        share, accuracy = new_share, new
        if moved < tolerance:
            break
    return share, accuracy


def posterior(pattern: tuple[int, ...], share: float, accuracy: list[float]) -> float:
    odds = math.log(share / (1 - share)) + sum(
        v * math.log(a / (1 - a)) for v, a in zip(pattern, accuracy))
    return 1 / (1 + math.exp(-odds))


def judge(docs: DataFrame, threshold: float = 0.5,
          rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Score every text with the posterior probability that it is good.

    Columns: those of ``measures``, base_failed, quality (double), kept. Rows stay as they are,
    also repeated ones and those without doc_id; a null text counts as empty. An empty table
    gives an empty table.

    The measures are written once. The vote patterns, at most 3 to the number of rules, are
    counted by Spark and fitted on the driver; the weights go back as literals.
    """
    rules = dict(rules or votes())
    measured = written(measures(docs), "quality")
    counted = (measured.select(*[v.alias(r) for r, v in rules.items()])
               .groupBy(*rules).count().collect())
    share, accuracy = fit(sorted((tuple(r)[:-1], r["count"]) for r in counted), len(rules))
    odds = F.lit(math.log(share / (1 - share)))
    for vote, a in zip(rules.values(), accuracy):
        odds = odds + vote * F.lit(math.log(a / (1 - a)))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT))
    scored = measured.select("*", failed.alias("base_failed"),
                             (1 / (1 + F.exp(-odds))).alias("quality"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality")

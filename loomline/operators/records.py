"""Operators on documents, conversations and ranked chunks that prepare instruction data and prompts.

Columns are named by arguments. Nulls are ordinary values unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.hashing import DEFAULT_SEED, seeded_hash, unit_draw
from loomline.functions.lookup import lookup

# --- fixed values: conversation markers and the prompt's wording ---------------
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
PROMPT_HEAD, PROMPT_QUESTION, PROMPT_ANSWER = "参考资料：\n", "\n\n问题：", "\n回答："


def dedup_exact(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per identical text, that with the smallest id; missing texts are one group.

    Texts are compared by SHA-256 and are not shuffled: only digests and ids are.
    """
    digest = F.coalesce(F.sha2(text_col, 256), F.lit(""))
    first = df.groupBy(digest.alias("_digest")).agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(first, id_col, "left_semi")


def chat_template(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role",
                  text_col="text") -> DataFrame:
    """Turns in one format, and the opening of the answer behind each conversation's last turn.

    One row per piece, in the order of (conversation, turn): a conversation of
    any length stays spread over its turns. Joined, the pieces are its prompt.
    """
    piece = F.concat(F.lit(TURN_START), role_col, F.lit("\n"), F.coalesce(text_col, F.lit("")),
                     F.lit(TURN_END + "\n"))
    said = turns.select(conv_col, turn_col, piece.alias("piece"))
    opening = turns.groupBy(conv_col).agg((F.max(turn_col) + 1).cast(
        turns.schema[turn_col].dataType).alias(turn_col)).withColumn(
        "piece", F.lit(f"{TURN_START}assistant\n"))
    return said.unionByName(opening)


def sft_examples(turns: DataFrame, tokenizer, conv_col="conv_id", turn_col="turn", role_col="role",
                 text_col="text") -> DataFrame:
    """A user turn and the assistant turn behind it: tokens, and labels that are -1 over the prompt.

    The pair is found by (conversation, turn number), so long conversations need no window.
    """
    encoded = turns.select(conv_col, turn_col, role_col, tokenizer.encode(
        F.coalesce(text_col, F.lit(""))).alias("_tokens"))
    asked = encoded.where(F.col(role_col) == "user").select(
        conv_col, turn_col, F.col("_tokens").alias("_prompt"))
    answered = encoded.where(F.col(role_col) == "assistant").select(
        conv_col, (F.col(turn_col) - 1).alias(turn_col), F.col("_tokens").alias("_answer"))
    return asked.join(answered, [conv_col, turn_col]).select(
        conv_col, turn_col, F.concat("_prompt", "_answer").alias("tokens"),
        F.concat(F.array_repeat(F.lit(-1), F.size("_prompt")), "_answer").alias("labels"))


def best_worst_pairs(answers: DataFrame, prompt_col: str, id_col: str, score_col: str) -> DataFrame:
    """Per prompt the ids of the best and the worst answer; none where all scores are equal.

    Ties go to the smaller id. Both are found in one aggregation with map-side combine.
    """
    best = F.max(F.struct(F.col(score_col).alias("s"), (-F.col(id_col)).alias("i")))
    worst = F.min(F.struct(F.col(score_col).alias("s"), F.col(id_col).alias("i")))
    scored = answers.where(F.col(score_col).isNotNull())
    return scored.groupBy(prompt_col).agg(best.alias("_b"), worst.alias("_w")).where(
        "_b.s > _w.s").select(prompt_col, (-F.col("_b.i")).alias("chosen"), F.col("_w.i").alias("rejected"),
                              F.col("_b.s").alias("best_score"), F.col("_w.s").alias("worst_score"))


def stratified_holdout(df: DataFrame, strata: Sequence[str], per_stratum: int, id_col="doc_id",
                       seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Add ``holdout``: the first ``per_stratum`` rows of each stratum in hash order are held out.

    The limit is applied before the shuffle too, so a large stratum sends a few rows of each task.
    """
    ids = df.select(*strata, id_col, seeded_hash(f"{seed}:holdout", id_col).alias("_h"))
    first = Window.partitionBy(*strata).orderBy("_h", id_col)
    chosen = ids.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_stratum)
    held = chosen.select(id_col, F.lit(True).alias("holdout"))
    return df.join(held, id_col, "left").withColumn("holdout", F.coalesce("holdout", F.lit(False)))


def chunk_sliding(df: DataFrame, size: int = 512, step: int = 256, id_col="doc_id",
                  tokens_col="tokens") -> DataFrame:
    """Windows of ``size`` tokens, one every ``step``; short ones at the end are kept."""
    n = F.size(tokens_col)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step)))
    return df.select(id_col, tokens_col, F.posexplode(starts).alias("chunk_no", "start")).select(
        id_col, "chunk_no", "start",
        F.slice(tokens_col, F.col("start") + 1, F.lit(size)).alias("chunk"))


def top_ranked(df: DataFrame, query_col: str, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each query as ``rank`` 1, 2, ...; limited before the shuffle too."""
    nth = F.row_number().over(Window.partitionBy(query_col).orderBy(*order))
    return df.withColumn("rank", nth).where(F.col("rank") <= k)


def context_budget(ranked: DataFrame, query_col: str, length_col: str, block_size: int = 1024,
                   answer: int = 256, query_length: Column | None = None) -> DataFrame:
    """Of ranked chunks (a bounded number per query) those that fit, in rank order.

    A chunk is taken while the running length leaves ``answer`` tokens of the
    block beside the question; the first that doesn't fit ends the list.
    """
    upto = Window.partitionBy(query_col).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    room = F.lit(block_size - answer) - (F.lit(0) if query_length is None else query_length)
    return ranked.withColumn("running", F.sum(length_col).over(upto)).where(F.col("running") <= room)


def assemble_rag_prompt(kept: DataFrame, query_col: str, chunk_col: str) -> DataFrame:
    """The prompt of each query from its chunks (a bounded number) in rank order."""
    chunks = F.transform(F.array_sort(F.collect_list(F.struct("rank", chunk_col))), lambda c: c[chunk_col])
    return kept.groupBy(query_col).agg(F.count("*").alias("n_chunks"), F.concat(
        F.lit(PROMPT_HEAD), F.array_join(chunks, "\n"), F.lit(PROMPT_QUESTION), F.first(query_col),
        F.lit(PROMPT_ANSWER)).alias("prompt"))


def index_upsert_delete(index: DataFrame, upserts: DataFrame, deleted: DataFrame, id_col="doc_id",
                        version_col="version") -> DataFrame:
    """The index after changes: the latest version of each id, without those deleted."""
    others = [c for c in index.columns if c != id_col]
    latest = index.unionByName(upserts).groupBy(id_col).agg(
        F.max_by(F.struct(*others), version_col).alias("_row"))
    return latest.join(deleted.select(id_col).distinct(), id_col, "left_anti").select(id_col, "_row.*")


def eval_matrix(results: DataFrame, group_col: str, system_col: str, correct_col: str,
                systems: Sequence) -> DataFrame:
    """Accuracy of each system in each group of questions, side by side."""
    return results.groupBy(group_col).pivot(system_col, list(systems)).agg(
        F.avg(F.col(correct_col).cast("double")))


def mix_by_ratio(df: DataFrame, ratios: Mapping[str, float], source_col="source", id_col="doc_id",
                 seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Keep a share of each source, by the hash of the id, and add ``mix_order`` to interleave them.

    Sources without a ratio are left out. Rows sorted by ``mix_order`` are a random mixture.
    """
    share = lookup({k: float(v) for k, v in ratios.items()}, F.col(source_col))
    kept = df.where(unit_draw(f"{seed}:mix", id_col) < share)
    return kept.withColumn("mix_order", seeded_hash(f"{seed}:order", id_col))


def flag_boilerplate(df: DataFrame, min_documents: int, id_col="doc_id", text_col="text") -> DataFrame:
    """Per document its distinct non-blank lines, and how many of them ``min_documents`` or more documents have.

    Lines are counted by hash with map-side combine. Only lines that are common
    come back to the documents, which a very common line reaches by a join that can be split.
    """
    lines = df.select(id_col, F.explode(F.array_distinct(F.filter(
        F.transform(F.split(F.coalesce(text_col, F.lit("")), "\n"), F.trim), lambda x: x != ""))).alias("_line"))
    hashed = lines.select(id_col, F.xxhash64("_line").alias("_line"))
    common = hashed.groupBy("_line").agg(F.count("*").alias("_n")).where(
        F.col("_n") >= min_documents).select("_line", F.lit(1).alias("_common"))
    return hashed.join(common, "_line", "left").groupBy(id_col).agg(
        F.count("*").alias("n_lines"), F.count("_common").alias("n_common"))


def license_gate(df: DataFrame, allowed: Mapping[str, str], denied: Mapping[str, str],
                 text_col="text") -> DataFrame:
    """Add ``license`` (the first pattern's name that matches, denied ones first) and ``verdict``.

    ``verdict`` is ``deny``, ``allow`` or, without a licence text, ``unknown``.
    """
    name, verdict = F.lit(None).cast("string"), F.lit("unknown")
    for patterns, outcome in ((allowed, "allow"), (denied, "deny")):
        for key, pattern in reversed(patterns.items()):
            found = F.coalesce(F.col(text_col).rlike(pattern), F.lit(False))
            name, verdict = F.when(found, key).otherwise(name), F.when(found, outcome).otherwise(verdict)
    return df.withColumns({"license": name, "verdict": verdict})


def rejection_sample(results: DataFrame, keys: Sequence[str], passed_col: str) -> DataFrame:
    """Per solution the number of tests and ``kept``: it passes all; the others are the negatives."""
    passed = F.coalesce(F.col(passed_col), F.lit(False))
    return results.groupBy(*keys).agg(F.count("*").alias("n_tests"), F.bool_and(passed).alias("kept"))


def error_histogram(results: DataFrame, message_col: str) -> DataFrame:
    """Kinds of exception (the name before the first colon of the last line) with count and share."""
    kind = F.regexp_extract(F.substring_index(message_col, "\n", -1), r"^([A-Za-z_][\w.]*(?:Error|Exception))(?::|$)", 1)
    counted = results.where(F.col(message_col).isNotNull()).groupBy(
        F.when(kind == "", "other").otherwise(kind).alias("kind")).agg(F.count("*").alias("n"))
    # one row per kind: few
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def behavior_clusters(results: DataFrame, task_col: str, solution_col: str, test_col: str,
                      output_col: str) -> DataFrame:
    """Solutions of a task with the same output on every test: ``cluster`` is the smallest of them.

    A solution's behaviour is an order-free sum of hashes, so its outputs are combined before the shuffle.
    """
    one = F.xxhash64(test_col, output_col).cast("decimal(20,0)")
    behaviour = results.groupBy(task_col, solution_col).agg(
        F.sum(one).alias("_sum"), F.count("*").alias("_n"))
    same = behaviour.groupBy(task_col, "_sum", "_n").agg(
        F.min(solution_col).alias("cluster"), F.count("*").alias("size"))
    return behaviour.join(same, [task_col, "_sum", "_n"]).select(task_col, solution_col, "cluster", "size")


def disagreement_select(first: DataFrame, second: DataFrame, id_col: str, score_col: str,
                        threshold: float) -> DataFrame:
    """Samples that two critics score more than ``threshold`` apart."""
    both = first.select(id_col, F.col(score_col).alias("first_score")).join(
        second.select(id_col, F.col(score_col).alias("second_score")), id_col)
    apart = F.abs(F.col("first_score") - F.col("second_score"))
    return both.withColumn("difference", apart).where(F.col("difference") > threshold)


def citation_precision(cited: DataFrame, retrieved: DataFrame, query_col: str, fact_col: str) -> DataFrame:
    """Per query: cited facts, those among what was retrieved, and their share."""
    there = retrieved.select(query_col, fact_col, F.lit(1).alias("_there")).distinct()
    facts = cited.select(query_col, fact_col).distinct().join(there, [query_col, fact_col], "left")
    return facts.groupBy(query_col).agg(
        F.count("*").alias("n_cited"), F.count("_there").alias("n_found")).withColumn(
        "precision", F.col("n_found") / F.col("n_cited"))

"""Corpus statistics and model-free language statistics.

Units are always named: ``nats`` for natural logarithms, ``bits`` for base two.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.hashing import DEFAULT_SEED, unit_draw
from loomline.functions.tokenizers import words
from loomline.operators.ordering import PART, ROW, global_rank, range_sorted, totals_before
from loomline.session import materialize

LN2 = 0.6931471805599453


def corpus_stats(df: DataFrame, n_tokens: Column, n_bytes: Column, split_col="split",
                 lang_col="lang") -> DataFrame:
    """Documents, tokens and bytes per split and language, with totals (NULL = all).

    The rollup runs over the small grouped table, so rows are not tripled first.
    """
    per_cell = df.groupBy(split_col, lang_col).agg(
        F.count("*").alias("n_docs"),
        F.sum(n_tokens.cast("bigint")).alias("n_tokens"),
        F.sum(n_bytes.cast("bigint")).alias("n_bytes"),
    )
    return per_cell.rollup(split_col, lang_col).agg(
        *[F.sum(name).alias(name) for name in ("n_docs", "n_tokens", "n_bytes")]
    )


def word_counts(df: DataFrame, text_col="text", by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of each word: columns (*by, word, n)."""
    return (
        df.select(*by, F.explode(words(text_col)).alias("word"))
        .groupBy(*by, "word").agg(F.count("*").alias("n"))
    )


def token_frequency(df: DataFrame, text_col="text") -> DataFrame:
    """Count of each token and its rank by (count descending, token)."""
    counts = word_counts(df, text_col).select(F.col("word").alias("token"), "n")
    return global_rank(counts, [F.desc("n"), F.asc("token")], "rank")


def dominance_audit(df: DataFrame, text_col="text", split_col="split",
                    reference_split: str = "train") -> DataFrame:
    """How far one token dominates each split.

    ``share`` is that of the split's own top token. ``constant_share`` is that of
    the top token of the reference split: the accuracy of always predicting it.
    """
    counts = materialize(word_counts(df, text_col, by=[split_col]))
    strongest = F.max_by("word", F.struct(F.col("n"), F.col("word")))
    constant = (
        counts.where(F.col(split_col) == reference_split).agg(strongest.alias("word")).scalar()
    )
    return counts.groupBy(split_col).agg(
        strongest.alias("top_token"),
        F.max("n").alias("top_n"),
        F.sum("n").alias("n_tokens"),
        F.sum(F.when(F.col("word") == constant, F.col("n")).otherwise(0)).alias("_constant_n"),
    ).select(
        split_col, "top_token", "top_n", "n_tokens",
        (F.col("top_n") / F.col("n_tokens")).alias("share"),
        (F.col("_constant_n") / F.col("n_tokens")).alias("constant_share"),
    )


def next_token_counts(df: DataFrame, text_col="text", by: Sequence[str] = (),
                      with_start: bool = False) -> DataFrame:
    """How often ``token`` is followed by ``next_token`` within a document.

    Pairs are made inside the row, so counting them is the only shuffle.
    ``with_start`` also counts the first word of each document, after a NULL.
    """
    listed = df.select(*by, words(text_col).alias("_w"))
    n = F.size("_w")
    if with_start:
        before = F.concat(F.array(F.lit(None).cast("string")), F.col("_w"))
        followed = F.arrays_zip(
            F.slice(before, F.lit(1), n).alias("token"), F.col("_w").alias("next_token")
        )
    else:
        followed = F.when(n > 1, F.arrays_zip(
            F.slice("_w", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("token"),
            F.slice("_w", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("next_token"),
        ))
    return (
        listed.select(*by, F.inline(followed).alias("token", "next_token"))
        .groupBy(*by, "token", "next_token").agg(F.count("*").alias("n"))
    )


def next_token_topk(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` likeliest next tokens of every context with their probability.

    The rank limit is applied before the shuffle as well as after it, so a very common
    context sends at most ``k`` rows per task. Totals are a separate combined sum.
    """
    likeliest = F.row_number().over(
        Window.partitionBy("token").orderBy(F.desc("n"), F.asc("next_token"))
    )
    top = pairs.withColumn("rank", likeliest).where(F.col("rank") <= k)
    totals = pairs.groupBy("token").agg(F.sum("n").alias("_total"))
    return top.join(totals, "token").select(
        "token", "rank", "next_token", "n", (F.col("n") / F.col("_total")).alias("prob")
    )


def sample_candidates(scores: DataFrame, *, temperature: float = 1.0,
                      repetition_penalty: float = 1.0, top_k: int | None = None,
                      top_p: float | None = None, seed: int | str = DEFAULT_SEED,
                      group_col="grp", item_col="item", logit_col="logit",
                      seen_col: str | None = "seen") -> DataFrame:
    """Filter scored candidates and draw one per group.

    Columns (grp, item, prob, drawn) of the surviving items. Scores are divided
    by the temperature, then those of seen items by the penalty, whatever their
    sign. ``top_k`` keeps ties with the k-th score. ``top_p`` keeps an item while
    the probability before it is at most p, so the first one always stays.

    Running sums go over range partitions, so a vocabulary of any size is fine.
    """
    score = F.col(logit_col) / temperature
    if seen_col is not None and repetition_penalty != 1.0:
        score = F.when(F.col(seen_col), score / repetition_penalty).otherwise(score)
    ranked = scores.select(
        F.col(group_col).alias("grp"), F.col(item_col).alias("item"), score.alias("score")
    )
    if top_k is not None:
        best = Window.partitionBy("grp").orderBy(F.desc("score"))
        ranked = ranked.withColumn("_r", F.rank().over(best)).where(F.col("_r") <= top_k).drop("_r")

    ordered = range_sorted(ranked, ["grp", F.desc("score"), F.asc("item")])

    def scan(df: DataFrame, name: str, kind: str, value: Column) -> DataFrame:
        return totals_before(df, PART, [ROW], {name: (kind, value)}, group=["grp"], whole=True)

    peaked = scan(ordered, "peak", "max", F.col("score")).drop("peak")
    weighed = peaked.withColumn("mass", F.exp(F.col("score") - F.col("peak_all")))
    summed = scan(weighed, "before", "sum", F.col("mass"))
    if top_p is not None:
        summed = summed.where(F.col("before") <= F.col("before_all") * top_p)
    kept = scan(summed.drop("before", "before_all"), "before", "sum", F.col("mass"))
    target = unit_draw(f"{seed}:draw", "grp") * F.col("before_all")
    return kept.select(
        "grp", "item", (F.col("mass") / F.col("before_all")).alias("prob"),
        ((F.col("before") <= target) & (target < F.col("before") + F.col("mass"))).alias("drawn"),
    )


def greedy_candidates(scores: DataFrame, group_col="grp", item_col="item",
                      logit_col="logit") -> DataFrame:
    """The best item of every group; no filter applies."""
    return scores.groupBy(F.col(group_col).alias("grp")).agg(
        F.max_by(item_col, F.struct(F.col(logit_col), F.col(item_col))).alias("item")
    )


def split_loss(losses: DataFrame, split_col="split", batch_col="batch", nats_col="nats",
               weight_col: str | None = None) -> DataFrame:
    """Mean over batches of the mean loss within a batch.

    ``weight_col`` lets equal losses of a batch come as one counted row.
    """
    weight = F.col(weight_col) if weight_col else F.lit(1)
    per_batch = losses.groupBy(split_col, batch_col).agg(
        (F.sum(F.col(nats_col) * weight) / F.sum(weight)).alias("batch_loss")
    )
    return per_batch.groupBy(split_col).agg(
        F.avg("batch_loss").alias("loss_nats"), F.count("*").alias("n_batches")
    )


def perplexity_by_class(df: DataFrame, class_col="lang", text_col="text") -> DataFrame:
    """``exp(mean nats)`` of each text class under an add-one smoothed bigram count.

    A pair costs ``ln(c(a) + V) - ln(c(a, b) + 1)``. The two terms are summed
    apart, each over rows that meet at most once per class, so no frequent
    context becomes a hot join key. The counted pairs are written once; the
    texts are read once.
    """
    counted = materialize(next_token_counts(df, text_col, by=[class_col], with_start=True))
    vocabulary = counted.agg(F.count_distinct("next_token")).scalar()
    per_class = counted.where("token is not null")

    def shared(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return table.withColumn(name, F.sum("n").over(Window.partitionBy(*keys)))

    contexts = per_class.groupBy(class_col, "token").agg(F.sum("n").alias("n"))
    context_cost = shared(contexts, ["token"], "all_n").groupBy(class_col).agg(
        F.sum(F.col("n") * F.ln(F.col("all_n") + vocabulary)).alias("context_nats"),
        F.sum("n").alias("n_pairs"),
    )
    pair_gain = shared(per_class, ["token", "next_token"], "all_n").groupBy(class_col).agg(
        F.sum(F.col("n") * F.ln(F.col("all_n") + 1)).alias("pair_nats")
    )
    mean = (F.col("context_nats") - F.col("pair_nats")) / F.col("n_pairs")
    return context_cost.join(pair_gain, class_col).select(
        class_col, "n_pairs", mean.alias("mean_nats"), F.exp(mean).alias("perplexity")
    )


def bits_per_byte(losses: DataFrame, nats_col="nats", bytes_col="nbytes",
                  weight_col: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Total nats of tokens that have bytes, over ``ln 2`` times the total bytes."""
    weight = F.col(weight_col) if weight_col else F.lit(1)
    counted = F.when(F.col(bytes_col) > 0, F.col(nats_col) * weight).otherwise(0.0)
    return losses.groupBy(*by).agg(
        F.sum(counted).alias("total_nats"), F.sum(F.col(bytes_col) * weight).alias("total_bytes")
    ).withColumn("bits_per_byte", F.col("total_nats") / (F.col("total_bytes") * F.lit(LN2)))


def compression_report(losses: DataFrame, vocab_size: int, nats_col="nats",
                       weight_col: str | None = None, by: Sequence[str] = ("split",)) -> DataFrame:
    """Mean bits per token against the uniform ``log2(V)``, which an untrained model costs."""
    weight = F.col(weight_col) if weight_col else F.lit(1)
    bits = F.sum(F.col(nats_col) * weight) / F.sum(weight) / F.lit(LN2)
    uniform = F.log2(F.lit(float(vocab_size)))
    return losses.groupBy(*by).agg(
        F.sum(weight).alias("n_tokens"), bits.alias("bits_per_token")
    ).withColumns({
        "uniform_bits": uniform, "compression_ratio": uniform / F.col("bits_per_token"),
    })


def token_budget(runs: DataFrame, tokens_on_hand: Column, tokens_per_param: int = 20) -> DataFrame:
    """Tokens a run needs at ``tokens_per_param`` and how many times too few there are."""
    required = F.col("n_params") * tokens_per_param
    return runs.withColumns({
        "tokens_required": required,
        "tokens_on_hand": tokens_on_hand,
        "shortfall_factor": required / tokens_on_hand,
        "enough": tokens_on_hand >= required,
    })


def diversity_grid(df: DataFrame, dimensions: Mapping[str, Sequence], target: int = 1) -> DataFrame:
    """Coverage of all combinations of the dimensions' values, and of every subset of the dimensions.

    One row per cell of the cube: the dimensions (null: all values; ``level`` says which, as the cube's grouping
    number), ``n_rows``, ``n_cells`` of the grid in it, ``n_empty`` of them, and ``n_short``: the rows that its cells lack to
    have ``target`` each. Combinations that occur but aren't on the grid count in ``n_rows`` and ``n_outside``, not
    as cells; a missing value stands as ``(none)``. Rows are combined before the shuffle; the grid is a literal list.
    """
    names = list(dimensions)
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias(c)
    counted = df.groupBy(*[value(c) for c in names]).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(1).select()
    for c in names:
        grid = grid.select("*", F.explode(F.array(*[F.lit(str(v)) for v in dict.fromkeys(dimensions[c])])).alias(c))
    cells = grid.withColumn("cell", F.lit(1)).join(counted, names, "full").select(
        *names, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("cell", F.lit(0)).alias("cell"))
    lack = F.when(F.col("cell") == 1, F.greatest(F.lit(target) - F.col("n"), F.lit(0))).otherwise(0)
    return cells.cube(*names).agg(
        F.grouping_id().cast("bigint").alias("level"), F.sum("n").alias("n_rows"),
        F.sum("cell").cast("bigint").alias("n_cells"),
        F.count(F.when((F.col("cell") == 1) & (F.col("n") == 0), 1)).alias("n_empty"),
        F.sum(lack).cast("bigint").alias("n_short"),
        F.sum(F.when(F.col("cell") == 0, F.col("n")).otherwise(0)).alias("n_outside"))

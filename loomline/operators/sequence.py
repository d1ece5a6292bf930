"""From documents to an ordered token stream, training blocks and FIM examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv
from loomline.functions.hashing import DEFAULT_SEED, seeded_hash, unit_draw
from loomline.operators.ordering import hash_cutoff, hash_position, in_hash_order, totals_before
from loomline.session import materialize, write_once


def shuffle_documents(df: DataFrame, id_col="doc_id", seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Random order of documents: adds ``position``, the place of each in that order."""
    return hash_position(df, id_col, seed)


def split_train_val(df: DataFrame, ratio: float = 0.05, id_col="doc_id",
                    seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Exactly ``max(1, int(N * ratio))`` rows become ``val``: the first in shuffled order.

    The cut is one pair of numbers, so the table itself is not shuffled. ``df``
    is scanned for its ids to find it; give a table, not a long computation.
    """
    cut = hash_cutoff(df, id_col, seed, ratio)
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    hashed = seeded_hash(seed, id_col)
    last_hash, last_id = (F.lit(value) for value in cut)
    in_val = (hashed < last_hash) | ((hashed == last_hash) & (F.col(id_col) <= last_id))
    return df.withColumn("split", F.when(in_val, F.lit("val")).otherwise(F.lit("train")))


def document_spans(df: DataFrame, length: Column, id_col="doc_id", group: Sequence[str] = ("split",),
                   seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Add ``start``, the stream position of each document's first token.

    The stream of a group is its documents in shuffled order. Ids and lengths
    are written once and scanned; the documents themselves are shuffled once to
    meet their position. Ids must be unique.
    """
    lengths = materialize(df.select(*group, id_col, length.cast("bigint").alias("_length")))
    starts = in_hash_order(
        lengths, id_col, seed, {"start": ("sum", F.col("_length"))}, group
    ).select(id_col, "start")
    return df.join(starts, id_col)


def flatten_token_stream(spans: DataFrame, group: Sequence[str] = ("split",)) -> DataFrame:
    """One row per token with its stream position."""
    return spans.select(*group, "start", F.posexplode("tokens").alias("_at", "token")).select(
        *group, (F.col("start") + F.col("_at")).alias("pos"), "token"
    )


def _join_pieces(order: str, pieces: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(pieces))))
    return F.flatten(F.transform(ordered, lambda p: p[pieces]))


def pack_concat(spans: DataFrame, block_size: int, group: Sequence[str] = ("split",)) -> DataFrame:
    """Cut the stream into blocks of ``block_size`` tokens; the last one may be shorter.

    Documents travel as slices, one per block they touch, never token by token.
    """
    start, tokens = F.col("start"), F.col("tokens")
    end = start + F.size(tokens)
    block = F.col("block_no")
    # No filter on the size: it would be pushed down and encode the text once more.
    touched = F.when(F.size(tokens) > 0, F.sequence(
        F.floor(start / block_size), F.floor((end - 1) / block_size)))
    pieces = (
        spans.select(*group, "start", "tokens", F.explode(touched).alias("block_no"))
        .withColumn("_from", F.greatest(start, block * block_size))
        .withColumn("_to", F.least(end, (block + 1) * block_size))
        .select(*group, "block_no", "_from", F.slice(
            tokens, (F.col("_from") - start + 1).cast("int"),
            (F.col("_to") - F.col("_from")).cast("int")).alias("_piece"))
    )
    return pieces.groupBy(*group, "block_no").agg(
        _join_pieces("_from", "_piece").alias("tokens")
    ).withColumn("n_tokens", F.size("tokens"))


def blocks_of_stream(stream: DataFrame, block_size: int, group: Sequence[str] = ("split",)) -> DataFrame:
    """Gather (pos, token) rows into blocks of ``block_size`` tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token")))
    return stream.groupBy(*group, F.floor(F.col("pos") / block_size).alias("block_no")).agg(
        F.transform(ordered, lambda p: p["token"]).alias("tokens")
    )


def split_stream_at_eot(blocks: DataFrame, group: Sequence[str] = ("split",), eot: int = fv.EOT,
                        blocks_per_piece: int = 256) -> DataFrame:
    """Recover documents from stream blocks; a tail without end token is one too.

    Blocks are cut at their end tokens, and a running count of end tokens numbers the
    documents. Every document comes as pieces (``doc_no``, ``piece_no``, tokens):
    what lies in the block where it begins and the next ``blocks_per_piece - 1``
    is piece 0, and so on, so a stream without end tokens does not become one
    row. :func:`stream_documents` has one row per document.

    ``blocks`` is written once, since two passes need it. The first counts the end tokens of stretches of
    blocks; in the second every stretch comes to one task, with the few blocks behind it that its last
    pieces may reach into. So the tokens are shuffled once, and where only lengths are read, not at all.
    """
    blocks = write_once(blocks.select(*group, "block_no", "tokens"), "blocks")
    tokens, block = F.col("tokens"), F.col("block_no")
    stretch = max(1024, 16 * blocks_per_piece)
    ends = F.when(F.array_contains(tokens, eot), F.filter(
        F.transform(tokens, lambda t, i: F.when(t == eot, i + 1)), lambda i: i.isNotNull()
    )).otherwise(F.array().cast("array<int>"))
    own = F.floor(block / stretch)
    reached = block - own * stretch < blocks_per_piece - 1
    dealt = blocks.select(
        *group, "block_no", "tokens", F.size(tokens).alias("_size"), ends.alias("_ends"),
        F.when(F.get(tokens, F.size(tokens) - 1) == eot, block + 1).otherwise(block).alias("_next"),
        F.explode(F.when(reached, F.array(own, own - 1)).otherwise(F.array(own))).alias("_stretch"),
    )
    keys = [*group, "_stretch"]
    n_ends = F.size("_ends").cast("bigint")
    begins = F.when(n_ends > 0, F.col("_next"))
    inside = F.col("_stretch") == own
    totals = {"_docs_before": ("sum", "_n"), "_begun": ("max", "_last")}
    counts = materialize(dealt.groupBy(*keys).agg(
        F.sum(F.when(inside, n_ends)).alias("_n"), F.max(F.when(inside, begins)).alias("_last"),
    ))
    earlier = totals_before(
        counts.withColumn("_coarse", F.floor(F.col("_stretch") / 4096)), "_coarse", ["_stretch"],
        {f"_carry{name}": (kind, F.col(value)) for name, (kind, value) in totals.items()}, group=group,
    ).select(*keys, "_carry_docs_before", "_carry_begun")
    before = Window.partitionBy(*keys).orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    marked = dealt.withColumns({
        "_docs_here": F.sum(n_ends).over(before), "_begun_here": F.max(begins).over(before),
    }).join(earlier, keys).withColumns({
        "_docs_before": F.coalesce("_carry_docs_before", zero) + F.coalesce("_docs_here", zero),
        "_begun": F.coalesce(F.greatest("_carry_begun", "_begun_here"), zero),
    })
    starts = F.concat(F.array(F.lit(0)), F.col("_ends"))
    stops = F.concat(F.col("_ends"), F.array(F.col("_size")))
    goes_on = F.col("_nth") == 0  # from the block before; the other documents begin in this one
    pieces = (
        marked.select(
            *keys, "block_no", "tokens", "_docs_before", "_begun",
            F.posexplode(F.arrays_zip(starts.alias("a"), stops.alias("b"))).alias("_nth", "_cut"),
        )
        .where("_cut.b > _cut.a")
        .withColumn("piece_no", F.when(goes_on, F.floor((block - F.col("_begun")) / blocks_per_piece))
                    .otherwise(F.lit(0)).cast("bigint"))
        .where(F.floor(F.when(goes_on, F.col("_begun") + F.col("piece_no") * blocks_per_piece)
                       .otherwise(block) / stretch) == F.col("_stretch"))
        .select(
            *keys, "block_no", (F.col("_docs_before") + F.col("_nth")).alias("doc_no"), "piece_no",
            (F.col("_cut.b") - F.col("_cut.a")).alias("_length"),
            F.slice("tokens", F.col("_cut.a") + 1, F.col("_cut.b") - F.col("_cut.a")).alias("_piece"),
        )
    )
    return pieces.groupBy(*keys, "doc_no", "piece_no").agg(
        _join_pieces("block_no", "_piece").alias("tokens"), F.sum("_length").cast("int").alias("n_tokens"),
    ).drop("_stretch")


def stream_documents(pieces: DataFrame, group: Sequence[str] = ("split",)) -> DataFrame:
    """One row per document of a split stream: its number of pieces and of tokens."""
    return pieces.groupBy(*group, "doc_no").agg(
        F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))


def sample_blocks(blocks: DataFrame, draws: DataFrame, length: Column, block_size: int,
                  draw_col="draw", seed: int | str = DEFAULT_SEED) -> DataFrame:
    """For each draw a window of ``block_size + 1`` tokens at a random stream position.

    ``blocks`` is one stream cut by :func:`pack_concat` with the same
    ``block_size``, ``length`` its number of tokens. Starts are uniform in
    ``[0, length - block_size)``, with replacement. A window touches two neighbouring
    blocks, found by an equi-join.
    """
    start = F.pmod(seeded_hash(f"{seed}:block", draw_col), length - block_size)
    wanted = draws.select(draw_col, start.alias("start")).withColumn(
        "_first", F.floor(F.col("start") / block_size)
    )
    halves = wanted.withColumn(
        "block_no", F.explode(F.array(F.col("_first"), F.col("_first") + 1))
    ).join(blocks.select("block_no", F.col("tokens").alias("_piece")), "block_no")
    gathered = halves.groupBy(draw_col, "start", "_first").agg(
        _join_pieces("block_no", "_piece").alias("_both")
    )
    offset = (F.col("start") - F.col("_first") * block_size).cast("int")
    return gathered.select(
        draw_col, "start", F.slice("_both", offset + 1, F.lit(block_size + 1)).alias("tokens")
    )


def lm_pairs(windows: DataFrame, tokens_col="tokens") -> DataFrame:
    """Inputs ``x`` and next-token targets ``y``, both one shorter than the window."""
    n = F.size(tokens_col) - 1
    return windows.withColumns({
        "x": F.slice(tokens_col, F.lit(1), F.greatest(n, F.lit(0))),
        "y": F.slice(tokens_col, F.lit(2), F.greatest(n, F.lit(0))),
    })


def fim_transform(df: DataFrame, id_col: str, fim_rate: float = 0.5, spm_rate: float = 0.5,
                  seed: int | str = DEFAULT_SEED, tokens_col="tokens") -> DataFrame:
    """Rearrange a share of the sequences for fill-in-the-middle training.

    Two distinct cuts leave three non-empty parts. Adds ``mode``: ``psm``,
    ``spm`` or ``none``; fewer than three tokens always give ``none``.
    """
    tokens = F.col(tokens_col)
    n = F.size(tokens)
    first = 1 + F.pmod(seeded_hash(f"{seed}:fim_cut1", id_col), F.greatest(n - 1, F.lit(1)))
    second = 1 + F.pmod(seeded_hash(f"{seed}:fim_cut2", id_col), F.greatest(n - 2, F.lit(1)))
    mode = F.when(
        (n < 3) | (unit_draw(f"{seed}:fim_apply", id_col) >= fim_rate), "none"
    ).when(unit_draw(f"{seed}:fim_mode", id_col) < spm_rate, "spm").otherwise("psm")
    planned = df.withColumns({"mode": mode, "_a": first.cast("int"), "_b": second.cast("int")})
    planned = planned.withColumn("_b", F.when(F.col("_b") >= F.col("_a"), F.col("_b") + 1)
                                 .otherwise(F.col("_b")))
    planned = planned.withColumns({"_a": F.least("_a", "_b"), "_b": F.greatest("_a", "_b")})
    prefix = F.concat(F.array(F.lit(fv.FIM_PREFIX)), F.slice(tokens, F.lit(1), F.col("_a")))
    middle = F.concat(F.array(F.lit(fv.FIM_MIDDLE)),
                      F.slice(tokens, F.col("_a") + 1, F.col("_b") - F.col("_a")))
    suffix = F.concat(F.array(F.lit(fv.FIM_SUFFIX)),
                      F.slice(tokens, F.col("_b") + 1, F.greatest(n - F.col("_b"), F.lit(0))))
    rearranged = (
        F.when(F.col("mode") == "psm", F.concat(prefix, suffix, middle))
        .when(F.col("mode") == "spm", F.concat(suffix, prefix, middle))
        .otherwise(tokens)
    )
    return planned.withColumn(tokens_col, rearranged).drop("_a", "_b")


def fim_pad_mask(df: DataFrame, block_size: int, tokens_col="tokens") -> DataFrame:
    """Cut or pad to ``block_size``, then ``x = t[:-1]``, ``y = t[1:]`` with padding masked as -1."""
    tokens = F.slice(tokens_col, F.lit(1), F.lit(block_size))
    fitted = F.concat(
        tokens, F.array_repeat(F.lit(fv.FIM_PAD), F.lit(block_size) - F.size(tokens))
    )
    sized = df.withColumn("_fitted", fitted)
    return sized.withColumns({
        "x": F.slice("_fitted", 1, block_size - 1),
        "y": F.transform(
            F.slice("_fitted", 2, block_size - 1),
            lambda t: F.when(t == fv.FIM_PAD, F.lit(-1)).otherwise(t),
        ),
    }).drop("_fitted")

"""Language detection, encoding, decoding and prompts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import fixed_values as fv
from loomline.functions.lookup import lookup
from loomline.functions.tokenizers import BYTES
from loomline.operators.ordering import totals_before
from loomline.session import bound_batches, materialize


def extension(path: Column) -> Column:
    """Last extension of the base name, lower-cased; leading dots do not start one."""
    base = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(base, r"^\.*[^.].*(\.[^.]*)$", 1))


def language_of_path(path: Column) -> Column:
    return F.coalesce(lookup(fv.EXTENSION_LANGUAGE, extension(path)), F.lit("other"))


def detect_language(df: DataFrame, path_col="path", lang_col="lang") -> DataFrame:
    return df.withColumn(lang_col, language_of_path(F.col(path_col)))


def language_token(lang: Column) -> Column:
    """Id of the language token, NULL for a language that has none."""
    return lookup(fv.LANGUAGE_IDS, lang)


def lang_token_id(df: DataFrame, lang_col="lang", out_col="lang_id") -> DataFrame:
    """Id of the language token; unknown languages get the one of ``other``."""
    return df.withColumn(
        out_col, F.coalesce(language_token(F.col(lang_col)), F.lit(fv.OTHER_LANGUAGE))
    )


def _ids(*ids: int) -> Column:
    return F.array(*[F.lit(i) for i in ids])


def _opening(lang: Column | None) -> Column:
    if lang is None:
        return _ids(fv.CODE_START)
    token = language_token(lang)
    return F.when(
        token.isNotNull(), F.array(F.lit(fv.CODE_START), token)
    ).otherwise(_ids(fv.CODE_START))


def code_envelope(body: Column, lang: Column | None) -> Column:
    """``code_start [lang] body code_end eot``; an unknown language adds no token."""
    return F.concat(_opening(lang), body, _ids(fv.CODE_END, fv.EOT))


def text_envelope(body: Column) -> Column:
    """``body eot``, for web text."""
    return F.concat(body, _ids(fv.EOT))


def encode_document(df: DataFrame, tokenizer=BYTES, text_col="text", lang_col: str | None = "lang",
                    envelope: str = "code") -> DataFrame:
    """Add ``tokens`` and ``n_tokens``. ``envelope`` is ``code`` or ``text``."""
    bound_batches(df.sparkSession)
    body = tokenizer.encode(F.col(text_col))
    if envelope == "code":
        tokens = code_envelope(body, F.col(lang_col) if lang_col else None)
    else:
        tokens = text_envelope(body)
    return df.withColumn("tokens", tokens).withColumn("n_tokens", F.size("tokens"))


def tokenize_corpus(df: DataFrame, tokenizer=BYTES, text_col="text") -> DataFrame:
    """Body tokens of every document with their number and the characters per token."""
    bound_batches(df.sparkSession)
    encoded = df.withColumn("tokens", tokenizer.encode(F.col(text_col)))
    n_tokens = F.size("tokens")
    return encoded.withColumns({
        "n_tokens": n_tokens,
        "chars_per_token": F.when(n_tokens > 0, F.char_length(text_col) / n_tokens),
    })


def decode_tokens(tokens: Column, tokenizer=BYTES, raw: bool = False) -> Column:
    """Text of a token column. Special tokens vanish.

    Runs between special tokens are decoded one by one, so a character cut by a
    special token is damaged. ``raw`` joins the runs first.
    """

    @F.arrow_udf(T.StringType())
    def to_text(column: pa.Array) -> pa.Array:
        texts = []
        for scalar in column:
            if not scalar.is_valid:
                texts.append(None)
                continue
            ids = np.asarray(scalar.values)
            special = (ids >= fv.FIRST_SPECIAL) & (ids <= fv.LAST_SPECIAL)
            if raw:
                runs = [ids[~special]]
            else:
                runs = [run[~mask] for run, mask in zip(
                    np.split(ids, np.flatnonzero(special)),
                    np.split(special, np.flatnonzero(special)),
                )]
            texts.append("".join(
                tokenizer.to_bytes(run.tolist()).decode("utf-8", errors="replace") for run in runs
            ))
        return pa.array(texts, pa.string())

    return to_text(tokens)


def detokenize_audit(df: DataFrame, tokenizer=BYTES, tokens_col="tokens", text_col="text",
                     raw: bool = False) -> DataFrame:
    """Add ``decoded`` and ``round_trips`` (decoded text equals the original)."""
    bound_batches(df.sparkSession)
    decoded = df.withColumn("decoded", decode_tokens(F.col(tokens_col), tokenizer, raw))
    return decoded.withColumn("round_trips", F.col("decoded").eqNullSafe(F.col(text_col)))


def completion_prompt(body: Column, lang: Column | None) -> Column:
    """``code_start [lang] body``, left open for the model to go on."""
    return F.concat(_opening(lang), body)


def build_completion_prompt(df: DataFrame, tokenizer=BYTES, text_col="text",
                            lang_col: str | None = "lang") -> DataFrame:
    bound_batches(df.sparkSession)
    lang = F.col(lang_col) if lang_col else None
    return df.withColumn("prompt", completion_prompt(tokenizer.encode(F.col(text_col)), lang))


def build_fim_prompt(df: DataFrame, tokenizer=BYTES, prefix_col="prefix",
                     suffix_col="suffix") -> DataFrame:
    """``fim_prefix prefix fim_suffix suffix fim_middle``."""
    bound_batches(df.sparkSession)
    return df.withColumn("prompt", F.concat(
        _ids(fv.FIM_PREFIX), tokenizer.encode(F.col(prefix_col)),
        _ids(fv.FIM_SUFFIX), tokenizer.encode(F.col(suffix_col)),
        _ids(fv.FIM_MIDDLE),
    ))


def truncate_tokens(tokens: Column, stops=(fv.EOT, fv.CODE_END)) -> Column:
    """Tokens before the first stop token."""
    first_stop = F.lit(None).cast("int")
    for stop in stops:
        first_stop = F.least(first_stop, F.nullif(F.array_position(tokens, stop), F.lit(0)).cast("int"))
    return F.when(first_stop.isNull(), tokens).otherwise(
        F.slice(tokens, F.lit(1), F.coalesce(first_stop, F.lit(1)) - 1)
    )


def truncate_text(text: Column) -> Column:
    """Text before the first triple newline."""
    return F.substring_index(text, "\n\n\n", 1)


def truncate_at_stop(df: DataFrame, tokens_col="tokens", text_col="text") -> DataFrame:
    return df.withColumns({
        "kept_tokens": truncate_tokens(F.col(tokens_col)),
        "kept_text": truncate_text(F.col(text_col)),
    })


def conversation_context(turns: DataFrame, block_size: int, conv_col="conv_id", turn_col="turn",
                         role_col="role", text_col="text", turns_per_bucket: int = 1024) -> DataFrame:
    """The running context after each turn: the last ``3 * block_size`` characters so far.

    A user turn starts on a new line unless nothing was said before; an answer
    follows its prompt directly.

    No window holds a whole conversation. The lengths of the turns are written
    once and give each turn its character offset by two-level running sums. The texts
    then meet their offset, are cut at multiples of the limit, and every piece
    is sent to its own block and the next one, so a block gathers at most twice
    the limit. The context of a turn is cut from exactly one block.
    """
    limit = 3 * block_size
    keys = [conv_col, turn_col]
    text = F.coalesce(text_col, F.lit(""))
    lengths = materialize(turns.select(
        *keys, (F.col(role_col) == "user").alias("_user"),
        F.char_length(text).cast("bigint").alias("_length"),
        F.floor(F.col(turn_col) / turns_per_bucket).alias("_bucket"),
    ))
    spoken = totals_before(
        lengths, "_bucket", [turn_col], {"_spoken": ("max", F.col("_length") > 0)},
        group=[conv_col], fanout=4096,
    )
    new_line = F.coalesce(F.col("_user") & F.col("_spoken"), F.lit(False))
    sized = spoken.select(*keys, "_bucket", new_line.alias("_new_line"),
                          (F.col("_length") + new_line.cast("int")).alias("_length"))
    placed = materialize(totals_before(
        sized, "_bucket", [turn_col], {"_start": ("sum", F.col("_length"))},
        group=[conv_col], fanout=4096,
    ).select(*keys, "_new_line", "_start", (F.col("_start") + F.col("_length")).alias("_end")))

    block = F.col("_block")
    said = turns.select(*keys, text.alias("_text")).join(placed, keys)
    pieces = (
        said.where("_end > _start")
        .withColumn("_text", F.when(F.col("_new_line"), F.concat(F.lit("\n"), "_text"))
                    .otherwise(F.col("_text")))
        .withColumn("_block", F.explode(F.sequence(
            F.floor(F.col("_start") / limit), F.floor((F.col("_end") - 1) / limit))))
        .withColumn("_from", F.greatest(F.col("_start"), block * limit))
        .withColumn("_to", F.least(F.col("_end"), (block + 1) * limit))
        .select(
            conv_col, "_from",
            F.substring(
                "_text", (F.col("_from") - F.col("_start") + 1).cast("int"),
                (F.col("_to") - F.col("_from")).cast("int"),
            ).alias("_piece"),
            F.explode(F.array(block, block + 1)).alias("_block"),
        )
    )
    blocks = pieces.groupBy(conv_col, "_block").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_from", "_piece"))),
                        lambda p: p["_piece"]), "",
        ).alias("_near")
    )
    ends = placed.select(
        *keys, "_end", F.floor((F.greatest(F.col("_end"), F.lit(1)) - 1) / limit).alias("_block")
    )
    near_start = F.greatest(block - 1, F.lit(0)) * limit
    so_far = F.substring("_near", F.lit(1), (F.col("_end") - near_start).cast("int"))
    return ends.join(blocks, [conv_col, "_block"], "left").select(
        *keys, F.coalesce(F.right(so_far, F.lit(limit)), F.lit("")).alias("context")
    )

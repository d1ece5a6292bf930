"""Caps, language selection and quarantine."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import fixed_values as fv
from loomline.functions.lookup import lookup
from loomline.functions.tokenizers import TOKENS
from loomline.operators.filters import char_length_ok
from loomline.operators.ordering import smallest_ids
from loomline.session import bound_batches, materialize


def cap_examined(df: DataFrame, max_samples: int, id_col="doc_id", text_col="text",
                 low=fv.MIN_SAMPLE_CHARS, high=fv.MAX_SAMPLE_CHARS) -> DataFrame:
    """Look at the first ``max_samples`` raw rows, then filter by length.

    The cap becomes a comparison with one id, found by counting ids. No sort of
    the table; the comparison is pushed into the scan.
    """
    cutoff = smallest_ids(df, id_col, max_samples).select("cutoff").first()
    examined = df if cutoff is None else df.where(F.col(id_col) <= cutoff[0])
    return examined.where(char_length_ok(F.col(text_col), low, high))


def within_cutoffs(df: DataFrame, ids: DataFrame, count, id_col: str, lang_col: str) -> DataFrame:
    """Rows of ``df`` up to the ``count``-th id of ``ids`` in their language.

    The cutoffs are one number per language, so they become part of the filter.
    """
    cutoffs = {row[lang_col]: row["cutoff"]
               for row in smallest_ids(ids, id_col, count, group=lang_col).collect()}
    if not cutoffs:
        return df
    cutoff = lookup(cutoffs, F.col(lang_col))
    return df.where(cutoff.isNull() | (F.col(id_col) <= cutoff))


def cap_per_language(df: DataFrame, max_per_language: int, languages: Sequence[str],
                     id_col="doc_id", lang_col="lang", text_col="text",
                     low=fv.MIN_SAMPLE_CHARS, high=fv.MAX_MULTILANG_CHARS) -> DataFrame:
    """Filter by length first, then keep the first ``max_per_language`` rows of each language.

    The accepted (language, id) pairs are written once and counted; the texts
    are not shuffled.
    """
    accepted = df.where(F.col(lang_col).isin(list(languages))).where(
        char_length_ok(F.col(text_col), low, high)
    )
    ids = materialize(accepted.select(lang_col, id_col))
    return within_cutoffs(accepted, ids, max_per_language, id_col, lang_col)


def dataset_language(language: Column, names=fv.DATASET_LANGUAGE_NAMES) -> Column:
    """Directory name of a language in the dataset; unknown names pass through."""
    return F.coalesce(lookup(names, language), language)


def select_languages(df: DataFrame, languages: Sequence[str], dataset_lang_col="dataset_lang",
                     lang_col="lang") -> DataFrame:
    """Rows of the chosen languages, labelled with the chosen name.

    A chosen language that the data does not have contributes nothing.
    """
    by_dataset_name = {fv.DATASET_LANGUAGE_NAMES.get(name, name): name for name in languages}
    chosen = lookup(by_dataset_name, F.col(dataset_lang_col))
    return df.withColumn(lang_col, chosen).where(F.col(lang_col).isNotNull())


ATTEMPT = T.StructType([
    T.StructField("tokens", TOKENS),
    T.StructField("error", T.StringType()),
])


def attempt_encode(content: Column, tokenizer) -> Column:
    """Decode and encode; a failing record gives an error name, not a failed job.

    Valid text goes to the tokenizer batch by batch. Only if a batch fails, and
    for bytes that are no text, records are tried one by one.
    """
    text = content.cast("string")
    valid = F.coalesce(F.is_valid_utf8(text), F.lit(False))

    @F.arrow_udf(ATTEMPT)
    def encode_or_explain(texts: pa.Array, rejected: pa.Array) -> pa.Array:
        errors = []
        for value in rejected.to_pylist():
            try:
                errors.append(None if value is None else value.decode("utf-8") and "InvalidText")
            except UnicodeDecodeError as problem:
                errors.append(type(problem).__name__)
        try:
            tokens = tokenizer.encode_batch(texts)
        except Exception:  # one record or more: find out which
            tokens = []
            for i, value in enumerate(texts.to_pylist()):
                try:
                    tokens.append(None if value is None else tokenizer.encode_one(value))
                except Exception as problem:  # any failure is a reject, whatever its kind
                    tokens.append(None)
                    errors[i] = type(problem).__name__
            tokens = pa.array(tokens, pa.list_(pa.int32()))
        missing = texts.is_null().to_pylist()
        errors = [e or ("MissingContent" if m and r is None else None) for e, m, r in zip(
            errors, missing, rejected.to_pylist())]
        return pa.StructArray.from_arrays(
            [tokens.cast(pa.list_(pa.int32())), pa.array(errors, pa.string())], ["tokens", "error"])

    return encode_or_explain(F.when(valid, text), F.when(~valid, content))


def quarantine_failures(df: DataFrame, tokenizer, content_col="content") -> tuple[DataFrame, DataFrame]:
    """(good rows with ``tokens``, rejected rows with ``error`` and their content).

    Every record is tried once; the outcome is written, and both tables read it.
    """
    bound_batches(df.sparkSession)
    others = [name for name in df.columns if name != content_col]
    tried = df.withColumn("_attempt", attempt_encode(F.col(content_col), tokenizer))
    failed = F.col("_attempt.error").isNotNull()
    outcome = materialize(tried.select(
        *others, F.when(failed, F.col(content_col)).alias(content_col),
        F.col("_attempt.tokens").alias("tokens"), F.col("_attempt.error").alias("error"),
    ))
    good = outcome.where("error is null").select(*others, "tokens")
    return good, outcome.where("error is not null").drop("tokens")


def quarantine_report(df: DataFrame, tokenizer, content_col="content") -> DataFrame:
    """Rows and tokens per outcome, ``ok`` or the error name, in one pass."""
    bound_batches(df.sparkSession)
    attempt = df.select(attempt_encode(F.col(content_col), tokenizer).alias("attempt"))
    return attempt.groupBy(F.coalesce("attempt.error", F.lit("ok")).alias("outcome")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.size("attempt.tokens").cast("bigint")), F.lit(0)).alias("n_tokens"),
    )

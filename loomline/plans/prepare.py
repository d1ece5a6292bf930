"""The three corpus preparation jobs, end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv
from loomline.functions.hashing import DEFAULT_SEED
from loomline.functions.tokenizers import BYTES
from loomline.operators import caps, filters, sequence, stats, tokens
from loomline.session import materialize, workspace
from loomline.sources import samples, token_dataset, tree


def flagship(documents: DataFrame, ratio: float = 0.05, seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Filter, split exactly, and count per split and language.

    The texts are read once. What the split and the counts need of the
    survivors, an id and two sizes, is written and read instead.
    """
    kept = filters.filter_char_length(
        filters.filter_byte_size(filters.filter_blank(documents)), high=fv.MAX_MULTILANG_CHARS
    )
    sizes = materialize(kept.select(
        "doc_id", "lang", BYTES.count(F.col("text")).alias("n_tokens"),
        F.octet_length("text").alias("n_bytes"),
    ))
    split = sequence.split_train_val(sizes, ratio, seed=seed)
    return stats.corpus_stats(split, F.col("n_tokens"), F.col("n_bytes"))


def _finish(encoded: DataFrame, out: str, ratio: float | None, seed=DEFAULT_SEED, order=None,
            **meta) -> DataFrame:
    """Split, write tokens and metadata, return the metadata row.

    The encoded corpus is written once and read back, since splitting, writing
    and counting all need it and encoding is the expensive part.
    """
    spark = encoded.sparkSession
    staged = workspace(spark, "encoded")
    encoded.write.parquet(staged)
    corpus = spark.read.parquet(staged)
    if ratio is not None:
        corpus = sequence.split_train_val(corpus, ratio, seed=seed)
    token_dataset.write_token_dataset(corpus, f"{out}/tokens", seed=seed, order=order)
    described = token_dataset.corpus_meta(corpus, **meta)
    token_dataset.write_corpus_meta(described, f"{out}/meta")
    return described


def prepare_python_code(spark: SparkSession, out: str, *, source: str = "local",
                        code_dirs: Sequence[str] = (), sample_table: DataFrame | None = None,
                        max_samples: int = 100_000, ratio: float = 0.05,
                        seed: int | str = DEFAULT_SEED, tokenizer=BYTES) -> DataFrame:
    """Python files of ``code_dirs`` and/or a sample table (``doc_id``, ``content``).

    ``source`` is ``local``, ``huggingface`` (the sample table) or ``both``.
    """
    if source not in ("local", "huggingface", "both"):
        raise ValueError(f"unknown source {source!r}")
    local = remote = None
    if source in ("local", "both"):
        files = tokens.detect_language(tree.scan_code_tree(spark, code_dirs))
        local = files.select(
            F.concat(F.lit("file:"), "path").alias("doc_id"),
            filters.lossy_text(F.col("content")).alias("text"), "lang",
        )
    if source in ("huggingface", "both"):
        rows = samples.with_content(sample_table)
        rows = caps.cap_examined(rows, max_samples, text_col="content")
        remote = rows.select(
            F.concat(F.lit("sample:"), F.col("doc_id").cast("string")).alias("doc_id"),
            F.col("content").alias("text"), F.lit("python").alias("lang"),
        )
    rows = samples.combine_sources(local, remote)
    encoded = tokens.encode_document(rows, tokenizer)
    return _finish(encoded, out, ratio, seed, tokenizer=tokenizer.name)


def prepare_multilang_code(sample_table: DataFrame, out: str, *,
                           languages: Sequence[str] = ("python", "javascript", "typescript"),
                           max_per_language: int = 20_000, ratio: float = 0.05,
                           seed: int | str = DEFAULT_SEED, tokenizer=BYTES) -> DataFrame:
    """Sample table (``doc_id``, ``content``, ``dataset_lang``) of several languages."""
    rows = samples.with_content(caps.select_languages(sample_table, languages))
    capped = caps.cap_per_language(rows, max_per_language, languages, text_col="content")
    encoded = tokens.encode_document(
        capped.withColumnRenamed("content", "text"), tokenizer
    ).select("doc_id", "lang", "tokens", "n_tokens")
    return _finish(encoded, out, ratio, seed, tokenizer=tokenizer.name)


def prepare_text_shards(spark: SparkSession, directory: str, out: str, *, pinned: str,
                        num_shards: int = 10, tokenizer=BYTES) -> DataFrame:
    """Web-text parquet shards; the pinned shard is the validation split.

    The shards are shuffled already, so their order is kept.
    """
    rows = filters.filter_blank(samples.read_shards(spark, directory, pinned, num_shards))
    encoded = tokens.encode_document(rows, tokenizer, lang_col=None, envelope="text").select(
        "split", "shard", "row_no", "tokens", "n_tokens"
    )
    return _finish(
        encoded, out, None, order=("shard", "row_no"), vocab_size=fv.TEXT_VOCAB_SIZE,
        tokenizer=tokenizer.name, lang_col=None, shard_col="shard", source=directory,
    )

"""Training-data pipeline: documents in, token ids out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import bpe, language, mixing, secrets, set_join
from loomline.session import ship_package, workspace

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts, as they are."""
    ship_package(spark)
    return language.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return set_join.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    ship_package(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources reach their weights, in random order."""
    ship_package(spark)
    return mixing.replicate(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row."""
    ship_package(spark)
    path = public_tokenizers.path(VOCABULARY)
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scan", mask_secrets),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: Language identification, the join and the encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = workspace(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

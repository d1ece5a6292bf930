"""A quality score of 0 to 5, learnt from labelled documents."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.hashing import DEFAULT_SEED, unit_draw
from loomline.functions.tokenizers import words
from loomline.session import write_once

BUCKETS = 1 << 12
HIGHEST = 5
_FORM = ["_symbols", "_digits", "_spaces", "_lines", "_repeats", "_same_lines", "_word_length", "_length"]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.greatest(whole, F.lit(1)), F.lit(0.0)).cast("double")


def features(df: DataFrame, text_col="text") -> DataFrame:
    """Add the words of each whole text and shares that tell its form."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size, lines = F.length(text), F.split(text, "\n")
    spoken = words(text)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return df.withColumn("_words", spoken).withColumns({
        "_symbols": _share(count(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"), size), "_digits": _share(count(r"\p{N}"), size),
        "_spaces": _share(count(r"\s"), size), "_lines": _share(F.size(lines), F.size("_words")),
        "_repeats": 1.0 - _share(F.size(F.array_distinct("_words")), F.size("_words")),
        "_same_lines": 1.0 - _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "_word_length": _share(size, F.size("_words")), "_length": F.log1p(size.cast("double"))})


def held_out(id_col: str = "doc_id", share: float = 0.25, seed: int | str = DEFAULT_SEED) -> Column:
    """Whether a document is kept from training, by the hash of its id."""
    return F.coalesce(unit_draw(f"{seed}:quality", id_col) < share, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
                seed: int | str = DEFAULT_SEED) -> PipelineModel:
    """Logistic regression on hashed words and form, on the labelled documents that are not held out.

    Gradients are summed over tasks in a tree; the driver holds BUCKETS weights.
    """
    known = labels.where(F.col(label_col).isNotNull()).select(id_col, F.col(label_col).cast("double").alias("_label"))
    rows = features(docs.where(~held_out(id_col, seed=seed)).join(known, id_col), text_col)
    rows = write_once(rows.select(F.array_distinct("_words").alias("_words"), *_FORM, "_label"), "quality-features")
    stages = [
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=BUCKETS, binary=True),
        VectorAssembler(inputCols=_FORM, outputCol="_form"),
        StandardScaler(inputCol="_form", outputCol="_scaled", withMean=True),
        VectorAssembler(inputCols=["_counts", "_scaled"], outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_label", rawPredictionCol="_raw", probabilityCol="_probability",
                           predictionCol="_prediction", regParam=0.02, standardization=False, maxIter=40,
                           aggregationDepth=3),
    ]
    return Pipeline(stages=stages).fit(rows)


def quality_model(docs: DataFrame, model: PipelineModel, id_col="doc_id", text_col="text",
                  seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Per document: id, held_out, probability of good quality, and score: 0 to 5 in equal steps of it.

    Every whole text is scored, a null one as empty. One row per document.
    """
    scored = model.transform(features(docs, text_col))
    probability = vector_to_array("_probability")[1]
    score = F.least(F.floor(probability * (HIGHEST + 1)), F.lit(HIGHEST)).cast("int")
    return scored.select(id_col, held_out(id_col, seed=seed).alias("held_out"), probability.alias("probability"), score.alias("score"))


def held_out_report(scored: DataFrame, labels: DataFrame, id_col="doc_id", label_col="quality") -> DataFrame:
    """Held-out documents by label and score: label, score, n. From it follow error and accuracy."""
    known = labels.where(F.col(label_col).isNotNull()).select(id_col, F.col(label_col).alias("label"))
    return scored.where("held_out").join(known, id_col).groupBy("label", "score").agg(F.count("*").alias("n"))

"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.hashing import unit_draw
from loomline.llm.common import bound_batches, only, release_memory, slices

UNKNOWN = "und"
#: The model is fitted on at most so many texts of a language, chosen by the hash of doc_id.
SAMPLE_PER_LANGUAGE = 600
BUCKETS, DIMENSIONS = 1 << 15, 16
ORDERS = (2, 3, 4)
EPOCHS, RATE = 12, 0.5
#: A text is rejected if at most this share of right calibration texts have so low a score, or so many n-grams that
#: were never learned from.
REJECTED_SHARE = 0.001
#: So many more calibration texts are assumed with score 0 and nothing learned: few texts are no ground for rejection.
ASSUMED = 5
#: Bits of the table of learned n-grams (of four bytes), and n-grams that every text is given: short texts stay.
SEEN_BITS, GIVEN = 20, 8
_MIX = np.uint32(0x9E3779B1)
_STEPS = tuple(np.uint32(x) for x in (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1))


def subword_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash buckets of the byte n-grams that begin at each byte of the lower-cased texts.

    Returns an array (bytes, len(ORDERS)), and where each text begins and ends in it. Between texts
    stand as many spaces as an n-gram has bytes, so that none reaches into another text.
    """
    lower = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_binary())
    lengths = pc.binary_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    gap = max(ORDERS)
    raw = np.frombuffer((b" " * gap).join([*lower.to_pylist(), b" " * gap]), np.uint8).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths + gap)])[:-1].astype(np.int64)
    n = len(raw) - gap
    hashed, out = np.zeros(n, np.uint32), np.empty((n, len(ORDERS)), np.int32)
    for k in range(gap):
        hashed = (hashed ^ (raw[k:k + n] + np.uint32(1)) * _STEPS[k]) * _MIX
        hashed ^= hashed >> np.uint32(15)
        if k + 1 in ORDERS:
            out[:, ORDERS.index(k + 1)] = (hashed * _MIX) >> np.uint32(32 - 15)
    return out, starts, starts + lengths


_LETTER = np.zeros(256, bool)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyz '", *range(128, 256)]] = True


def letter_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the four bytes from each byte of the lower-cased texts on, whether they are letters and single
    spaces only, and where each text begins and ends."""
    lower = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_binary())
    lengths = pc.binary_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"    ".join([*lower.to_pylist(), b"    "]), np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths + 4)])[:-1].astype(np.int64)
    n = len(raw) - 4
    hashed, letters = np.zeros(n, np.uint32), (raw[:n] != 32) | (raw[1:n + 1] != 32)
    for k in range(4):
        hashed = (hashed ^ (raw[k:k + n].astype(np.uint32) + np.uint32(1)) * _STEPS[k]) * _MIX
        hashed ^= hashed >> np.uint32(15)
        letters &= _LETTER[raw[k:k + n]]
    return (hashed * _MIX) >> np.uint32(32 - SEEN_BITS), letters, starts, starts + lengths


@dataclass
class Model:
    labels: list[str]
    scores: np.ndarray  # bucket x label: embedding times weights
    bias: np.ndarray
    temperature: float
    threshold: float
    seen: np.ndarray | None = None  # by hash: whether the n-gram was learned from
    strangest: float = 1.0

    def strange(self, texts: pa.Array) -> np.ndarray:
        """Share of a text's n-grams of letters that were never learned from."""
        if self.seen is None or not len(texts):
            return np.zeros(len(texts))
        hashed, letters, starts, ends = letter_grams(texts)
        spans = np.column_stack([starts, ends]).ravel()
        count = lambda x: np.where(
            ends > starts, np.add.reduceat(np.append(x, False).astype(np.int64), spans)[::2], 0)
        return count(letters & ~self.seen[hashed]) / (count(letters) + GIVEN)

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Mean over a text's subwords of embedding times weights, plus bias."""
        if not len(texts) or not self.labels:
            return np.zeros((len(texts), len(self.labels)))
        buckets, starts, ends = subword_buckets(texts)
        total = np.zeros((len(texts), len(self.labels)))
        spans = np.column_stack([starts, ends]).ravel()  # every second sum is that of a gap
        for k in range(len(ORDERS)):
            total += np.add.reduceat(self.scores[buckets[:, k]], spans, axis=0)[::2]
        lengths = (ends - starts)[:, None]
        return np.where(lengths > 0, total / (np.maximum(lengths, 1) * len(ORDERS)), 0) + self.bias

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Best label and calibrated probability."""
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.logits(texts) / self.temperature)
        return [self.labels[i] for i in p.argmax(1)], p.max(1, initial=0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Stochastic gradient descent; every fifth text calibrates and isn't learned from.

    The temperature (1 at least) minimises the log loss of the calibration texts. REJECTED_SHARE of those
    predicted rightly fall below the threshold, and as many have a greater share of n-grams that were never
    learned from than the bound for it; both give way by ASSUMED texts. Without rows there are no labels and
    every text is rejected.
    """
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    if not names:
        return Model([], embedding @ weights, bias, 1.0, 1.0)
    target = np.array([names.index(x) for x in labels])
    calibrates = np.arange(len(texts)) % 5 == 4
    bags = []
    for t in texts:
        buckets, _, end = subword_buckets(pa.array([t], pa.string()))
        ids, counts = np.unique(buckets[:end[0]], return_counts=True)
        bags.append((ids.astype(np.int32), (counts / counts.sum()).astype(np.float32)))
    learned = np.flatnonzero(~calibrates)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for i in rng.permutation(learned):
            ids, share = bags[i]
            mean = share @ embedding[ids]
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            back = weights @ p
            weights -= rate * 10 * np.outer(mean, p)
            bias -= rate * 0.01 * p
            embedding[ids] -= (rate * 10) * share[:, None] * back
    model = Model(names, (embedding @ weights).astype(np.float32), bias, 1.0, 0.0)
    checked = np.flatnonzero(calibrates) if calibrates.any() else learned
    z = model.logits(pa.array([texts[i] for i in checked], pa.string()))
    own = target[checked]
    losses = {t: -np.log(softmax(z / t)[np.arange(len(own)), own] + 1e-12).mean()
              for t in np.geomspace(1, 20, 40)}
    model.temperature = float(min(losses, key=losses.get))
    p = softmax(z / model.temperature)
    model.seen = np.zeros(1 << SEEN_BITS, bool)
    for i in learned:
        hashed, letters, _, _ = letter_grams(pa.array([texts[i]], pa.string()))
        model.seen[hashed[letters]] = True
    right = np.flatnonzero(p.argmax(1) == own)
    if calibrates.any() and len(right):
        strange = np.array([model.strange(pa.array([texts[checked[i]]], pa.string()))[0] for i in right])
        sure = len(right) / (len(right) + ASSUMED)
        model.threshold = float(np.quantile(p.max(1)[right], REJECTED_SHARE)) * sure
        model.strangest = float(np.quantile(strange, 1 - REJECTED_SHARE)) * sure + 1 - sure
    return model


def sample(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most ``per_language`` (text, lang) of each language, with the smallest hashes of doc_id.

    Rows are counted by language first. A row goes on only if its hash is below a bound of about
    twice as many rows, so the last choice sees a bounded number of texts however large the table
    and however common a language.
    """
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    bound: Column = F.lit(1.0)
    for lang, n in sorted(counts.items()):
        bound = F.when(F.col("lang") == lang, min(1.0, (2 * per_language + 100) / n)).otherwise(bound)
    drawn = rows.withColumn("draw", unit_draw("language-sample", "doc_id")).filter(F.col("draw") <= bound)
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    chosen = drawn.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    return [(r["text"], r["lang"]) for r in chosen.orderBy("draw", "doc_id", "text").collect()]


def held_out() -> Column:
    """crc32(doc_id as text) mod 4 is 2; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from text and lang of rows that aren't held out, have doc_id, lang and a letter."""
    known = only(docs, "doc_id", "text", "lang").filter(
        F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull()
        & F.col("text").rlike(r"\p{L}"))
    rows = sample(known, per_language)
    model = train([r[0] for r in rows], [r[1] for r in rows])
    del rows
    release_memory()  # the driver's Python goes on for as long as the application
    return model


def identified(docs: DataFrame, text: str, model: Model) -> Column:
    """Struct (lang_pred, score, rejected) of a text column. The model, at most BUCKETS x labels numbers
    and a table of 2^SEEN_BITS bytes, goes to every task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)

    @F.arrow_udf(T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())]))
    def predict(texts: pa.Array, letters: pa.Array) -> pa.Array:
        learned, names, scores, strange = shared.value, [], [], []
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        for piece in slices(iter([batch]), 1 << 20):
            found, score = learned.predict(piece.column("text"))
            names += found
            scores.append(score)
            strange.append(learned.strange(piece.column("text")))
        some = letters.to_numpy(zero_copy_only=False).astype(bool)
        score = np.where(some, np.clip(np.concatenate([np.zeros(0), *scores]), 0, 1), 0.0)
        return pa.StructArray.from_arrays([
            pa.array([x if ok else UNKNOWN for x, ok in zip(names, some)], pa.string()),
            pa.array(score, pa.float64()), pa.array(
                ~some | (score < learned.threshold)
                | (np.concatenate([np.zeros(0), *strange]) > learned.strangest), pa.bool_()),
        ], ["lang_pred", "score", "rejected"])

    column = F.col(text)
    return predict(column, F.coalesce(column.rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and rejected of every whole text.

    A text that is null or has no letter is ``und`` with score 0 and rejected. A text whose
    calibrated score is below the model's threshold, or with too many n-grams that the model never
    learned from, keeps its language but is rejected. Only the
    text goes into a prediction. Rows stay as they are; repeated and empty input is no special
    case.
    """
    model = model or fit(docs)
    rows = only(docs, "doc_id", "text")
    return rows.select("doc_id", held_out().alias("held_out"),
                       identified(rows, "text", model).alias("found")).select(
        "doc_id", "held_out", "found.*")


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with the columns they have."""
    model = model or fit(docs)
    places = [f"_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*places)
    text = places[docs.columns.index("text")]
    found = rows.withColumn("found", identified(rows, text, model))
    return found.filter(~F.col("found.rejected")).select(*places).toDF(*docs.columns)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))

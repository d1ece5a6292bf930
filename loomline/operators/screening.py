"""Screens of documents: passages of evaluation sets, and unsafe terms."""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.grams import BloomFilter, Terms
from loomline.functions.tokenizers import words
from loomline.session import write_once

#: N-grams of the evaluation set that every task gets at once; more are looked up in blocks.
BLOCK_GRAMS = 200_000
#: Bytes of text whose terms are hashed in one step; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def _steps(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about STEP_BYTES of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    part = np.cumsum(lengths.astype(np.int64)) // STEP_BYTES
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if a < b:
            yield batch.slice(a, b - a)


def eval_grams(items: DataFrame, n: int, shortest: int, item_col: str, text_col: str) -> DataFrame:
    """_item, size, hash and gram of every n-gram of terms; an item with fewer terms is one gram."""
    rows = items.select(F.col(item_col).alias("_item"), F.col(text_col).alias("_text"))
    kind = rows.schema["_item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Terms.of(batch.column("_text"))
            hashes = found.hashes()
            lengths = np.diff(found.by_text)
            out: list[tuple] = []
            for size in np.unique(np.minimum(lengths[lengths >= shortest], n)).tolist():
                grams, _ = found.grams(hashes, size)
                for i in np.flatnonzero(np.minimum(lengths, n) == size).tolist():
                    for at in range(found.by_text[i], found.by_text[i + 1] - size + 1):
                        out.append((i, size, grams[at].astype(np.int64).item(), found.gram(at, size)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_item").take(pa.array([x[0] for x in out], pa.int64())),
                 *[pa.array([x[k] for x in out], t) for k, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.binary()))]],
                ["_item", "size", "hash", "gram"])

    return rows.mapInArrow(run, f"_item {kind}, size int, hash bigint, gram binary")


class _Block:
    """N-grams of a block: a Bloom filter for each size, and the grams themselves by hash."""

    def __init__(self, rows: Sequence):
        self.by_hash: dict[int, list[tuple[bytes, object]]] = defaultdict(list)
        sizes = defaultdict(list)
        for r in rows:
            self.by_hash[r.hash].append((bytes(r.gram), r._item))
            sizes[r.size].append(r.hash)
        self.filters = {size: BloomFilter(np.array(h, np.int64).astype(np.uint64)) for size, h in sizes.items()}

    def hits(self, found: Terms) -> list[list[tuple[int, int, object]]]:
        """Per text the n-grams it has: number of the first term, number of terms, item."""
        out: list[list] = [[] for _ in found.by_text[:-1]]
        hashes = found.hashes()
        for size, bloom in self.filters.items():
            grams, inside = found.grams(hashes, size)
            for at in bloom.candidates(grams):
                known = self.by_hash.get(grams[at].astype(np.int64).item())
                if known is None or not inside[at]:
                    continue
                text = int(np.searchsorted(found.by_text, at, "right")) - 1
                gram = found.gram(int(at), size)
                out[text] += [(int(at - found.by_text[text]), size, item) for g, item in known if g == gram]
        return out


def _spans(hits: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping and adjacent (start, size) joined to [start, end)."""
    out: list[list[int]] = []
    for start, size in sorted(hits):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + size)
        else:
            out.append([start, start + size])
    return out


def decontaminate_eval(docs: DataFrame, items: DataFrame, n: int = 13, shortest: int = 8, id_col="doc_id",
                       text_col="text", item_col="item_id", item_text_col="text") -> DataFrame:
    """Per document what it shares with an evaluation set.

    Columns: the id, n_words (terms), n_items (items it shares an n-gram with), n_covered (terms
    inside shared n-grams), spans (start:end term numbers of the passages, comma-joined) and
    contaminated. Terms are runs of ASCII letters (in lower case), digits and characters beyond
    ASCII, so punctuation does not hide a passage. An item of fewer than ``n`` terms counts as one
    n-gram, one of fewer than ``shortest`` is not looked for.

    The evaluation set's n-grams stand in Bloom filters; what passes is compared as text, so the
    result is exact. The documents are read once for each BLOCK_GRAMS of them and not shuffled
    where that is one block. One row per document, repeated ones too; a null text has no terms.
    """
    grams = write_once(eval_grams(items, n, shortest, item_col, item_text_col), "eval-grams")
    blocks = max(1, -(-grams.count() // BLOCK_GRAMS))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
                       F.col(text_col).alias("_text"))
    id_kind = rows.schema["_id"].dataType.simpleString()
    item_kind = grams.schema["_item"].dataType.simpleString()
    hits_type = f"array<struct<start: int, size: int, item: {item_kind}>>"
    context = docs.sparkSession.sparkContext
    parts = []
    for block in range(blocks):
        own = grams if blocks == 1 else grams.where(F.pmod("hash", F.lit(blocks)) == block)
        shared = context.broadcast(_Block(own.distinct().collect()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in _steps(batch, "_text"):
                    found = Terms.of(piece.column("_text"))
                    hits = [[{"start": a, "size": s, "item": i} for a, s, i in h] for h in shared.value.hits(found)]
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("item", of_item)]))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("_row"), piece.column("_id"),
                         pa.array(np.diff(found.by_text).astype(np.int64)), pa.array(hits, kind)],
                        ["_row", "_id", "n_words", "hits"])

        of_item = pa.int64() if item_kind in ("bigint", "int") else pa.string()
        parts.append(rows.mapInArrow(run, f"_row bigint, _id {id_kind}, n_words bigint, hits {hits_type}"))
    found = parts[0]
    if blocks > 1:
        for part in parts[1:]:
            found = found.union(part)
        found = found.groupBy("_row", "_id", "n_words").agg(F.flatten(F.collect_list("hits")).alias("hits"))

    @F.udf("array<struct<start: int, end: int>>")
    def joined(hits):
        return _spans([(h["start"], h["size"]) for h in hits])

    # Only rows with hits come to the function.
    spans = F.when(F.size("hits") > 0, joined("hits")).otherwise(F.array().cast("array<struct<start: int, end: int>>"))
    return found.withColumn("_spans", spans).select(
        F.col("_id").alias(id_col), "n_words",
        F.size(F.array_distinct(F.transform("hits", lambda h: h["item"]))).cast("bigint").alias("n_items"),
        F.aggregate("_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]).alias("n_covered"),
        F.array_join(F.transform("_spans", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
        (F.size("hits") > 0).alias("contaminated"))


def unsafe_terms(docs: DataFrame, labels: DataFrame, least_share: float = 0.05, most_safe: float = 0.02,
                 least_documents: int = 5, id_col="doc_id", text_col="text", label_col="toxic") -> DataFrame:
    """Words that mark labelled documents as unsafe: term, n_unsafe and n_safe (documents with it).

    A term stands in at least ``least_share`` of the unsafe documents and in ``least_documents`` of
    them; of all labelled documents with it at most ``most_safe`` are safe. At most some hundred, as
    the share is large.
    """
    labelled = docs.select(id_col, text_col).join(labels.select(id_col, label_col), id_col)
    unsafe = F.col(label_col) == 1
    seen = labelled.select(label_col, F.explode(F.array_distinct(words(text_col))).alias("term")).groupBy("term").agg(
        F.count_if(unsafe).alias("n_unsafe"), F.count_if(~unsafe).alias("n_safe"))
    total = labelled.agg(F.count_if(unsafe)).first()[0]
    return seen.where(
        (F.col("n_unsafe") >= least_documents) & (F.col("n_unsafe") >= F.lit(float(least_share)) * total)
        & (F.col("n_safe") <= F.lit(float(most_safe)) * (F.col("n_unsafe") + F.col("n_safe"))))


@lru_cache(maxsize=4)
def _automaton(terms: tuple[str, ...], allowed: tuple[str, ...]):
    """Aho-Corasick automaton of all patterns, built once per worker."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for pattern in {*terms, *allowed}:
        automaton.add_word(pattern, (len(pattern), pattern in terms, pattern in allowed, pattern))
    automaton.make_automaton()
    return automaton


def _lower(text: str) -> str:
    """Lower case that keeps the number of characters."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _in_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


def unsafe_spans(text: str, terms: tuple[str, ...], allowed: tuple[str, ...] = ()) -> list[tuple[int, int, str]]:
    """(start, end, term) of terms that stand as whole words outside allowed phrases, in one pass."""
    low = _lower(text)
    found, excused = [], []
    for last, (length, is_term, is_allowed, pattern) in _automaton(terms, allowed).iter(low):
        start, end = last + 1 - length, last + 1
        if start and _in_word(low[start - 1]) or end < len(low) and _in_word(low[end]):
            continue
        if is_term:
            found.append((start, end, pattern))
        if is_allowed:
            excused.append((start, end))
    if excused and found:
        excused.sort()
        reach = np.maximum.accumulate([e for _, e in excused])  # the furthest end of phrases up to each start
        first = [s for s, _ in excused]
        found = [(s, e, t) for s, e, t in found
                 if not (k := int(np.searchsorted(first, s, "right"))) or reach[k - 1] < e]
    return sorted(found)


def safety_gate(docs: DataFrame, terms: Sequence[str], allowed: Sequence[str] = (), reject_at: int = 2,
                id_col="doc_id", text_col="text") -> DataFrame:
    """Add hits (start, end, term), n_hits, n_terms and verdict: pass, review or reject.

    One pass of an Aho-Corasick automaton over each whole text finds all terms, in any case, as whole
    words. A hit inside a phrase of ``allowed`` does not count. A document with ``reject_at``
    different terms is rejected, one with fewer is for review. The automaton's size is that of the
    lists given. A null text passes.
    """
    patterns = tuple(sorted({_lower(t) for t in terms if t})), tuple(sorted({_lower(t) for t in allowed if t}))

    @F.arrow_udf("array<struct<start: int, end: int, term: string>>")
    def find(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string())]))
        return pa.array([[{"start": s, "end": e, "term": t} for s, e, t in unsafe_spans(x, *patterns)]
                         if x and patterns[0] else [] for x in texts.to_pylist()], kind)

    n_terms = F.size(F.array_distinct(F.transform("hits", lambda h: h["term"])))
    return docs.withColumn("hits", find(F.col(text_col))).withColumns({
        "n_hits": F.size("hits").cast("bigint"), "n_terms": n_terms.cast("bigint"),
        "verdict": F.when(n_terms >= reject_at, "reject").when(n_terms > 0, "review").otherwise("pass")})

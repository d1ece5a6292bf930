"""Ranked lexical search, reversed: documents stream through an inverted index over the items' terms."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import in_batches, only, parts, slices, table, written
from loomline.llm.words import hashed_words

#: Bytes of item texts whose index is sent to every task at once; more items are searched in blocks.
INDEX_BYTES = 32 << 20
#: Updates of scores, and cells of a score table, that a task holds at once.
UPDATES = 2_000_000
#: Partial rankings of an item are merged in so many groups first.
MERGE_GROUPS = 64
#: Term frequencies count in units of this, weights in thousandths.
SCALE = 1_000_000_000

_TERM = np.full(256, 32, np.uint8)  # bytes of terms stay, all others become spaces
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _TERM[_low:_high] = np.arange(_low, _high)


def hashed_terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As ``hashed_words``, of terms: runs of ASCII letters, digits and characters beyond ASCII."""
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    body = raw.buffers()[2]
    body = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    plain = pa.Array.from_buffers(pa.large_binary(), len(raw), [
        None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_TERM[body])])
    yield from hashed_words(plain)


class Index:
    """Postings (item number, how often) by term of some items, in the order of term hashes."""

    def __init__(self, texts: list[str | None]):
        hashes, items = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for at, found, by_text in hashed_terms(pa.array(texts, pa.large_string())):
            hashes.append(found)
            items.append(np.repeat(np.arange(at, at + len(by_text) - 1), np.diff(by_text)))
        self.n_items = len(texts)
        self.terms, place = np.unique(np.concatenate(hashes), return_inverse=True)
        pairs, self.times = np.unique(
            place.astype(np.int64) * max(1, self.n_items) + np.concatenate(items), return_counts=True)
        self.items = pairs % max(1, self.n_items)
        self.starts = np.searchsorted(pairs, np.arange(len(self.terms) + 1) * max(1, self.n_items))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of terms, -1 for those of no item."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


def term_counts(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, n (terms with repeats), and the terms of the index it has with their counts.

    A row per document with a term of any kind.
    """
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        n_terms = len(known.terms)
        for piece in slices(batches):
            ids = piece.column("doc_id")
            for at, hashes, by_text in hashed_terms(piece.column("text")):
                n = np.diff(by_text)
                term = known.find(hashes)
                doc = np.repeat(np.arange(len(n)), n)[term >= 0]
                pairs, times = np.unique(doc * n_terms + term[term >= 0], return_counts=True)
                have = np.flatnonzero(n)
                ends = np.searchsorted(pairs, np.append(have, len(n)) * n_terms).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32)))
                         for x in (pairs % n_terms, times)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(n)).take(pa.array(have)), pa.array(n[have].astype(np.int64)), *lists],
                    ["doc_id", "n", "terms", "times"])

    return in_batches(rows, run, "doc_id bigint, n bigint, terms array<int>, times array<int>")


def document_frequencies(counts: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents by term: summed per task first, so a row per task and term is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(total[have])], ["term", "df"])

    found = in_batches(counts.select("terms"), run, "term bigint, df bigint")
    out = np.zeros(n_terms, np.int64)
    for row in found.groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term of the index
        out[row.term] = row.df
    return out


class Rankings:
    """The best documents of every item seen so far: a heap of (score, less the id) for each."""

    #: In the place of a missing id: behind all others.
    NO_ID = 1 << 63

    def __init__(self, index: Index, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
        self.index, self.weights, self.k = index, weights, k
        self.n_docs, self.n_terms = n_docs, n_terms
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(index.n_items)]
        self.floor = np.ones(index.n_items, np.int64)  # a lower score can't enter

    def add(self, ids: list[int | None], n: np.ndarray, ends: np.ndarray, terms: np.ndarray,
            times: np.ndarray) -> None:
        """Stream documents through the index, as many at once as UPDATES allows."""
        m = 25 + (75 * n * self.n_docs) // self.n_terms
        lengths = np.diff(ends)
        doc = np.repeat(np.arange(len(n)), lengths)
        worth = self.weights[terms] * ((SCALE * times) // (1000 * times + 8 * m[doc]))
        starts = self.index.starts
        width = starts[terms + 1] - starts[terms]
        before = np.concatenate([[0], np.cumsum(width)])
        updates = before[ends]
        most = max(1, UPDATES // max(1, self.index.n_items))
        a = 0
        while a < len(n):
            b = int(np.searchsorted(updates, updates[a] + UPDATES, "right")) - 1
            b = min(max(b, a + 1), a + most, len(n))
            own = slice(int(ends[a]), int(ends[b]))
            self._block(ids[a:b], doc[own] - a, terms[own], worth[own], width[own])
            a = b

    def _block(self, ids: list, doc: np.ndarray, terms: np.ndarray, worth: np.ndarray, width: np.ndarray) -> None:
        index = self.index
        scores = np.zeros((index.n_items, len(ids)), np.int64)
        at = 0
        while at < len(terms):  # more than once only for a document with very many terms
            upto = at + max(1, int(np.searchsorted(np.cumsum(width[at:]), UPDATES, "right")))
            w = width[at:upto]
            places = np.arange(int(w.sum())) + np.repeat(
                index.starts[terms[at:upto]] - np.cumsum(w) + w, w)
            np.add.at(scores.reshape(-1), index.items[places] * len(ids) + np.repeat(doc[at:upto], w),
                      np.repeat(worth[at:upto], w) * index.times[places])
            at = upto
        items, docs = np.nonzero(scores >= self.floor[:, None])
        for i, d, score in zip(items.tolist(), docs.tolist(), scores[items, docs].tolist()):
            heap, entry = self.heaps[i], (score, -(self.NO_ID if ids[d] is None else ids[d]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        found = [(i, s, None if -d == self.NO_ID else -d) for i, heap in enumerate(self.heaps) for s, d in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in found], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
            ["item", "score", "doc_id"])


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item: in groups first, so that many tasks share an item."""
    def best(df: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    return best(best(found, "item", "part").drop("rank"), "item")


def _search(docs: DataFrame, texts: list[str | None], k: int) -> DataFrame | None:
    """item (place in ``texts``), rank, doc_id and score; None if no item or document has a term."""
    spark = docs.sparkSession
    index = Index(texts)
    if not len(index.terms):
        return None
    counts = written(term_counts(docs, index), "term-counts")
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    weights = np.array([
        math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        for df in document_frequencies(counts, len(index.terms)).tolist()], np.int64)
    shared = spark.sparkContext.broadcast((index, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, worth = shared.value
        best = Rankings(known, worth, n_docs, n_terms, k)
        for batch in batches:
            lists, times = batch.column("terms"), batch.column("times")
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            best.add(batch.column("doc_id").to_pylist(), batch.column("n").to_numpy(),
                     np.concatenate([[0], np.cumsum(lengths)]), lists.flatten().to_numpy(),
                     times.flatten().to_numpy().astype(np.int64))
        yield best.rows()

    found = in_batches(counts, run, "item int, score bigint, doc_id bigint")
    return _merged(found.withColumn("part", F.spark_partition_id() % MERGE_GROUPS), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for every row of ``items``.

    Returns item_id, rank (int, from 1), doc_id and score (both bigint). Terms, weights and scores
    are those of the contract of ``op11_ranked_search``: frequencies saturate against the
    document's length over the mean length, rare terms weigh more, everything in whole numbers.

    The items' postings stand in an index that every task gets: at most about INDEX_BYTES of item
    texts at once, more are searched block by block. Every document's term counts are written once
    a block, then streamed through the index; a task keeps a heap of ``k`` documents for each item
    and the heaps are merged in Spark. Terms are compared by 64-bit hashes. Counts cover all
    documents; nothing about single documents goes to the driver.

    Null and empty texts have no terms: such documents are not counted, such items have no rows.
    Repeated items are ranked each on their own, repeated documents take a rank each; a document
    without doc_id can be found and comes behind equal scores with one. Empty tables give no rows.
    Only doc_id and text of ``docs``, item_id and text of ``items`` are read.
    """
    spark = docs.sparkSession
    wanted = only(items, "item_id", "text")
    kind = wanted.schema["item_id"].dataType
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = parts(size, INDEX_BYTES)
    if blocks > 1:  # a block is a share of the rows by hash, so about as large as the others
        wanted = written(wanted.withColumn("block", F.pmod(F.xxhash64(
            F.monotonically_increasing_id()), F.lit(blocks))), "items")
    out = None
    for block in range(blocks):
        rows = (wanted.filter(F.col("block") == block) if blocks > 1 else wanted).collect()
        found = _search(docs, [r.text for r in rows], k)
        if found is None:
            continue
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)],
                                      f"item int, item_id {kind.simpleString()}")
        ranked = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.union(ranked)
    if out is None:
        out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    return out


OP11_SQL = r"""
WITH terms AS (
  SELECT row AS d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
wanted AS (
  SELECT i, item_id, term, count(*) AS times FROM (
    SELECT row AS i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, item_id, text FROM benchmark)) GROUP BY ALL),
sizes AS (SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY d),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
tf AS (SELECT d, term, count(*) AS tf FROM terms SEMI JOIN wanted USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term, n_docs),
worth AS (
  SELECT d, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS worth
  FROM tf JOIN weights USING (term) JOIN sizes USING (d), corpus),
scores AS (
  SELECT i, item_id, d, sum(worth * times)::BIGINT AS score
  FROM wanted JOIN worth USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN sizes USING (d) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

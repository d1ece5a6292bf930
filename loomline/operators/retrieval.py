"""Nearest vectors by cosine: inverted lists with exact bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.hashing import seeded_hash
from loomline.session import write_once

#: Vectors from which centres are fitted, chosen by the hash of their id.
SAMPLE = 20_000
MOST_LISTS = 4096
#: Vectors that one task compares at once; a larger list is several blocks.
BLOCK = 20_000
#: Lists that every query probes before any bound is known.
FIRST_PROBES = 4
#: Products that a task holds at once.
PRODUCTS = 4_000_000
#: Cosines are compared as rounded to so many digits; bounds leave room for that.
DIGITS = 9
SLACK = 1e-7


def unit_rows(vectors: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be compared, and those as unit rows.

    Not null, not zero, all components finite, and ``width`` of them (those of the longest by default).
    """
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is NaN
    if width is None:
        width = int(lengths.max()) if len(lengths) else 0
    whole = (lengths == width) & (width > 0)
    ends = np.cumsum(lengths)
    at = np.flatnonzero(whole)
    rows = flat[(ends[at] - lengths[at])[:, None] + np.arange(width)] if len(at) else np.zeros((0, width))
    with np.errstate(all="ignore"):
        norms = np.sqrt((rows * rows).sum(axis=1))
    fine = np.isfinite(rows).all(axis=1) & np.isfinite(norms) & (norms > 0)
    return at[fine], rows[fine] / norms[fine, None]


def fit_centres(rows: np.ndarray, n_lists: int, rounds: int = 8, seed: int = 42) -> np.ndarray:
    """Centres of a bounded sample of unit rows by spherical k-means."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(n_lists, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], centres)
    return centres


def _angles(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ centres.T, -1, 1))


@dataclass
class Index:
    """Unit vectors in lists around centres: rows (id, vec, list, block), and of each list its size and radius."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray  # largest angle between a list's centre and a vector of it
    blocks: np.ndarray  # number of blocks of each list


def build_index(vectors: DataFrame, id_col="vec_id", vector_col="embedding", n_lists: int | None = None) -> Index:
    """Put every vector into the list of its nearest centre; radii are those of all vectors.

    Centres come from SAMPLE vectors at most, so they only steer the speed. Vectors that are null,
    zero, not finite or of another length than the sample's longest are left out.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    n = plain.count()
    n_lists = n_lists or max(1, min(MOST_LISTS, math.isqrt(n)))
    share = min(1.0, SAMPLE / max(1, n))
    sample = plain.where(seeded_hash("centres", "id") < int(share * 2**60)).limit(2 * SAMPLE).collect()
    _, rows = unit_rows(pa.array([r.vec for r in sample], pa.list_(pa.float64())))
    if not len(rows):  # nothing to compare in the sample: one list holds all
        rows = np.ones((1, max((len(r.vec) for r in sample if r.vec), default=1)))
    centres = spark.sparkContext.broadcast(fit_centres(rows, n_lists))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine, unit = unit_rows(batch.column("vec"), centres.value.shape[1])
            angles = _angles(unit, centres.value)
            nearest = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(fine)), _lists(unit), pa.array(nearest.astype(np.int32)),
                 pa.array(angles[np.arange(len(unit)), nearest])], ["id", "vec", "list", "angle"])

    dealt = write_once(plain.mapInArrow(run, "id bigint, vec array<double>, list int, angle double"), "vector-lists")
    sizes, radius = np.zeros(len(centres.value), np.int64), np.zeros(len(centres.value))
    for r in dealt.groupBy("list").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect():
        sizes[r.list], radius[r.list] = r.n, r.radius
    blocks = -(-sizes // BLOCK)
    rows = dealt.select("id", "vec", "list", F.pmod(
        F.xxhash64("id", F.monotonically_increasing_id()), _numbers(blocks)).cast("int").alias("block"))
    return Index(rows, centres.value, radius, blocks)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1)))


def _numbers(values: np.ndarray) -> Column:
    """The number of a row's list: MOST_LISTS literals at most."""
    return F.element_at(F.lit(values.tolist()), F.col("list") + 1)


def _compare(index: Index, probes: DataFrame, k: int) -> DataFrame:
    """The k nearest vectors of each query within each block of the lists that it probes.

    Many queries of one list are blocks too, so neither a hot list nor a hot query is one task.
    """
    schema = "query bigint, id bigint, cosine double"
    probes = write_once(probes, "probes")
    asked = np.zeros(len(index.blocks), np.int64)
    for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect():
        asked[r.list] = -(-r.n // BLOCK)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        best: dict[int, list[tuple[float, int]]] = {}
        if left.num_rows and right.num_rows:
            ids, vecs = left.column("id").to_numpy(), _matrix(left.column("vec"))
            queries, wanted = right.column("query").to_pylist(), _matrix(right.column("vec"))
            step = max(1, PRODUCTS // len(vecs))
            for a in range(0, len(wanted), step):
                cosines = np.round(wanted[a:a + step] @ vecs.T, DIGITS)
                for q, row in zip(queries[a:a + step], cosines):
                    best[q] = heapq.nlargest(k, best.get(q, []) + _largest(row, ids, q, k))
        found = [(q, -i, c) for q, rows in best.items() for c, i in rows]
        return pa.table([pa.array([f[j] for f in found], t) for j, t in enumerate(
            (pa.int64(), pa.int64(), pa.float64()))], ["query", "id", "cosine"])

    n_asked, n_blocks = _numbers(asked), _numbers(index.blocks)
    rows = index.rows.where(n_asked > 0).withColumn("asked", F.explode(F.sequence(F.lit(0), n_asked - 1)))
    wanted = probes.withColumn("asked", F.pmod(F.xxhash64("query"), n_asked).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    keys = ["list", "block", "asked"]
    return rows.select("id", "vec", *keys).groupBy(*keys).cogroup(
        wanted.select("query", "vec", *keys).groupBy(*keys)).applyInArrow(run, schema)


def _largest(row: np.ndarray, ids: np.ndarray, query: int, k: int) -> list[tuple[float, int]]:
    """The k best (cosine, less the id) of other vectors; of equal cosines the smallest ids."""
    if len(row) > 4 * k:  # the query itself may be one of the k + 1 best
        cut = np.partition(row, -k - 1)[-k - 1]
        above, ties = np.flatnonzero(row > cut), np.flatnonzero(row == cut)
        if len(ties) > k + 1:
            ties = ties[np.argpartition(ids[ties], k)[:k + 1]]
        near = np.concatenate([above, ties])
    else:
        near = np.arange(len(row))
    return [(c, -i) for c, i in zip(row[near].tolist(), ids[near].tolist()) if i != query]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col="vec_id", vector_col="embedding",
                n_lists: int | None = None) -> DataFrame:
    """The ``k`` nearest other vectors of each query by cosine: query, rank, id, cosine. Exact.

    The vectors stand in lists around centres. A query first probes the lists of the nearest
    centres; its k-th best angle then bounds the others: a list whose centre is further away than
    that angle plus the list's radius can't hold a nearer vector and is left out, all others are
    probed. Large lists are several blocks, compared by tasks of their own; only ``k`` rows a query
    and block are merged. Cosines are rounded to DIGITS, equal ones go by id. Query ids must be
    unique; a query's own id is not among its results. Vectors and queries that are null, zero or
    not finite have no results.
    """
    index = build_index(vectors, id_col, vector_col, n_lists)
    asked = queries.select(F.col(id_col).cast("bigint").alias("query"), F.col(vector_col).cast("array<double>").alias("vec"))
    context = vectors.sparkSession.sparkContext
    lists = context.broadcast((index.centres, index.radius, index.blocks))

    def probing(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        centres, radius, blocks = lists.value
        for batch in batches:
            fine, unit = unit_rows(batch.column("vec"), centres.shape[1])
            angles = _angles(unit, centres)
            wanted = blocks[None, :] > 0
            nearest = np.zeros(angles.shape, bool)
            order = np.argsort(np.where(wanted, angles, np.inf), axis=1, kind="stable")[:, :FIRST_PROBES]
            np.put_along_axis(nearest, order, True, axis=1)
            if first:
                wanted = wanted & nearest
            else:
                limit = np.array(batch.column("limit").to_pylist(), float)[fine]
                wanted = wanted & ~nearest & (angles - radius[None, :] <= limit[:, None] + SLACK)
            row, chosen = np.nonzero(np.broadcast_to(wanted, angles.shape))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query").take(pa.array(fine[row])), _lists(unit[row]),
                 pa.array(chosen.astype(np.int32))], ["query", "vec", "list"])

    schema = "query bigint, vec array<double>, list int"
    best = Window.partitionBy("query").orderBy(F.desc("cosine"), "id")

    def merged(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    near = write_once(merged(_compare(index, asked.mapInArrow(lambda b: probing(b, True), schema), k)), "near-vectors")
    worst = near.where(F.col("rank") == k).select("query", F.acos("cosine").alias("limit"))
    bounded = asked.join(worst, "query", "left").withColumn("limit", F.coalesce("limit", F.lit(10.0)))
    far = _compare(index, bounded.select("query", "vec", "limit").mapInArrow(lambda b: probing(b, False), schema), k)
    return merged(near.drop("rank").union(far)).select("query", "rank", "id", "cosine")

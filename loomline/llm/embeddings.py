"""Near-duplicate embeddings: p-stable hashing in several tables, then exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import only, written
from loomline.llm.graph import components, forest
from loomline.session import materialize

THRESHOLD = 0.95
#: Width of a quantised projection of unit vectors.
WIDTH = 2.0
#: Wanted share of the pairs right at the threshold that meet in a table at least.
RECALL = 0.94
#: Vectors that are compared with each other in one step; larger buckets are compared block by block.
BLOCK = 1500
SEED = 20240501


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at a distance fall into one step of a random projection."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(projections in a table, tables) for n vectors.

    So many projections that a vector meets a quarter of an unrelated (orthogonal) one in a table
    on average, and so many tables that a pair at the threshold is found with chance ``recall``.
    """
    near = collision(math.sqrt(2 - 2 * threshold)) if threshold < 1 else 1.0
    per_table = max(4, round(math.log(4 * max(n, 2)) / -math.log(collision(math.sqrt(2)))))
    return per_table, max(1, math.ceil(math.log(1 - recall) / math.log1p(-near ** per_table)))


def table_keys(unit: np.ndarray, per_table: int, tables: int) -> np.ndarray:
    """One 64-bit key per vector (row) and table from floor((projection + offset) / WIDTH)."""
    rng = np.random.default_rng([SEED, unit.shape[1], per_table])
    keys = np.empty((len(unit), tables), np.int64)
    for t in range(tables):
        directions = rng.standard_normal((unit.shape[1], per_table))
        cells = np.floor((unit @ directions + rng.uniform(0, WIDTH, per_table)) / WIDTH).astype(np.int64)
        key = np.full(len(unit), t + 1, np.uint64)
        for c in cells.T.astype(np.uint64):
            key = (key ^ c) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, t] = key.view(np.int64)
    return keys


def units(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    sizes = np.array([len(v) for v in column])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, column.take(pa.array(rows))


def _buckets(classes: DataFrame, per_table: int, tables: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                for rows, vectors in _by_length(piece.column("embedding")):
                    keys = table_keys(units(vectors), per_table, tables)
                    ids = piece.column("rep").take(pa.array(rows))
                    for t in range(tables):
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array(np.full(len(ids), t, np.int32)), pa.array(keys[:, t])],
                            ["rep", "tab", "bucket"])

    return classes.select("rep", "embedding").mapInArrow(run, "rep bigint, tab int, bucket bigint")


def _compare(cells: DataFrame, per_table: int, tables: int, threshold: float) -> DataFrame:
    """Links per vector and edges to the smallest vector of its cell; rows of a cell come together."""
    def one(cell: pa.Table, keys_of: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = cell["rep"].to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        own, first, last, tab, count = (
            cell[c].to_numpy()[order] for c in ("own", "first", "last", "tab", "n"))
        x = units(cell["embedding"].combine_chunks().take(pa.array(order)))
        near = x @ x.T >= threshold
        if first[0] != last[0]:
            near &= own[:, None] != own[None, :]
        a, b = np.nonzero(np.triu(near, 1))
        links = np.zeros(len(ids), np.int64)
        if len(a):
            keys = table_keys(x, per_table, tables)
            fresh = np.concatenate([  # a pair counts in the first table where it meets
                (keys[a[i:i + 50_000]] == keys[b[i:i + 50_000]]).argmax(1) == tab[0]
                for i in range(0, len(a), 50_000)])
            np.add.at(links, a[fresh], count[b[fresh]])
            np.add.at(links, b[fresh], count[a[fresh]])
        return ids, ids[forest(a, b, len(ids))], links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell = pa.Table.from_batches(pieces)
            if cell.num_rows > 1:
                ids, roots, links = one(cell, {})
                some = (links > 0) | (roots != ids)
                if some.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[some]), pa.array(roots[some]), pa.array(links[some])],
                        ["rep", "root", "links"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy()
            starts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1), batch.num_rows]
            for at, upto in zip(starts, starts[1:]):
                if held and held[0].column("cell")[0].as_py() != cell[at]:
                    yield from finish(held)
                    held = []
                held.append(batch.slice(at, upto - at))
        if held:
            yield from finish(held)

    return cells.mapInArrow(run, "rep bigint, root bigint, links bigint")


def usable(vector) -> F.Column:
    """Not null, without null or non-finite components, and not zero."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, odd)
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between vectors (vec_id, embedding) with cosine >= threshold, in double precision.

    Returns one row per row: vec_id, n_links (other vectors linked directly), component_id (the
    smallest vec_id reachable by links, itself included) and kept (vec_id = component_id). A vector
    is a distinct pair of vec_id and embedding, so repeated rows count once. Vectors that are null,
    zero or hold null or non-finite components, and rows without vec_id, link with nothing;
    without vec_id component_id is null and kept false. Vectors of different lengths don't link.

    Equal vectors are one class and are compared once. Class ids alone are dealt out by the
    tables' keys; only classes in a bucket of two or more get their vector. A bucket of more than
    BLOCK classes is compared block by block in separate tasks, so a hot one is split, whole. All
    pairs found are verified; a pair that meets in no table is missed (see RECALL).
    """
    rows = only(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("bigint"), "embedding")
    good = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).distinct()
    classes = written(good.groupBy("embedding").agg(
        F.min("vec_id").alias("rep_id"), F.count(F.lit(1)).alias("n")).withColumn(
        "rep", F.monotonically_increasing_id()), "embeddings")
    per_table, tables = tables_for(classes.count(), threshold)
    keys = materialize(_buckets(classes, per_table, tables))
    sizes = keys.groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    cells = (keys.join(sizes, ["tab", "bucket"])
             .withColumn("blocks", F.ceil(F.col("size") / BLOCK))
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("rep", "tab", "own", F.least("own", "other").alias("first"),
                     F.greatest("own", "other").alias("last"),
                     F.xxhash64("tab", "bucket", F.least("own", "other"),
                                F.greatest("own", "other")).alias("cell")))
    dealt = cells.join(classes.select("rep", "embedding", "n"), "rep") \
        .repartition("cell").sortWithinPartitions("cell")
    found = materialize(_compare(dealt, per_table, tables, threshold))
    names = classes.select("rep", "rep_id")
    edges = found.filter("rep != root").select("rep", "root").distinct().join(names, "rep").select(
        "root", F.col("rep_id").alias("a")).join(
        names.select(F.col("rep").alias("root"), F.col("rep_id").alias("b")), "root").select("a", "b")
    roots = components(edges)
    counted = names.join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
    labelled = counted.join(roots, counted["rep_id"] == roots["node"], "left").select(
        "rep", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep_id").alias("root"))
    class_of = classes.join(labelled, "rep").select("embedding", "n", "links", "root")
    usable_key = F.when(F.col("vec_id").isNotNull() & usable(F.col("embedding")), F.col("embedding"))
    joined = rows.withColumn("key", usable_key).join(
        class_of.withColumnRenamed("embedding", "key"), "key", "left")
    return joined.select(
        "vec_id", F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: Every pair of usable vectors is compared. Ids are taken to be unique, as in the given tables.
OP9_SQL = f"""
WITH RECURSIVE rows AS (
    SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (
    SELECT vec_id, v FROM rows WHERE vec_id IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reach AS (
    SELECT vec_id AS node, vec_id AS other FROM good
    UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
roots AS (SELECT node, MIN(other) AS root FROM reach GROUP BY node),
degrees AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, COALESCE(d.n, 0) AS n_links, COALESCE(c.root, r.vec_id) AS component_id,
    COALESCE(r.vec_id = COALESCE(c.root, r.vec_id), FALSE) AS kept
FROM rows r LEFT JOIN degrees d ON r.vec_id = d.a LEFT JOIN roots c ON r.vec_id = c.node
"""


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

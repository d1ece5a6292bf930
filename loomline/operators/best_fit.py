"""Best-fit packing of documents into rows of a fixed number of tokens."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.hashing import DEFAULT_SEED, seeded_hash
from loomline.session import write_once

#: Documents of a cell, which one task packs.
CELL_DOCUMENTS = 20_000
#: Rows that are less full than this are opened again in the second round.
FULL_SHARE = 0.95


def best_fit(lengths: Sequence[int], capacity: int) -> list[int]:
    """The row of each piece: longest first, into the open row with the least space that holds it.

    Free spaces stand in an ordered list, so a row is found by binary search. Equal spaces go to the
    row opened first.
    """
    rows = [0] * len(lengths)
    free: list[tuple[int, int]] = []
    opened = 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect.bisect_left(free, (lengths[i], -1))
        if at < len(free):
            space, row = free.pop(at)
        else:
            space, row = capacity, opened
            opened += 1
        rows[i] = row
        if space > lengths[i]:
            bisect.insort(free, (space - lengths[i], row))
    return rows


def _packed(pieces: DataFrame, cell: Column, capacity: int) -> DataFrame:
    """Add row (within the cell) and offset to pieces, each cell packed by one task."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("length", "descending"), ("hash", "ascending"), ("piece_no", "ascending"), ("id", "ascending")])
        lengths = table.column("length").to_numpy()
        rows = np.array(best_fit(lengths.tolist(), capacity), np.int64)
        order = np.argsort(rows, kind="stable")  # offsets: pieces of a row in order
        sums = np.cumsum(lengths[order]) - lengths[order]
        firsts = np.concatenate([[True], np.diff(rows[order]) > 0])
        offsets = np.empty(len(rows), np.int64)
        offsets[order] = sums - np.maximum.accumulate(np.where(firsts, sums, 0))
        return table.append_column("row", pa.array(rows)).append_column("offset", pa.array(offsets))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = pieces.withColumn("cell", cell)
    return dealt.groupBy("cell").applyInArrow(run, f"{schema}, cell bigint, row bigint, offset bigint")


def pack_best_fit(df: DataFrame, length: Column, capacity: int, id_col="doc_id",
                  seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Pack documents into rows of ``capacity`` tokens: id, start, length, row_id, offset, one row per piece.

    A document longer than a row is cut into whole rows and a rest. Pieces go to cells by the hash
    of their id, and a task packs a cell by best fit, longest piece first. Rows that come out less
    than FULL_SHARE full are opened again: their pieces are packed in a second round over cells of
    the leftovers. Only ids and lengths move; the tokens stay where they are. A document without
    tokens has no piece. Documents with one id, also a missing one, are told apart by their place
    in the input, and a hot id is spread over cells by it.
    """
    sized = df.select(F.col(id_col).alias("id"), length.cast("bigint").alias("_n"))
    whole = F.floor((F.col("_n") + capacity - 1) / capacity)
    pieces = sized.where("_n > 0").withColumn("_copy", F.monotonically_increasing_id()).select(
        "id", seeded_hash(f"{seed}:best-fit", F.concat_ws(":", F.col("id").cast("string"), F.col("_copy").cast("string"))).alias("hash"),
        "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)).alias("piece_no")).select(
        "id", "hash", "piece_no", F.least(F.lit(capacity).cast("bigint"), F.col("_n") - F.col("piece_no") * capacity).alias("length"))
    pieces = write_once(pieces, "best-fit-pieces")
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)

    cells = max(1, -(-rest.count() // CELL_DOCUMENTS))
    first = write_once(_packed(rest, F.pmod("hash", F.lit(cells)), capacity), "best-fit-rows")
    fill = first.groupBy("cell", "row").agg(F.sum("length").alias("_fill"))
    judged = first.join(fill, ["cell", "row"])
    enough = F.col("_fill") >= FULL_SHARE * capacity
    done = judged.where(enough)
    opened = write_once(judged.where(~enough).select("id", "hash", "piece_no", "length"), "best-fit-leftovers")
    again = max(1, -(-opened.count() // CELL_DOCUMENTS))
    second = _packed(opened, F.pmod(F.shiftright("hash", 20), F.lit(again)), capacity)

    def out(rows: DataFrame, kind: str, key: Column, offset: Column) -> DataFrame:
        return rows.select(F.col("id").alias(id_col), (F.col("piece_no") * capacity).alias("start"), "length",
                           F.concat_ws("-", F.lit(kind), key).alias("row_id"), offset.alias("offset"))

    row = F.concat_ws("-", "cell", "row")
    return out(full, "whole", F.concat_ws("-", F.hex("hash"), "piece_no"), F.lit(0).cast("bigint")).union(
        out(done, "first", row, F.col("offset"))).union(out(second, "second", row, F.col("offset")))


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: rows, pieces, tokens, the fullest row's tokens, and the share of all places that hold a token."""
    rows = packed.groupBy("row_id").agg(F.sum("length").alias("_fill"), F.count("*").alias("_pieces"))
    return rows.agg(
        F.count("*").alias("n_rows"), F.sum("_pieces").alias("n_pieces"), F.sum("_fill").alias("n_tokens"),
        F.max("_fill").alias("fullest"), (F.sum("_fill") / (F.count("*") * capacity)).alias("fill"))

"""Trie of conversation prefixes: range minima over the common prefixes of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import in_batches, only, parts, table, word_list, written

#: Conversations that continue another one's beginning, and the longest beginning.
FAMILY = 20
LONGEST_HEAD = 3
#: Turns of the conversations that one task sorts and searches.
TASK_TURNS = 50_000
#: Bytes of a turn in the sort key, and conversations whose ids travel as one piece.
DIGEST = 16
ENDS_PIECE = 65_536

NODES = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
         "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
_PARTIAL = ("pid int, key binary, parent_key binary, open boolean, ends binary, piece bigint, " + NODES)


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and turns: (digest, words) of its turns by turn number, the missing one first.

    A digest stands for (role, text), null as empty; turns with one number go by digest.
    """
    rows = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", digest.alias("digest"),
                    F.size(word_list(text)).cast("bigint").alias("words"))
    return rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))
                               ).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first one of its family.

    h = crc32(conv_id) modulo 4 turns of conversation conv_id - conv_id % 20, then its own turns
    after its first h.
    """
    heads = lists.select(F.col("conv_id").alias("first"), F.slice("turns", 1, LONGEST_HEAD).alias("head"))
    own = lists.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1)).cast("int"))
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("first"), "left")
    head = F.when(F.col("first").isNull() | (F.col("h") == 0), F.slice("turns", 1, 0)).otherwise(
        F.slice("head", 1, F.greatest("h", F.lit(1))))
    return joined.select("conv_id", F.concat(head, F.slice(
        "turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def common_prefixes(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each sequence: how many first turns it shares with the one before; 0 for the first one."""
    out = np.zeros(len(lengths), np.int64)
    if len(lengths) < 2:
        return out
    shorter = np.minimum(lengths[1:], lengths[:-1])
    ends = np.cumsum(shorter)
    step = np.arange(int(ends[-1])) - np.repeat(ends - shorter, shorter)
    differs = flat[np.repeat(starts[1:], shorter) + step] != flat[np.repeat(starts[:-1], shorter) + step]
    where = np.where(differs, step, np.repeat(shorter, shorter))
    have = np.flatnonzero(shorter)
    if len(have):
        out[have + 1] = np.minimum.reduceat(where, (ends - shorter)[have])
    return out


class RangeMinimum:
    """Sparse table: the minimum over every range whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over first..last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] + 1 - (1 << int(k))])
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The largest r >= at with every value of at+1..r at least ``least``: binary search."""
        r = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            fits = r + 1 < len(values)
            fits[fits] = values[r[fits] + 1] >= least[fits]
            r[fits] += 1 << k
        return r

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest l <= at with every value of l+1..at at least ``least``: binary search."""
        low = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            begin = low + 1 - (1 << k)
            fits = begin > 0
            fits[fits] = self.levels[k][begin[fits]] >= least[fits]
            low[fits] -= 1 << k
        return low


def _chain(packed: bytes, start: int, depth: int) -> list[bytes]:
    """Keys of the prefixes of 0..depth turns from turn ``start`` on."""
    keys = [hashlib.blake2b(b"", digest_size=DIGEST).digest()]
    for t in range(start, start + depth):
        turn = packed[t * DIGEST:(t + 1) * DIGEST]
        keys.append(hashlib.blake2b(keys[-1] + turn, digest_size=DIGEST).digest())
    return keys


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def search(rows: pa.Table, pid: int, before: int, after: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted conversations of one task.

    ``before`` and ``after``: turns shared with the last conversation before and the first one
    after, -1 where there is none. A node whose members reach over an end of the task is open: its
    counts are of this task only and its key is the digest of its prefix. Every turn number d of
    every conversation is a candidate prefix; the range minima tell its members.
    """
    rows = rows.combine_chunks().sort_by("pos")
    n = rows.num_rows
    conv = rows.column("conv_id").to_numpy()
    words_of = rows.column("words").combine_chunks()
    lengths = np.diff(words_of.offsets.to_numpy()).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    packed = b"".join(rows.column("seq").to_pylist())
    halves = np.frombuffer(packed, np.uint64).reshape(-1, 2) if packed else np.zeros((0, 2), np.uint64)
    lcp = np.minimum(common_prefixes(halves[:, 0], starts, lengths),
                     common_prefixes(halves[:, 1], starts, lengths))
    lcp[0] = before
    following = np.append(lcp[1:], after)
    sums = np.concatenate([[0], np.cumsum(words_of.flatten().to_numpy().astype(np.int64))])

    def words_upto(i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Words in the first d turns of conversation i."""
        return sums[starts[i] + np.maximum(d, 0)] - sums[starts[i]]

    minima, smallest = RangeMinimum(lcp), RangeMinimum(conv)
    # Candidate prefixes: of the first conversation all, of the others those the one before lacks.
    lowest = lcp + 1
    lowest[0] = 0
    new = lengths - lowest + 1
    base = np.cumsum(new) - new
    first = np.repeat(np.arange(n), new)
    depth = np.arange(int(new.sum())) - np.repeat(base - lowest, new)
    left, right = minima.left(first, depth), minima.right(first, depth)
    goes_on = (left == 0) & (depth <= before)
    open_ = goes_on | ((right == n - 1) & (depth <= after))

    # The node of d turns of conversation i: its own, or that of the conversation where it begins.
    def node(i: np.ndarray, d: np.ndarray) -> np.ndarray:
        owner = np.where(d >= lowest[i], i, minima.left(i, d))
        return base[owner] + d - lowest[owner]

    parent = np.full(len(depth), -1)
    below = np.flatnonzero(depth > 0)
    parent[below] = node(first[below], depth[below] - 1)
    born = below[~goes_on[below]]  # a node that goes on from the task before is counted there
    children = np.bincount(parent[born], minlength=len(depth))
    leaf = np.concatenate([[0], np.cumsum(following < lengths)])
    shared = np.concatenate([[0], np.cumsum(words_upto(np.arange(n), lcp))])
    inside = left + ~goes_on  # members that share the prefix with the one before
    saved = shared[right + 1] - shared[inside] - (right + 1 - inside) * words_upto(first, depth - 1)
    least = smallest.over(left, right)

    sha = [_EMPTY] * len(depth)
    ends: dict[int, np.ndarray] = {}
    last_node = node(np.arange(n), lengths)
    runs = np.flatnonzero(np.diff(last_node, prepend=-1))
    for a, b in zip(runs.tolist(), np.append(runs[1:], n).tolist()):
        k = int(last_node[a])
        if open_[k]:
            ends[k] = conv[a:b]
        else:
            sha[k] = _digest(conv[a:b])

    # Open nodes are prefixes of the first conversation (those that go on) or the last one.
    first_keys = _chain(packed, 0, max(0, before))
    last_keys = _chain(packed, int(starts[-1]), max(0, after))
    key: list[bytes | None] = [None] * len(depth)
    for k in np.flatnonzero(open_).tolist():
        key[k] = (first_keys if goes_on[k] else last_keys)[int(depth[k])]
    parent_open = (parent >= 0) & open_[parent]
    above = [key[p] if o else None for p, o in zip(parent.tolist(), parent_open.tolist())]
    known = (parent >= 0) & ~parent_open
    columns = {
        "pid": pa.array(np.full(len(depth), pid, np.int32)), "key": pa.array(key, pa.binary()),
        "parent_key": pa.array(above, pa.binary()), "open": pa.array(open_),
        "ends": pa.nulls(len(depth), pa.binary()), "piece": pa.nulls(len(depth), pa.int64()),
        "conv_id": pa.array(least), "depth": pa.array(depth),
        "parent_conv_id": pa.array(np.where(known, least[parent], 0), mask=~known),
        "n_convs": pa.array(right - left + 1), "n_children": pa.array(children),
        "n_leaves": pa.array(leaf[right + 1] - leaf[left]), "saved_tokens": pa.array(saved),
        "ends_sha256": pa.array(sha),
    }
    found = pa.RecordBatch.from_pydict(columns)
    for at in range(0, found.num_rows, ENDS_PIECE):
        yield found.slice(at, ENDS_PIECE)
    # The ids that end at an open node travel in pieces of bounded size.
    for k, ids in ends.items():
        for piece, at in enumerate(range(0, len(ids), ENDS_PIECE)):
            text = ",".join(map(str, ids[at:at + ENDS_PIECE].tolist())).encode()
            given = {"pid": pid, "key": key[k], "ends": text, "piece": piece, "open": True}
            yield pa.RecordBatch.from_pydict({
                name: pa.array([given.get(name)], column.type) for name, column in columns.items()})


_EMPTY = hashlib.sha256(b"").hexdigest()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 by key of pieces in order: one at a time, so memory is bounded by a batch."""
    now, state = None, None
    for batch in batches:
        out: list[tuple[bytes, str]] = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k == now:
                state.update(b"," + piece)
                continue
            if now is not None:
                out.append((now, state.hexdigest()))
            now, state = k, hashlib.sha256(piece)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.binary(), pa.string()))], ["key", "sha"])
    if now is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.binary()), "sha": [state.hexdigest()]})


def _shared_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of sequences: how many first turns are equal."""
    for batch in batches:
        out = []
        for a, b in zip(batch.column("last").to_pylist(), batch.column("seq").to_pylist()):
            if a is None:
                out.append(-1)
                continue
            n = min(len(a), len(b)) // DIGEST
            x, y = (np.frombuffer(s, np.uint64, 2 * n).reshape(n, 2) for s in (a, b))
            differs = np.flatnonzero((x != y).any(axis=1))
            out.append(int(differs[0]) if len(differs) else n)
        yield pa.RecordBatch.from_arrays([batch.column("pid"), pa.array(out, pa.int64())], ["pid", "lcp"])


def trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with the columns of NODES.

    A node is a distinct sequence of first turns (role, text) of rebuilt conversations (see
    ``rebuilt``), from the root without turns; members are the conversations that begin with it.
    conv_id: smallest member. parent_conv_id: that of the parent, null for the root. n_convs:
    members. n_children: children. n_leaves: childless nodes of its subtree, itself included.
    saved_tokens: (n_convs - 1) times the words of the last text, summed over the subtree.
    ends_sha256: of the ids of members without further turns, ascending, comma-joined.

    Conversations are sorted by the digests of their turns and dealt in ranges, equal ones by id,
    so a third of all conversations may be copies. Neighbours' common prefixes and a sparse table
    of their minima give every candidate prefix its members by binary search to both sides; counts
    are differences of running sums. Nodes over the end of a range are summed by their key: at
    most two conversations' prefixes a range. Only the common prefix of two ranges (a number)
    goes to the driver and back. The turns of one conversation stand in one row (DIGEST + 8 bytes
    a turn).

    Null role or text is empty. A missing turn number comes first; turns with one number, and
    repeated rows, are ordered by the SHA-256 of role length, role and text. Rows without conv_id
    belong to no conversation and are left out. An empty table has no nodes, not even a root.
    Other columns are ignored.
    """
    lists = written(turn_lists(conversations), "turn-lists")
    n_turns = lists.agg(F.sum(F.size("turns"))).first()[0] or 0
    keyed = rebuilt(lists).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.substring(
            t["digest"], 1, 2 * DIGEST)), "")).alias("seq"), F.col("turns.words").alias("words"))
    ordered = keyed.repartitionByRange(parts(n_turns, TASK_TURNS), "seq", "conv_id").sortWithinPartitions(
        "seq", "conv_id").select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("pos"))
    ordered = written(ordered, "sorted-conversations")

    edges = ordered.groupBy("pid").agg(
        F.min_by("seq", "pos").alias("seq"), F.max_by("seq", "pos").alias("end"))
    edges = edges.withColumn("last", F.lag("end").over(Window.orderBy("pid"))).select("pid", "last", "seq")
    joints = sorted(in_batches(edges, _shared_turns, "pid int, lcp bigint").collect())  # a row per range
    before = {r.pid: r.lcp for r in joints}
    after = {a.pid: b.lcp for a, b in zip(joints, joints[1:])}

    def run(rows: pa.Table) -> pa.Table:
        pid = rows.column("pid")[0].as_py()
        return pa.Table.from_batches(search(rows, pid, before[pid], after.get(pid, -1)))

    found = written(ordered.groupBy("pid").applyInArrow(run, _PARTIAL), "trie-nodes")
    nodes, pieces = found.filter("ends is null"), found.filter("ends is not null")
    sums = nodes.filter("open").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    hashed = in_batches(
        pieces.select("key", "pid", "piece", "ends").repartition("key").sortWithinPartitions("key", "pid", "piece")
        .select("key", "ends"), _hash_pieces, "key binary, sha string")
    merged = written(sums.join(hashed, "key", "left"), "trie-open-nodes")

    # An open node's id, for its children: by range, so that the root's children are spread out.
    names = nodes.filter("open").select("pid", "key").join(merged.select("key", "conv_id"), "key").select(
        F.col("pid").alias("at"), F.col("key").alias("above"), F.col("conv_id").alias("of_parent"))
    closed = nodes.filter("not open").join(
        names, (F.col("pid") == F.col("at")) & (F.col("parent_key") == F.col("above")), "left")
    own = merged.select(F.col("key").alias("above"), F.col("conv_id").alias("of_parent"))
    columns = ["conv_id", "depth", F.coalesce("parent_conv_id", "of_parent").alias("parent_conv_id"), "n_convs",
               "n_children", "n_leaves", "saved_tokens"]
    return closed.select(*columns, "ends_sha256").union(
        merged.withColumn("parent_conv_id", F.lit(None).cast("bigint")).join(
            own, F.col("parent_key") == F.col("above"), "left").select(
            *columns, F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256")))


OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) AS pos,
    role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL)),
lists AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY pos) AS turns FROM turns GROUP BY conv_id),
heads AS (  -- crc32 of the decimal id, bit by bit
  SELECT conv_id, turns, (4294967295 - list_reduce(
      list_concat([4294967295::BIGINT], list_transform(
        string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(
        list_concat([xor(a, b)], list_transform(range(8), lambda i: i::BIGINT)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h
  FROM lists),
seqs AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS seq
  FROM heads a LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(seq) AS len, d::BIGINT AS depth, seq[1:d] AS prefix
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len = depth), '') AS ends
  FROM prefixes GROUP BY prefix, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0
      ELSE len(regexp_extract_all(n.prefix[-1].text, '[^\x20\x09-\x0D]+')) END AS saved,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
  FROM (SELECT *, prefix[1:depth - 1] AS above FROM nodes) n
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.above),
subtrees AS (
  SELECT prefix[1:d] AS prefix, d::BIGINT AS depth, sum(saved)::BIGINT AS saved_tokens,
    count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM linked) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN subtrees USING (prefix, depth)
"""


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))

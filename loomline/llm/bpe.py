"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, others by a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.common import bound_batches, in_batches, only, slices
from loomline.llm.unit_memory import STEP, Memory, gather, hashes, unit_starts

#: Pre-tokens, and units of text with their ids, that a worker remembers in each of two
#: generations: a full memory becomes the older one, so it is bounded and only saves time.
PIECES = 300_000
UNITS, UNIT_IDS = 2_000_000, 16_000_000
#: Signs that end many words.
ENDS = tuple(".,;:!?")
# Fixed value: the pattern of which no match crosses a space between other characters than white space.
BY_WORD = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


class PerfectHash:
    """Minimal perfect hash of distinct byte strings by hashing and displacing.

    Two 32-bit halves of a 64-bit hash. A key's bucket gives a displacement d; its slot is
    (low + d * high) mod the number of keys, or for buckets of one key the slot itself.
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.n_buckets = max(1, n // 3)
        self.shift = np.zeros(self.n_buckets, np.int64)
        buckets: dict[int, list[int]] = {}
        hashes = self.hashes(keys)
        bucket, low, high = (x.tolist() for x in self._split(hashes))
        for i, b in enumerate(bucket):
            buckets.setdefault(b, []).append(i)
        self.key_at = np.full(n, -1, np.int64)
        free, singles = bytearray(b"\1") * n, []
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((b, members[0]))
                continue
            d = 0
            while True:
                slots = [(low[i] + d * high[i]) % n for i in members]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for i, s in zip(members, slots):
                free[s], self.key_at[s] = 0, i
        places = (s for s in range(n) if free[s])
        for (b, i), s in zip(singles, places):
            self.shift[b], self.key_at[s] = -1 - s, i

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)

    def _split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
        bucket = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return ((bucket % np.uint64(self.n_buckets)).astype(np.int64),
                low.astype(np.int64), (high | np.uint64(1)).astype(np.int64))

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each string the number of the key that has its slot; the caller compares the two."""
        bucket, low, high = self._split(self.hashes(keys))
        d = self.shift[bucket]
        return self.key_at[np.where(d < 0, -1 - d, (low + d * high) % self.n)]


class Bpe:
    """Encoder and decoder of one ranks file (base64 token and rank a line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.split = regex.compile(pattern).findall
        self.by_word = pattern == BY_WORD
        self.tokens = list(ranks)
        self.ids = list(ranks.values())
        self.whole = PerfectHash(self.tokens)
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.width = 1 << int(max(ranks.values())).bit_length()
        #: Bytes of all tokens by id, and where each ends; ids without a token have none.
        by_id = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            by_id[i] = t
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.token_ends = np.concatenate([[0], np.cumsum([len(t) for t in by_id])])
        self.digits_of = [str(i) for i in range(len(by_id))]
        #: (left id, right id) as one number -> id of both together; also by two bytes
        self.merged = {
            ranks[t[:k]] * self.width + ranks[t[k:]]: i
            for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.first = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.memory, self.older = Memory("i4"), Memory("i4")

    def merge(self, piece: bytes) -> list[int]:
        """Join the leftmost pair of lowest rank, again and again: a heap over a linked list.

        A heap entry is the rank above the place of the left part; it holds as long as ``pair`` at
        that place still has the rank.
        """
        n, find, width, first = len(piece), self.merged.get, self.width, self.first
        ids = list(map(self.byte_ids.__getitem__, piece))
        pair = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if pair[i] != rank:
                continue  # joined with another part meanwhile
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j], pair[j] = rank, -1, -1
            if k < n:
                before[k] = i
                pair[i] = r = find(rank * width + ids[k], -1)
                if r >= 0:
                    push(heap, r << 32 | i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = r = find(ids[h] * width + rank, -1)
                if r >= 0:
                    push(heap, r << 32 | h)
        return [x for x in ids if x >= 0]

    def learn(self, pieces: set[str]) -> None:
        """Encode pre-tokens that the memory lacks: all at once by the hash, the rest by merging."""
        new = [p for p in pieces if p not in self.pieces]
        if len(self.pieces) + len(new) > PIECES:  # all of these must stand in the younger generation
            self.older_pieces, self.pieces, new = self.pieces, {}, list(pieces)
        known = self.older_pieces.keys() & new
        self.pieces.update(zip(known, map(self.older_pieces.__getitem__, known)))
        new = [p for p in new if p not in known]
        raw = [p.encode() for p in new]
        ids, tokens = self.ids, self.tokens
        for p, b, k in zip(new, raw, self.whole.find(raw).tolist() if raw else ()):
            found = [ids[k]] if tokens[k] == b else self.merge(b)
            self.pieces[p] = array("i", found).tobytes()

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of pieces of text as 32-bit numbers; each is split by the pattern alone."""
        split = []
        for unit in units:
            word = unit[1:] if unit[:1] == " " else unit
            if word.isalpha():
                split.append((unit,))
            elif word[-1:] in ENDS and word[:-1].isalpha():  # what the pattern finds, without its cost
                split.append((unit[:-1], unit[-1]))
            else:
                split.append(self.split(unit))
        self.learn({p for s in split for p in s})
        return [b"".join(map(self.pieces.__getitem__, s)) for s in split]

    def _step(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number by unit: those in memory by hash, the others encoded and remembered."""
        keys, checks = hashes(data, starts, ends)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        checked = checks[first]
        if (checked[inverse] != checks).any():  # two units with one hash
            coded = self.encode_units([data[a:b].tobytes().decode() for a, b in zip(starts, ends)])
            return np.frombuffer(b"".join(coded), np.int32), np.array([len(c) // 4 for c in coded])
        at, lengths, known = self.memory.find(unique, checked)
        if len(self.memory.keys) + int((~known).sum()) > UNITS or self.memory.used > UNIT_IDS:
            self.older, self.memory = self.memory, Memory("i4")
            at, lengths, known = self.memory.find(unique, checked)
        new = np.flatnonzero(~known)
        if len(new):
            old_at, old_lengths, old = self.older.find(unique[new], checked[new])
            copied = gather(self.older.buffer, old_at[old], old_lengths[old].astype(np.int64))
            learnt = new[~old]
            coded = self.encode_units([data[a:b].tobytes().decode() for a, b in zip(
                starts[first[learnt]].tolist(), ends[first[learnt]].tolist())])
            new = np.concatenate([new[old], learnt])
            lengths[new] = np.concatenate([old_lengths[old], np.array([len(c) // 4 for c in coded], np.int32)])
            ids = np.concatenate([copied, np.frombuffer(b"".join(coded), np.int32)])
            at[new] = self.memory.add(unique[new], checked[new], ids, lengths[new])
        n = lengths[inverse].astype(np.int64)
        return gather(self.memory.buffer, at[inverse], n), n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and where each text ends (a 0 first).

        Texts are cut into units at spaces that no match of the pattern crosses; with another
        pattern a text is one unit.
        """
        raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        body = raw.buffers()[2]
        data = (np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None
                else np.zeros(0, np.uint8))
        offsets = offsets - offsets[0]
        starts = unit_starts(data, offsets) if self.by_word else offsets[:-1][np.diff(offsets) > 0]
        ends = np.append(starts[1:], len(data))[:len(starts)]
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + STEP, "right")))
            begin = starts[a]
            if ends[a] - begin > STEP:  # one very long unit
                own = np.frombuffer(self.encode_units([data[begin:ends[a]].tobytes().decode()])[0], np.int32)
                found = own, np.array([len(own)])
            else:
                found = self._step(data[begin:ends[b - 1]], starts[a:b] - begin, ends[a:b] - begin)
            ids.append(found[0])
            counts.append(found[1])
            a = b
        sums = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return np.concatenate(ids), sums[np.searchsorted(starts, offsets)]

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        return self.decoded(np.asarray(ids, np.int64))[0].tobytes()

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ids, one behind the other, and where each id's bytes end (a 0 first)."""
        lengths = self.token_ends[ids + 1] - self.token_ends[ids]
        if len(ids) and (ids.min() < 0 or not lengths.all()):
            raise ValueError("ids that the vocabulary lacks")
        return gather(self.token_bytes, self.token_ends[ids], lengths), np.concatenate([[0], np.cumsum(lengths)])


@lru_cache(maxsize=2)
def loaded(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def shared(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """Tables of a vocabulary for all workers, built once on the driver: their size is the vocabulary's."""
    return spark.sparkContext.broadcast(loaded(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text; null and empty texts have no ids.

    Each match of ``pattern`` is encoded separately, without special tokens. Rows stay as they
    are, also repeated ones and those without doc_id. No shuffle; the tables of the vocabulary are
    broadcast. A text is encoded as a whole in one task.
    """
    rows = only(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    tables = shared(rows.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            ids, ends = tables.value.encode(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))],
                ["doc_id", "ids"])

    return in_batches(rows, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add decoded (binary) to rows that have ids; null ids give null, unknown ones an error."""
    bound_batches(encoded.sparkSession)
    tables = shared(encoded.sparkSession, path, pattern)

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        data, ends = tables.value.decoded(column.flatten().to_numpy())
        ends = ends[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int64)
        flat = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return pc.if_else(column.is_valid(), flat, None).cast(pa.binary())

    return encoded.withColumn("decoded", decoded(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the bytes that they decode to.

    As ``encode`` and ``decode`` of its ids, in one step: the ids don't leave the task.
    """
    rows = only(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    tables = shared(rows.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tables.value
        digits = bpe.digits_of.__getitem__
        for piece in slices(batches):
            ids, ends = bpe.encode(piece.column("text"))
            data, at = bpe.decoded(ids)
            of_ids, of_bytes = [], []
            for a, b in zip(ends.tolist(), ends[1:].tolist()):
                of_ids.append(hashlib.sha256(",".join(map(digits, ids[a:b].tolist())).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(data[at[a]:at[b]]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.diff(ends)), pa.array(of_ids, pa.string()),
                 pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_batches(rows, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                   public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)

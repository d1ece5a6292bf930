"""N-gram language model: interpolated modified Kneser-Ney, counted in Spark, in memory-mapped arrays."""

from __future__ import annotations

import contextlib
import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.common import drop_finished_shuffles, in_batches, kept, only, parts, slices, text_bytes, written
from loomline.llm.words import hashed_words, mix, pack, unpack
from loomline.session import workspace
from loomline.sources.files import open_filesystem

#: Text that a task counts together before it deals counts out.
CHUNK_BYTES = 12 << 20
#: Text per share of the words (by hash) and of the word pairs (by first word); powers of two, at most MOST_BITS.
WORD_SHARE_BYTES, PAIR_SHARE_BYTES, MOST_BITS = 64 << 20, 32 << 20, 12
#: Text per split of a share of word pairs, by the word before the pair: where runs of three words are.
SPLIT_BYTES = 16 << 20
#: Followers of two words up to which their sums aren't stored but taken anew.
NARROW = 32
#: Chunks whose word pairs are looked up in one share in one step.
LOOKUP_CHUNKS = 32
#: Runs that are looked up together.
LOOKUP_RUNS = 1 << 19
#: Order of the registered query's model.
QUERY_ORDER = 3
#: The hash that stands for the end of a text; it is also what stands before the first word.
END = np.uint64(0x1234567890ABCDEF)
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


# --- arrays in the shared folder ---------------------------------------------------------------

def store(folder: str, name: str, arrays: dict[str, np.ndarray]) -> list[tuple[str, str, str, int]]:
    """Write arrays to one new file each; (array's name, path, dtype, length) of each."""
    system, plain = open_filesystem(folder)
    system.create_dir(plain, recursive=True)
    out = []
    for key, values in arrays.items():
        path = f"{name}-{key}-{uuid.uuid4().hex}"
        with system.open_output_stream(f"{plain}/{path}") as stream:
            stream.write(np.ascontiguousarray(values).tobytes())
        out.append((key, f"{folder}/{path}", values.dtype.str, len(values)))
    return out


@lru_cache(maxsize=4096)
def mapped(path: str, dtype: str, length: int) -> np.ndarray:
    """A stored array, memory-mapped: pages come as they are touched.

    A file in a store that isn't mounted is copied to an unnamed local file first, which goes with
    the mapping.
    """
    if not length:
        return np.zeros(0, dtype)
    system, plain = open_filesystem(path)
    if isinstance(system, pa.fs.LocalFileSystem):
        return np.memmap(plain, dtype, "r", shape=(length,))
    handle, name = tempfile.mkstemp()
    os.unlink(name)
    with os.fdopen(handle, "r+b") as copy, system.open_input_stream(plain) as source:
        while block := source.read(8 << 20):
            copy.write(block)
        copy.flush()
        return np.frombuffer(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ), dtype)


def fetched(path: str, dtype: str, length: int) -> np.ndarray:
    """A stored array, read into memory: for those that are unpacked at once and not needed again."""
    system, plain = open_filesystem(path)
    with system.open_input_stream(plain) as source:
        return np.frombuffer(source.read(), dtype, length)


_FILE = ("array<struct<key:string,path:string,dtype:string,length:bigint>>", pa.list_(pa.struct([
    ("key", pa.string()), ("path", pa.string()), ("dtype", pa.string()), ("length", pa.int64())])))


def _files(stored: list[tuple[str, str, str, int]]) -> pa.Array:
    return pa.array([[dict(zip(("key", "path", "dtype", "length"), f)) for f in stored]], _FILE[1])


@dataclass
class Shares:
    """Arrays of all shares by number: where they are, not what they hold."""
    files: dict[int, dict[str, tuple[str, str, int]]] = field(default_factory=dict)

    def add(self, share: int, stored) -> None:
        self.files[share] = {f["key"]: (f["path"], f["dtype"], f["length"]) for f in stored}

    def array(self, share: int, key: str, empty: str = "<u4") -> np.ndarray:
        f = self.files.get(share)
        return mapped(*f[key]) if f else np.zeros(0, empty)

    def read(self, share: int, key: str) -> np.ndarray:
        return fetched(*self.files[share][key])


@dataclass
class Model:
    """What goes along with tasks: file names and a few numbers."""
    word_bits: int
    pair_bits: int
    words: Shares
    first_id: list[int]  # of each share of words
    n_words: int  # V
    n_tokens: int  # N
    pairs: Shares
    follows: Shares
    pair_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    n_pairs: int = 0
    unseen_share: float = 1.0  # of the lower order, for all words alike
    order: int = 2
    splits: list[int] = field(default_factory=lambda: [0, 1])  # first split of each share of pairs, and their number
    triples: Shares = field(default_factory=Shares)
    split_tokens: list[int] = field(default_factory=lambda: [0])  # of training, by split
    triple_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Of ascending hashes: the number of each in the vocabulary, -1 without one."""
        out = np.full(len(hashes), -1, np.int64)
        for share, a, b in _split(hashes, self.word_bits):
            have = self.words.array(share, "hashes", "<u8")
            if len(have):
                at = np.minimum(np.searchsorted(have, hashes[a:b]), len(have) - 1)
                hit = have[at] == hashes[a:b]
                out[a:b][hit] = at[hit] + self.first_id[share]
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts by vocabulary number, 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        if self.n_words:
            for s, mine in _places(np.searchsorted(np.asarray(self.first_id), ids, "right") - 1):
                out[mine] = self.words.array(s, "counts", "<i8")[ids[mine] - self.first_id[s]]
        return out

    def share_starts(self) -> np.ndarray:
        """First vocabulary number of each share of word pairs, and the number of words at the end."""
        n = 1 << self.pair_bits
        return np.array([-(-s * self.n_words // n) for s in range(n + 1)], np.int64)

    def by_share(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(share, which of the ids, their places in the share) for those that aren't -1."""
        starts = self.share_starts()
        for s, mine in _places(np.searchsorted(starts, ids, "right") - 1):
            yield s, mine, ids[mine] - starts[s]

    def lower(self, ids: np.ndarray) -> np.ndarray:
        """Lower-order probability: how many different words a word follows, discounted, with a share for all."""
        out = np.full(len(ids), self.unseen_share / (self.n_words + 1))
        for s, mine, at in self.by_share(ids):
            n = self.follows.array(s, "n")
            if len(n):
                n = n[at].astype(np.float64)
                out[mine] += np.maximum(n - discount(n, self.word_discounts), 0) / max(self.n_pairs, 1)
        return out

    def behind(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Behind each word: the sum of its pairs' counts, and the weight of the lower order, 1 where nothing was seen."""
        totals, out = np.ones(len(ids)), np.ones(len(ids))
        for s, mine, at in self.by_share(ids):
            if s in self.pairs.files:
                totals[mine] = np.maximum(self.pairs.array(s, "total")[at], 1)
                kept = sum(d * self.pairs.array(s, f"n{k}")[at] for k, d in enumerate(self.pair_discounts, 1))
                out[mine] = kept / totals[mine]
        return totals, out

    def split_of(self, contexts: np.ndarray) -> np.ndarray:
        """Where a context (a word, and in the low half the one before it) is."""
        share = np.searchsorted(self.share_starts().astype(np.uint64), contexts >> _32, "right") - 1
        first = np.asarray(self.splits, np.int64)
        return first[share] + (mix(contexts & _LOW) % np.diff(first).astype(np.uint64)[share]).astype(np.int64)

    def share_of(self, split: int) -> int:
        return int(np.searchsorted(self.splits, split, "right")) - 1


def _places(shares: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each share that isn't -1 and where it stands, in one sort however many there are."""
    order = np.argsort(shares.astype(np.int16), kind="stable")  # MOST_BITS fit
    shares = shares[order]
    cuts = np.flatnonzero(np.diff(shares, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(shares[a]), order[a:b]


def discount(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.asarray((0.0, *discounts))[np.minimum(counts, 3).astype(np.int64)]


def discounts_of(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many have count 1, 2, 3 and 4.

    Where the counts are too few to say, 1/2, 1 and 3/2; a discount of k stays between k/10 and k.
    """
    if not all(n):
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(float(k), max(k / 10, d)) for k, d in zip((1, 2, 3), found))


def _split(ascending: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(share, from, to) by the top bits of ascending 64-bit numbers."""
    if not len(ascending):
        return
    if bits == 0:
        yield 0, 0, len(ascending)
        return
    cuts = np.append(np.searchsorted(
        ascending, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(ascending))
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        yield s, int(cuts[s]), int(cuts[s + 1])


def _small(counts: np.ndarray) -> bytes:
    """Counts as bytes: the width first."""
    width = 1 if counts.max(initial=0) < 256 else 4 if counts.max() < 1 << 32 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _large(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def _planes(ids: np.ndarray) -> bytes:
    """32-bit numbers, all their lowest bytes first; empty bytes then compress to nothing."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.uint64)


def _squeezed(data: bytes) -> bytes:
    """Compressed for a shuffle, the length first: planes of bytes lose a quarter more than by the shuffle's own codec."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def token_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes of words and ends, offsets by text) of some texts in a row."""
    for at, words, by_text in hashed_words(texts):
        m = len(by_text) - 1
        tokens = np.full(len(words) + m, END)
        tokens[np.arange(len(words)) + np.repeat(np.arange(m), np.diff(by_text))] = words
        yield at, tokens, by_text + np.arange(m + 1)


# --- counting ---------------------------------------------------------------------------------

def _count_words(docs: DataFrame, bits: int, folder: str) -> list:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if found:
                hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                rows = [(s, pack(hashes[a:b]), _small(counts[a:b])) for s, a, b in _split(hashes, bits)]
                s, h, c = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s, pa.int32()), pa.array(h, pa.binary()), pa.array(c, pa.binary())],
                    ["share", "hashes", "counts"])

        held, size = [], 0
        for piece in slices(batches):
            for _, tokens, _ in token_hashes(piece.column("text")):
                held.append(tokens)
            size += piece.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield from emit(held)
                held, size = [], 0
        yield from emit(held)

    def gather(rows: pa.Table) -> pa.Table:
        share = rows["share"][0].as_py()
        hashes, counts = _summed(
            np.concatenate([unpack(x) for x in rows["hashes"].to_pylist()]),
            np.concatenate([_large(x) for x in rows["counts"].to_pylist()]))
        stored = store(folder, f"words-{share}", {"hashes": hashes, "counts": counts})
        return pa.table({"share": pa.array([share], pa.int32()), "n": pa.array([len(hashes)]),
                         "tokens": pa.array([int(counts.sum())]), "files": _files(stored)})

    dealt = in_batches(docs.select("text"), deal, "share int, hashes binary, counts binary")
    return dealt.groupBy("share").applyInArrow(
        gather, f"share int, n bigint, tokens bigint, files {_FILE[0]}").collect()


def _contexts(tokens: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands before each token (its number, in the low half that of the one before: 0 in order two),
    whether the former is known, and the token's number, -1 where it is not known."""
    own, inverse = np.unique(tokens, return_inverse=True)
    ids = model.ids(own)[inverse]
    end = model.ids(np.array([END]))
    before = np.concatenate([end, ids[:-1]])
    contexts = before.astype(np.uint64) << _32
    if model.order == 3:
        second = np.concatenate([end, end, ids])[:len(ids)]
        contexts |= np.where(before == end, end, second).astype(np.uint64) & _LOW
    return contexts, before >= 0, ids


def _by_split(contexts: np.ndarray, ids: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct contexts by split and number, the split of each, context's place and token as one number each)."""
    own, inverse = np.unique(contexts, return_inverse=True)
    split = model.split_of(own)
    order = np.argsort(split, kind="stable")
    place = np.empty(len(order), np.uint64)
    place[order] = np.arange(len(order), dtype=np.uint64)
    return own[order], split[order], (place[inverse] << _32) | (ids.astype(np.uint64) & _LOW)


def _runs(split: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(split, from, to) of each run of equal splits."""
    cuts = np.flatnonzero(np.diff(split, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(split[a]), a, b


def _deal_counts(docs: DataFrame, model: Model) -> DataFrame:
    """Runs of words by split, counted by chunk of text."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if not found:
                return
            contexts, ids = (np.concatenate(x) for x in zip(*found))
            own, split, keys = _by_split(contexts, ids, model)
            keys, counts = np.unique(keys, return_counts=True)
            cuts = np.searchsorted(keys, np.arange(len(own) + 1, dtype=np.uint64) << _32)
            for s, a, b in _runs(split):
                some = slice(cuts[a], cuts[b])
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), *[pa.array([_squeezed(x)], pa.binary()) for x in (
                    pack(own[a:b]), _small(np.diff(cuts[a:b + 1])), _planes(keys[some] & _LOW), _small(counts[some]))]],
                    ["split", "contexts", "n", "words", "counts"])

        held, size = [], 0
        for piece in slices(batches):
            for _, tokens, _ in token_hashes(piece.column("text")):
                contexts, _, ids = _contexts(tokens, model)
                held.append((contexts, ids))
            size += piece.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield from emit(held)
                held, size = [], 0
        yield from emit(held)

    return in_batches(docs.select("text"), deal, _DEALT)


_DEALT = "split int, contexts binary, n binary, words binary, counts binary"


def _gathered(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Summed: distinct contexts, the place of each run's context, its last word, its count."""
    columns = [[_unsqueezed(x) for x in rows[c].to_pylist()] for c in ("contexts", "n", "words", "counts")]
    contexts = np.concatenate([np.repeat(unpack(c), _large(n)) for c, n in zip(columns[0], columns[1])])
    own, inverse = np.unique(contexts, return_inverse=True)
    words = np.concatenate([_unplanes(w) for w in columns[2]])
    keys, counts = _summed((inverse.astype(np.uint64) << _32) | words, np.concatenate([_large(c) for c in columns[3]]))
    return own, (keys >> _32).astype(np.int64), keys & _LOW, counts


def _stored_counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    large = counts > 254  # those are listed beside the small counts
    return {"counts": np.where(large, 255, counts).astype("<u1"), "large_at": np.flatnonzero(large).astype("<i8"),
            "large": counts[large].astype("<i8")}


def _counts_at(shares: Shares, number: int, at: np.ndarray) -> np.ndarray:
    counts = shares.array(number, "counts")[at].astype(np.int64)
    large = counts == 255
    if large.any():
        counts[large] = shares.array(number, "large")[np.searchsorted(shares.array(number, "large_at"), at[large])]
    return counts


def _begin(places: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(places, minlength=n))]).astype("<i8")


def _count_triples(dealt: DataFrame, folder: str) -> DataFrame:
    """Runs of three words, stored compressed by split; and how many words each pair of words stands behind, dealt by split."""
    def gather(rows: pa.Table) -> pa.Table:
        split = rows["split"][0].as_py()
        own, at, words, counts = _gathered(rows)
        begin = _begin(at, len(own))
        wide = np.flatnonzero(np.diff(begin) > NARROW)
        of = lambda x: np.bincount(at, x, len(own))[wide].astype("<i8")
        small = _stored_counts(counts)
        packed = {"contexts": pack(own), "n": _small(np.diff(begin)), "words": _planes(words), "counts": small["counts"].tobytes()}
        stored = store(folder, f"triples-{split}", {
            **small, **{k: np.frombuffer(_squeezed(x), "<u1") for k, x in packed.items()},
            "wide": wide.astype("<i8"), "total": of(counts), "n1": of(counts == 1), "n2": of(counts == 2),
            "n3": of(counts > 2)})
        pairs, n = np.unique((own[at] >> _32 << _32) | words, return_counts=True)
        before, each = np.unique(pairs >> _32, return_counts=True)
        return pa.table({
            "split": pa.array([split], pa.int32()), "files": _files(stored), "tokens": pa.array([int(counts.sum())]),
            "ones": pa.array([[int((counts == k).sum()) for k in (1, 2, 3, 4)]], pa.list_(pa.int64())),
            **{k: pa.array([_squeezed(x)], pa.binary()) for k, x in (
                ("contexts", pack(before << _32)), ("n", _small(each)), ("words", _planes(pairs & _LOW)), ("counts", _small(n)))}})

    return dealt.groupBy("split").applyInArrow(
        gather, f"split int, files {_FILE[0]}, tokens bigint, ones array<bigint>, contexts binary, n binary, words binary, "
        "counts binary")


def _count_pairs(dealt: DataFrame, model: Model, folder: str) -> DataFrame:
    """Word pairs, stored by share; and how many words each word stands behind, dealt by share.

    A pair's count is how often it occurs; below runs of three words, how many words it occurs behind.
    """
    def gather(rows: pa.Table) -> pa.Table:
        share = rows["share"][0].as_py()
        own, at, words, counts = _gathered(rows)
        words = words.astype(np.int64)
        starts = model.share_starts()
        lo, hi = int(starts[share]), int(starts[share + 1])
        before = (own >> _32).astype(np.int64)[at] - lo
        of = lambda x, kind: np.bincount(before, x, hi - lo).astype(kind)
        stored = store(folder, f"pairs-{share}", {
            "begin": _begin(before, hi - lo), "words": words.astype("<u4"), **_stored_counts(counts),
            "total": of(counts, "<i8"), "n1": of(counts == 1, "<u4"), "n2": of(counts == 2, "<u4"), "n3": of(counts > 2, "<u4")})
        last, n = np.unique(words, return_counts=True)
        cuts = np.searchsorted(last, starts)
        out = [{"share": share, "files": _files(stored)[0].as_py(), "n": [int((counts == k).sum()) for k in (1, 2, 3, 4)]}]
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            out.append({"follows": s, "words": pack(last[cuts[s]:cuts[s + 1]].astype(np.uint64)),
                        "counts": _small(n[cuts[s]:cuts[s + 1]])})
        return pa.Table.from_pylist(out, pa.schema([
            ("share", pa.int32()), ("files", _FILE[1]), ("n", pa.list_(pa.int64())),
            ("follows", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())]))

    first = F.array(*[F.lit(s) for s in model.splits[1:]])
    share = F.size(F.filter(first, lambda s: s <= F.col("split")))
    return dealt.select(share.alias("share"), "contexts", "n", "words", "counts").groupBy("share").applyInArrow(
        gather, f"share int, files {_FILE[0]}, n array<bigint>, follows int, words binary, counts binary")


def _split_shares(spark: SparkSession, model: Model) -> list[int]:
    """First split of each share of word pairs, from how much text its words stand in; one row a share."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = model.share_starts()
        for batch in batches:
            ids = batch.column("id").to_pylist()
            n = [int(model.counts(np.arange(starts[s], starts[s + 1])).sum()) for s in ids]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n, pa.int64())], ["share", "n"])

    shares = spark.range(1 << model.pair_bits).mapInArrow(sizes, "share bigint, n bigint")
    counted = {r["share"]: r["n"] for r in shares.collect()}
    splits = [0]
    for s in range(1 << model.pair_bits):
        splits.append(splits[-1] + parts(counted[s] * 6, SPLIT_BYTES))
    return splits


def _count_follows(counted: DataFrame, model: Model, folder: str) -> list:
    def gather(rows: pa.Table) -> pa.Table:
        share = rows["follows"][0].as_py()
        starts = model.share_starts()
        n = np.zeros(int(starts[share + 1] - starts[share]), np.int64)
        for w, c in zip(rows["words"].to_pylist(), rows["counts"].to_pylist()):
            n[unpack(w).astype(np.int64) - starts[share]] += _large(c)
        stored = store(folder, f"follows-{share}", {"n": n.astype("<u4")})
        return pa.table({
            "share": pa.array([share], pa.int32()), "files": _files(stored), "pairs": pa.array([int(n.sum())]),
            "n": pa.array([[int((n == k).sum()) for k in (1, 2, 3, 4)]], pa.list_(pa.int64())),
            "some": pa.array([[int((n == 1).sum()), int((n == 2).sum()), int((n > 2).sum())]], pa.list_(pa.int64()))})

    return counted.filter("follows is not null").select("follows", "words", "counts").groupBy(
        "follows").applyInArrow(
        gather, f"share int, files {_FILE[0]}, pairs bigint, n array<bigint>, some array<bigint>").collect()


def train(docs: DataFrame, size: int | None = None, order: int = 3) -> Model:
    """Count the words of all texts (null: no words, but an end) and their runs up to ``order``, 2 or 3; store the model.

    Runs of three words are dealt by their middle word, a frequent one in splits by the first word: so what is known
    of a context is in one split, and the pairs of a word, counted by the words before them, in one share.

    Every count is summed by chunk before the shuffle; shares of the vocabulary and of the pairs
    are gathered in groups of bounded size and written to the shared folder as sorted arrays. The
    driver gets a row per share: file names, totals, and how many pairs have count 1 to 4.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark: SparkSession = docs.sparkSession
    drop_finished_shuffles(spark)
    folder = workspace(spark, "lm-model")
    size = text_bytes(docs) if size is None else size
    bits = lambda each: min(MOST_BITS, (parts(size, each) - 1).bit_length())
    model = Model(bits(WORD_SHARE_BYTES), bits(PAIR_SHARE_BYTES), Shares(), [], 0, 0, Shares(), Shares())
    by_share = {r["share"]: r for r in _count_words(docs, model.word_bits, folder)}
    for s in range(1 << model.word_bits):
        model.first_id.append(model.n_words)
        if s in by_share:
            model.words.add(s, by_share[s]["files"])
            model.n_words += by_share[s]["n"]
            model.n_tokens += by_share[s]["tokens"]
    if model.n_words >= 1 << 32:
        raise ValueError("more than 2 to the 32 different words")
    model.order = order
    model.splits = _split_shares(spark, model) if order == 3 else list(range((1 << model.pair_bits) + 1))
    model.split_tokens = [0] * model.splits[-1]
    dealt = _deal_counts(docs, model)
    with contextlib.ExitStack() as counting:
        if order == 3:
            ones, dealt = [0] * 4, counting.enter_context(kept(_count_triples(dealt, folder), "lm-triples"))
            for r in dealt.select("split", "files", "tokens", "ones").collect():
                model.triples.add(r["split"], r["files"])
                model.split_tokens[r["split"]] = r["tokens"]
                ones = [a + b for a, b in zip(ones, r["ones"])]
            model.triple_discounts = discounts_of(ones)
        counted = counting.enter_context(kept(_count_pairs(dealt, model, folder), "lm-pairs"))
        ones = [0] * 4
        for r in counted.filter("share is not null").select("share", "files", "n").collect():
            model.pairs.add(r["share"], r["files"])
            ones = [a + b for a, b in zip(ones, r["n"])]
        model.pair_discounts = discounts_of(ones)
        ones, some = [0] * 4, [0] * 3
        for r in _count_follows(counted, model, folder):
            model.follows.add(r["share"], r["files"])
            model.n_pairs += r["pairs"]
            ones = [a + b for a, b in zip(ones, r["n"])]
            some = [a + b for a, b in zip(some, r["some"])]
    model.word_discounts = discounts_of(ones)
    if model.n_pairs:
        model.unseen_share = sum(d * n for d, n in zip(model.word_discounts, some)) / model.n_pairs
    return model


# --- scoring ----------------------------------------------------------------------------------

def _text_keys(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits of each text's word sequence."""
    place = np.arange(len(tokens)) - np.repeat(offsets[:-1], np.diff(offsets))
    spread = mix(tokens + mix(place.astype(np.uint64)))
    return np.add.reduceat(spread, offsets[:-1]).view(np.int64)


def _lower_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: counts, the base score, and the score if no word pair had been seen."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            for at, tokens, offsets in token_hashes(piece.column("text")):
                own, inverse = np.unique(tokens, return_inverse=True)
                ids = model.ids(own)
                counts = model.counts(ids)
                base = np.log10((counts + 1.0) / (model.n_tokens + (model.n_words + 1)))
                lower, back = np.log10(model.lower(ids)), np.log10(model.behind(ids)[1])
                first = float(np.log10(model.behind(model.ids(np.array([END])))[1])[0])
                behind = np.concatenate([[first], back[inverse][:-1]])
                add = lambda x: np.add.reduceat(x, offsets[:-1])
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").slice(at, len(offsets) - 1),
                    pa.array(_text_keys(tokens, offsets)), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(add((counts > 0).astype(np.int64)[inverse])), pa.array(add(base[inverse])),
                    pa.array(add(lower[inverse] + behind)),
                ], ["doc_id", "text_key", "n_tokens", "n_known", "base_score", "lower_score"])

    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, text_key bigint, n_tokens bigint, n_known bigint, base_score double, "
        "lower_score double")


def _lookups(model: Model, n_tokens: int) -> list[int]:
    """Into how many steps the chunks of each split go, and last those of no split (the keys of texts).

    In order three a step unpacks what is stored of its split, which is most often the only step: splits follow the
    text they were made of, and only one with frequent runs, or of a small training table, gets many.
    """
    all_alike = parts(max(n_tokens, model.n_tokens) * 6, CHUNK_BYTES * LOOKUP_CHUNKS)
    if model.order == 2:
        return [all_alike] * (model.splits[-1] + 1)
    here = np.asarray(model.split_tokens) + 1.0
    return [*(parts(n_tokens * 6 * x, 2 * SPLIT_BYTES) for x in here / here.sum()), all_alike]


def _deal_runs(docs: DataFrame, model: Model, n_tokens: int) -> DataFrame:
    """Tokens behind known words by split, with the texts they stand in, packed by chunk of text.

    A text is a number in its chunk; the keys of a chunk's texts go in a row of their own, of split -1.
    """
    steps = _lookups(model, n_tokens)

    def row(split: int, chunk, *packed: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([split], pa.int32()), pa.array([int(chunk) % steps[split]], pa.int32()), pa.array([chunk]),
             *[pa.array([_squeezed(x)], pa.binary()) for x in packed]],
            ["split", "part", "chunk", "texts", "contexts", "n", "words", "who"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[tuple[np.ndarray, ...]], keys_of: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            contexts, ids, who = (np.concatenate(x) for x in zip(*held))
            texts = np.concatenate(keys_of)
            name = _text_keys(texts.view(np.uint64), np.array([0, len(texts)]))[0]
            yield row(-1, name, texts.tobytes(), *[b""] * 4)
            own, split, keys = _by_split(contexts, ids, model)
            order = np.argsort(keys, kind="stable")
            keys, who = keys[order], who[order]
            cuts = np.searchsorted(keys, np.arange(len(own) + 1, dtype=np.uint64) << _32)
            for s, a, b in _runs(split):
                some = slice(cuts[a], cuts[b])
                there, place = np.unique(who[some], return_inverse=True)
                yield row(s, name, pack(there.astype(np.uint64)), pack(own[a:b]), _small(np.diff(cuts[a:b + 1])),
                          _planes(keys[some] & _LOW), place.astype("<u2" if len(there) < 1 << 16 else "<u4").tobytes())

        held, keys_of, size, n = [], [], 0, 0
        for piece in slices(batches):
            for _, tokens, offsets in token_hashes(piece.column("text")):
                contexts, known, ids = _contexts(tokens, model)
                if model.order == 2:
                    known &= ids >= 0  # a context without this word adds nothing there
                who = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32) + n, np.diff(offsets))
                held.append((contexts[known], ids[known], who[known]))
                keys_of.append(_text_keys(tokens, offsets))
                n += len(offsets) - 1
            size += piece.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield from emit(held, keys_of)
                held, keys_of, size, n = [], [], 0, 0
        yield from emit(held, keys_of)

    return in_batches(docs.select("text"), run,
                      "split int, part int, chunk bigint, texts binary, contexts binary, n binary, words binary, who binary")


def _find(begin: np.ndarray, words: np.ndarray, before: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each (before, word) in the share's sorted arrays, -1 without one: binary search, all at once."""
    low, high = begin[before].astype(np.int64), begin[before + 1].astype(np.int64)
    stop = high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        smaller = np.zeros(len(low), bool)
        smaller[open_] = words[middle[open_]] < wanted[open_]
        low = np.where(open_ & smaller, middle + 1, low)
        high = np.where(open_ & ~smaller, middle, high)
    hit = low < stop
    hit[hit] = words[low[hit]] == wanted[hit]
    return np.where(hit, low, -1)


@dataclass
class Runs:
    """Runs of three words of a split, unpacked."""
    contexts: np.ndarray
    totals: np.ndarray  # of each context: the sum of its runs' counts
    weight: np.ndarray  # of the lower order
    keys: np.ndarray  # ascending: place of the context, last word
    counts: np.ndarray


def _unpacked(model: Model, split: int) -> Runs | None:
    """What is stored of a split, None where training had nothing for it."""
    if split not in model.triples.files:
        return None
    read = lambda key: model.triples.read(split, key)
    packed = lambda key: _unsqueezed(read(key).tobytes())
    contexts, n, words = unpack(packed("contexts")), _large(packed("n")), _unplanes(packed("words"))
    counts = np.frombuffer(packed("counts"), "<u1").astype(np.int64)
    counts[read("large_at")] = read("large")
    of = np.repeat(np.arange(len(contexts)), n)
    wide = read("wide")
    narrow = np.ones(len(contexts), bool)
    narrow[wide] = False
    some = narrow[of]
    totals = np.bincount(of[some], counts[some], len(contexts))
    left = np.bincount(of[some], discount(counts[some], model.triple_discounts), len(contexts))
    totals[wide] = read("total")
    left[wide] = sum(d * read(f"n{k}") for k, d in enumerate(model.triple_discounts, 1))
    return Runs(contexts, totals, left / totals, (of.astype(np.uint64) << _32) | words, counts)


def _among(ascending: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the wanted numbers are there, the place of each)."""
    at = np.minimum(np.searchsorted(ascending, wanted), len(ascending) - 1)
    return ascending[at] == wanted, at


def _gain(model: Model, split: int, runs: Runs | None, contexts: np.ndarray, of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """log10 of how much likelier each word is than by the vocabulary's arrays; ``of`` is the place of its context."""
    share = model.share_of(split)
    before = (contexts >> _32).astype(np.int64)
    totals, weight = model.behind(before)
    if share in model.pairs.files:
        at = _find(model.pairs.array(share, "begin"), model.pairs.array(share, "words"),
                   (before - model.share_starts()[share])[of], words)
    else:
        at = np.full(len(words), -1)
    seen = np.flatnonzero(at >= 0)
    ratio = np.ones(len(words))
    below = weight[of[seen]] * model.lower(words[seen])
    if len(seen):
        counts = _counts_at(model.pairs, share, at[seen])
        ratio[seen] += np.maximum(counts - discount(counts, model.pair_discounts), 0) / totals[of[seen]] / below
    if runs is not None:
        known, where = _among(runs.contexts, contexts)
        ratio *= np.where(known, runs.weight[where], 1)[of]
        # a run of three words that was seen has a pair that was seen
        among = np.flatnonzero(known[of[seen]])
        place = where[of[seen[among]]]
        hit, found = _among(runs.keys, (place.astype(np.uint64) << _32) | words[seen[among]].astype(np.uint64))
        among, counts = among[hit], runs.counts[found[hit]]
        above = np.maximum(counts - discount(counts, model.triple_discounts), 0) / runs.totals[place[hit]]
        ratio[seen[among]] += above / below[among]
    return np.log10(ratio)


def _gains(dealt: DataFrame, model: Model) -> DataFrame:
    """(text_key, gain): by how much the runs seen in training raise a text's score, by chunk.

    A split answers with one packed row per chunk, and a chunk's answers are summed by text. So
    neither step has a row per text and split.
    """
    def run(rows: pa.Table) -> pa.Table:
        split = rows["split"][0].as_py()
        none = pa.nulls(rows.num_rows, pa.binary())
        if split < 0:
            return pa.table({"chunk": rows["chunk"], "keys": rows["texts"], "texts": none, "gains": none})
        runs, out = _unpacked(model, split), []

        def look_up(some: list[tuple[np.ndarray, ...]]) -> None:
            """Of some chunks, each with the texts that are there, the text of each token, contexts, their places and words."""
            first = np.cumsum([0, *(len(x[2]) for x in some)])
            contexts, words = (np.concatenate([x[k] for x in some]) for k in (2, 4))
            of = np.concatenate([x[3] + a for x, a in zip(some, first)])
            words[words == int(_LOW)] = -1
            # equal runs of a chunk stand together: each is looked up once
            new = np.append(True, (of[1:] != of[:-1]) | (words[1:] != words[:-1]))
            gain = _gain(model, split, runs, contexts, of[new], words[new])[np.cumsum(new) - 1]
            for there, who, *_ in some:
                sums = np.bincount(who, gain[:len(who)], len(there))
                gain = gain[len(who):]
                out.append((_squeezed(pack(there[sums != 0])), sums[sums != 0].tobytes()))

        chunks, some = rows["chunk"].to_pylist(), []
        for packed in zip(*(rows[c].to_pylist() for c in ("texts", "contexts", "n", "words", "who"))):
            t, c, n, v, w = map(_unsqueezed, packed)
            there, contexts = unpack(t), unpack(c)
            some.append((there, np.frombuffer(w, "<u2" if len(there) < 1 << 16 else "<u4"), contexts,
                         np.repeat(np.arange(len(contexts)), _large(n)), _unplanes(v).astype(np.int64)))
            if sum(len(x[1]) for x in some) >= LOOKUP_RUNS:
                look_up(some)
                some = []
        if some:
            look_up(some)
        texts, gains = zip(*out)
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "keys": none, "texts": pa.array(texts, pa.binary()),
                         "gains": pa.array(gains, pa.binary())})

    def total(rows: pa.Table) -> pa.Table:
        of_chunk = next(x for x in rows["keys"].to_pylist() if x is not None)
        of_chunk = np.frombuffer(_unsqueezed(of_chunk), np.int64)
        sums = np.zeros(len(of_chunk))
        for t, g in zip(rows["texts"].to_pylist(), rows["gains"].to_pylist()):
            if t is not None:
                sums[unpack(_unsqueezed(t)).astype(np.int64)] += np.frombuffer(g, np.float64)
        keys, which = np.unique(of_chunk, return_inverse=True)
        return pa.table({"text_key": keys, "gain": np.bincount(which, sums, len(keys))})

    answers = dealt.groupBy("split", "part").applyInArrow(
        lambda key, rows: run(rows), "chunk bigint, keys binary, texts binary, gains binary")
    return answers.groupBy("chunk").applyInArrow(total, "text_key bigint, gain double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every whole text (null: only an end).

    score is the log10 probability of the text's words and its end. Rows stay as they are, repeated
    ones and those without doc_id too; an empty table gives an empty table, an empty model the
    uniform distribution over one unknown word.

    With p(w|v) = max(c(vw) - d, 0) / c(v) + g(v) q(w) and, in order three, p(w|uv) = max(c(uvw) - e, 0) / c(uv)
    + g(uv) p(w|v), where c(vw) then counts the words before vw, the sum of log10 g(v) q(w) needs the vocabulary's
    arrays only, and contexts and runs seen in training add a gain. They are dealt to the split that has
    them, so that a task unpacks this split's runs and maps its share's arrays, and the gains are summed by text.
    """
    rows = only(docs, "doc_id", "text")
    scored = written(_lower_scores(rows, model), "lm-scores")
    copies = scored.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    n_tokens = scored.agg(F.sum("n_tokens")).first()[0] or 0
    gains = _gains(_deal_runs(rows, model, n_tokens), model).groupBy("text_key").agg(F.sum("gain").alias("gain"))
    each = copies.join(gains, "text_key").select("text_key", (F.col("gain") / F.col("copies")).alias("gain"))
    return scored.join(each, "text_key", "left").select(
        "doc_id", "n_tokens", "n_known", "base_score",
        (F.col("lower_score") + F.coalesce("gain", F.lit(0.0))).alias("score"))


def op7_ngram_lm(spark, sf_dir: str) -> DataFrame:
    docs = only(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model = train(docs.filter(~held_out), order=QUERY_ORDER)
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")

"""Hierarchical packing of documents into context windows of several lengths."""

from __future__ import annotations

import bisect
import json
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import in_batches, only, parts, slices, table

#: Lengths of windows, each a power of two.
TIERS = (256, 512, 1024, 2048)
#: Tokens (with padding) of a training step.
STEP_TOKENS = 1 << 16
#: Bytes of text (and rows) whose pieces one task packs.
CELL_BYTES = 4 << 20
#: Words that a worker remembers, in each of two generations, and the longest of them in bytes.
MEMORY = 400_000
LONGEST_WORD = 64

# Normalisation and splitting under which words between white space are encoded
# one by one.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return letters


class WordEncoder(dict):
    """Ids of UTF-8 words as bytes, encoded on first use; a full memory becomes the older generation."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.code = self.kind[1:].replace("u2", "H").replace("u4", "I")
        self.tokenize = self.tokenizer.model.tokenize
        self.by_word = self._by_word(rules)
        #: First characters of added tokens: words with one are left to the library.
        self.openings = sorted({t["content"][0] for t in rules.get("added_tokens", ())})
        # Characters that no normalisation changes but lower-casing, the same in Unicode and here.
        self.simple = regex.compile("[!-~À-į]+").fullmatch
        self.split = regex.compile(SPLIT).findall
        self.letters = _byte_letters()

    @staticmethod
    def _by_word(rules: dict) -> bool:
        steps = (rules.get("normalizer") or {}).get("normalizers", [])
        cuts = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return ([s["type"] for s in steps] == NORMALIZERS and len(cuts) == 2
                and cuts[0].get("pattern") == {"Regex": SPLIT} and cuts[0].get("invert") is True
                and cuts[0].get("behavior") == "Removed" and cuts[1]["type"] == "ByteLevel"
                and not cuts[1].get("use_regex") and not cuts[1].get("add_prefix_space")
                and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                            or any(c.isspace() for c in t["content"]) for t in rules.get("added_tokens", ())))

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self._ids(word.decode())
        if len(word) <= LONGEST_WORD:
            self[word] = found
        return found

    def _ids(self, word: str) -> bytes:
        plain = word.isascii() and word.isprintable() or self.simple(word)
        if not plain or any(map(word.__contains__, self.openings)):
            return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        word = word.lower()
        if word.isalpha():
            return self._piece(word)
        if word[-1] in ".,;:!?" and word[:-1].isalpha():  # what the pattern finds, without its cost
            return self._piece(word[:-1]) + self._piece(word[-1])
        return b"".join(map(self._piece, self.split(word)))

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            letters = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            found = array(self.code, [t.id for t in self.tokenize(letters)]).tobytes()
            if len(piece) <= LONGEST_WORD:
                self.pieces[piece] = found
        return found

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a whole text, as the tokenizer without special tokens at its ends gives them."""
        if not self.by_word:
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.kind)
        if len(self) > MEMORY:
            self.older = dict(self)
            self.clear()
        if len(self.pieces) > MEMORY:
            self.pieces.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())), self.kind)


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> WordEncoder:
    """Built once per Python worker."""
    return WordEncoder(path)


_PIECES = "cell int, doc_id bigint, start bigint, length bigint, doc_tokens bigint, crc bigint, ids binary"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_windows(docs: DataFrame, path: str, end_id: int, longest: int, cells: int, with_ids: bool) -> DataFrame:
    """Every document as full windows and a shorter rest, with the cell in which each is packed.

    Cells are dealt by turns within a partition, so neither copies nor a source nor one very long
    document fill one. Full windows need no packing; their ids come along only if wanted.
    """
    rows = only(docs, "doc_id", "text")
    schema = pa.schema([("cell", pa.int32()), ("doc_id", pa.int64()), *[
        (n, pa.int64()) for n in ("start", "length", "doc_tokens", "crc")], ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        turn = TaskContext.get().partitionId() * 7919
        for piece in slices(batches):
            out: list[tuple] = []
            texts = piece.column("text").cast(pa.large_binary())
            for doc_id, text in zip(piece.column("doc_id").cast(pa.int64()).to_pylist(), texts):
                raw = text.as_py()
                ids = np.append(encoder.encode(raw) if raw else [], end_id).astype(encoder.kind)
                for start in range(0, len(ids), longest):
                    own = ids[start:start + longest]
                    full = len(own) == longest
                    out.append((turn % cells, doc_id, start, len(own), len(ids), _crc(own),
                                own.tobytes() if with_ids or not full else None))
                    turn += 1
            columns = zip(*out) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return in_batches(rows, run, _PIECES)


def plan(lengths: Sequence[int], tiers: Sequence[int] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, length) that hold every token of the pieces once.

    A piece belongs to the shortest tier that holds it. From the longest tier down, a tier's longest
    piece opens a window; its gap is filled with the longest pieces that fit, of this or shorter
    tiers, and at last with the beginning of the shortest piece that doesn't fit, whose rest goes
    back to its tier. So only the last sequence of all can be shorter than its tier; it is cut into
    powers of two, which need no padding.
    """
    pool = sorted((n, i, 0) for i, n in enumerate(lengths))
    out = []
    for below, tier in zip((0, *tiers[:-1])[::-1], tiers[::-1]):
        while pool and pool[-1][0] > below:
            n, i, start = pool.pop()
            sequence, gap = [(i, start, n)], tier - n
            while gap and pool:
                at = bisect.bisect_right(pool, (gap, len(lengths), 0)) - 1
                if at >= 0:
                    n, i, start = pool.pop(at)
                else:
                    longer, i, start = pool.pop(0)
                    n = gap
                    bisect.insort(pool, (longer - n, i, start + n))
                sequence.append((i, start, n))
                gap -= n
            out.append(sequence)
    if out and sum(n for _, _, n in out[-1]) not in tiers:
        out += powers_of_two(out.pop())
    return out


def powers_of_two(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A sequence cut into ones whose lengths are different powers of two, the longest first."""
    rest = sum(n for _, _, n in sequence)
    out, room = [], 0
    for i, start, n in sequence:
        while n:
            if not room:
                room = 1 << (rest.bit_length() - 1)
                rest -= room
                out.append([])
            part = min(n, room)
            out[-1].append((i, start, part))
            start, n, room = start + part, n - part, room - part
    return out


def step_groups(sizes: np.ndarray, step_tokens: int = STEP_TOKENS) -> np.ndarray:
    """The step of each window: longest windows first, so all steps but the last have equal sizes.

    Sizes are powers of two up to ``step_tokens``, so no window lies across two steps.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(sizes), np.int64)
    out[order] = (np.cumsum(sizes[order]) - sizes[order]) // step_tokens
    return out


def padded(total: int, tiers: Sequence[int] = TIERS) -> int:
    """The length of the window of a sequence: its own if that is a power of two, else the longest."""
    return total if total & (total - 1) == 0 else tiers[-1]


def pack(docs: DataFrame, path: str, end_id: int = 1, tiers: Sequence[int] = TIERS,
         step_tokens: int = STEP_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, packed into windows of the lengths ``tiers``.

    Returns doc_id, start (ids of the document before the piece), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit numbers), doc_tokens, sequence_id, offset (in the sequence,
    gapless), window (its padded length: the total if that is a power of two, else the longest
    tier), step (group of sequences of STEP_TOKENS in all) and, ``with_ids``, ids (array of int).
    A document is its ids by the tokenizers file ``path``, then ``end_id``.

    Full longest windows are cut off in the scan. Rests go to cells of about CELL_BYTES of text; a
    task packs one (see ``plan``) and fills every window. Which cell a piece comes to depends on the scan's partitions, the pieces of a cell are sorted; so a lost
    task gives the same rows again.

    Null and empty texts are ``end_id`` alone. Documents without doc_id and repeated rows are
    packed like others, each row on its own. An empty table has no pieces. Other columns are ignored.
    """
    if any(t & (t - 1) for t in tiers) or sorted(set(tiers)) != list(tiers) or step_tokens % tiers[-1]:
        raise ValueError("tiers must be ascending powers of two, steps whole longest windows")
    rows = only(docs, "doc_id", "text")
    size, n_docs = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    cells = parts((size or 0) + n_docs, CELL_BYTES)
    pieces = cut_windows(rows, path, end_id, tiers[-1], cells, with_ids)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step"]
    kind = "<u2" if worker_encoder(path).kind == "<u2" else "<u4"

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("length", "descending"), *[
            (n, "ascending") for n in ("doc_id", "start", "doc_tokens", "crc")]])
        cell = rows.column("cell")[0].as_py()
        lengths, starts, docs_, tokens, crcs = (
            rows.column(n).to_pylist() for n in ("length", "start", "doc_id", "doc_tokens", "crc"))
        full = int(pc.sum(pc.equal(rows.column("length"), tiers[-1])).as_py())
        packed = rows.column("ids")
        ids = [np.frombuffer(x, kind) if x is not None else None for x in packed.to_pylist()]
        sequences = [[(i, 0, tiers[-1])] for i in range(full)]
        sequences += [[(full + i, a, n) for i, a, n in s] for s in plan(lengths[full:], tiers)]
        windows = np.array([padded(sum(n for _, _, n in s), tiers) for s in sequences])
        steps = step_groups(windows, step_tokens).tolist()
        out, bodies = [], []
        for number, sequence in enumerate(sequences):
            offset = 0
            for i, a, n in sequence:
                crc = crcs[i] if n == lengths[i] else _crc(ids[i][a:a + n])
                out.append((docs_[i], starts[i] + a, n, crc, tokens[i], (cell << 32) + number, offset,
                            int(windows[number]), (cell << 32) + steps[number]))
                offset += n
                if with_ids:
                    bodies.append(ids[i][a:a + n].astype(np.int32))
        table = {n: pa.array(list(c), pa.int64()) for n, c in zip(names, zip(*out))}
        if with_ids:
            ends = np.cumsum([0] + [len(b) for b in bodies]).astype(np.int32)
            table["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bodies)))
        return pa.table(table)

    schema = ", ".join(f"{n} bigint" for n in names) + (", ids array<int>" if with_ids else "")
    return pieces.groupBy("cell").applyInArrow(run, schema)


def op13_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

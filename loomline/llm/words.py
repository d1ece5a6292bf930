"""Words of whole texts as 64-bit hashes, many texts at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed in one step; a longer text is one step of its own.
STEP = 2 << 20
#: Bytes over which running sums go, and powers are kept by a worker for good; a longer range has sums of its own.
BLOCK = 256 << 10
_RNG = np.random.default_rng(97)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)  # a random number per byte value
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2 to the 64
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2 to the 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, out=steps)
        if n <= 2 * BLOCK:
            _powers[base] = have
    return have[:n]


def polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, base: int) -> np.ndarray:
    """Of each range of bytes the polynomial in ``base`` with the table's numbers as coefficients.

    Ranges ascend and don't overlap; ``base`` is odd. A polynomial is a difference of running sums,
    which go over BLOCK bytes at a time: what stands in memory beside the result doesn't grow with ``data``.
    """
    out, unbase = np.empty(len(starts), np.uint64), pow(base, -1, 1 << 64)
    a = 0
    while a < len(starts):
        begin = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
        part, first = data[begin:ends[b - 1]], starts[a:b] - begin
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * _power(base, len(part)), out=sums[1:])
        out[a:b] = (sums[ends[a:b] - begin] - sums[first]) * _power(unbase, len(part) + 1)[first]
        a = b
    return out


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, word hashes of some texts in a row, offsets by text).

    Words are runs of other characters than space and 0x09-0x0D, with A-Z lower-cased. A hash is
    the polynomial in the word's bytes. Null texts have no words.
    """
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if raw.null_count:
        lengths = np.where(raw.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
    at = 0
    while at < len(raw):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP, "right")) - 1)
        upto = min(upto, len(raw))
        own = lengths[at:upto]
        begin = int(offsets[at])
        body = data[begin:int(offsets[upto])]
        space = _SPACE[body]
        for i in np.flatnonzero(own != np.diff(offsets[at:upto + 1])):  # bytes behind a null
            space = space.copy()
            space[offsets[at + i] - begin:offsets[at + i + 1] - begin] = True
        n = len(body)
        edge = np.ones(n + 1, bool)  # does a text begin here, or is there white space before
        edge[1:n] = space[:-1]
        texts_begin = offsets[at:upto] - begin
        edge[texts_begin[texts_begin < n]] = True
        starts = np.flatnonzero(edge[:n] & ~space)
        stops = np.ones(n, bool)
        stops[:-1] = edge[1:n] | space[1:]
        ends = np.flatnonzero(stops & ~space) + 1
        hashes = mix(polynomials(body, starts, ends, _BYTE, _BASE))
        by_text = np.searchsorted(starts, np.append(texts_begin, n))
        yield at, hashes, by_text
        at = upto


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words of each text; of all words if fewer."""
    out: list[np.ndarray] = []
    for _, words, by_text in hashed_words(texts):
        rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for k in range(size):
            rolled = (rolled + words[k:k + len(rolled)]) * np.uint64(_BASE)
            rolled ^= rolled >> np.uint64(29)
        rolled = mix(rolled)
        for a, b in zip(by_text[:-1].tolist(), by_text[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(rolled[a:b - size + 1]))
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for w in words[a:b]:
                    whole = mix(whole * np.uint64(_BASE) + w)
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def pack(ascending: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as bytes: differences, the lowest byte of all first, no empty bytes."""
    if not len(ascending):
        return b""
    steps = np.diff(ascending, prepend=np.uint64(0))
    first, steps[0] = steps[0], 0
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(first).to_bytes(8, "little") + planes.T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=9).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    numbers = steps.view("<u8").ravel().astype(np.uint64)
    numbers[0] = int.from_bytes(packed[1:9], "little")
    return np.cumsum(numbers, dtype=np.uint64)

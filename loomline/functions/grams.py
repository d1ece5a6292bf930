"""Terms of whole texts and hashes of term n-grams, many texts at a time in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(5)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2 to the 64
_UNBASE = pow(_BASE, -1, 1 << 64)
#: Bytes of terms, letters in lower case; all others become spaces.
_FOLD = np.full(256, 32, np.uint8)
for _low, _high in ((48, 58), (97, 123), (128, 256)):
    _FOLD[_low:_high] = np.arange(_low, _high)
_FOLD[65:91] = _FOLD[97:123]


def spread(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


@dataclass
class Terms:
    """Terms of texts: runs of ASCII letters (in lower case), digits and characters beyond ASCII."""

    data: np.ndarray  # folded bytes of all texts
    starts: np.ndarray  # of terms, in ``data``
    ends: np.ndarray
    by_text: np.ndarray  # number of the first term of each text, and of all terms

    @classmethod
    def of(cls, texts: pa.Array) -> Terms:
        raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        body = raw.buffers()[2]
        data = _FOLD[np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]]] if body is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        term = data != 32
        edge = np.zeros(len(data) + 1, bool)  # a text begins or ends here
        edge[offsets] = True
        starts = np.flatnonzero(term & (edge[:-1] | ~np.concatenate([[False], term[:-1]])))
        ends = np.flatnonzero(term & (edge[1:] | ~np.concatenate([term[1:], [False]]))) + 1
        return cls(data, starts, ends, np.searchsorted(starts, offsets))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each term."""
        powers = np.full(len(self.data) + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * powers[:-1], out=sums[1:])
        inverse = np.full(len(self.data) + 1, _UNBASE, np.uint64)
        inverse[0] = 1
        return spread((sums[self.ends] - sums[self.starts]) * np.cumprod(inverse)[self.starts])

    def grams(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` terms from each term on, and whether they lie in one text."""
        n = max(0, len(hashes) - size + 1)
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = spread((out + hashes[k:k + n]) * np.uint64(_BASE))
        text = np.repeat(np.arange(len(self.by_text) - 1), np.diff(self.by_text))
        return out, text[:n] == text[size - 1:size - 1 + n]

    def gram(self, at: int, size: int) -> bytes:
        """The ``size`` terms from term ``at`` on, with single spaces."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(
            self.starts[at:at + size].tolist(), self.ends[at:at + size].tolist()))


class BloomFilter:
    """Set of 64-bit numbers with a bit array for each of its hash functions."""

    def __init__(self, members: np.ndarray, bits_each: int = 24, functions: int = 6):
        room = max(64, len(members) * bits_each // functions)
        self.shift = np.uint64(64 - int(room - 1).bit_length())
        self.factors = _RNG_FACTORS[:functions]
        self.bits = np.zeros((functions, (1 << (64 - int(self.shift))) // 8), np.uint8)
        for bits, factor in zip(self.bits, self.factors):
            place = (members * factor) >> self.shift
            np.bitwise_or.at(bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """Places of the numbers that may be members; all members are among them."""
        left = np.arange(len(numbers))
        for bits, factor in zip(self.bits, self.factors):
            place = (numbers[left] * factor) >> self.shift
            hit = bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)
            left = left[hit.astype(bool)]
        return left


_RNG_FACTORS = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

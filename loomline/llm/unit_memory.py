"""Units of text that can be encoded by themselves, and a compact memory of their ids."""

from __future__ import annotations

import numpy as np

from loomline.llm.words import polynomials

#: Bytes of text whose units are looked up in one step.
STEP = 4 << 20
_RNG = np.random.default_rng(11)
_TABLES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = (0x9FB21C651E98DF25, 0xC13FA9A902A6328F)  # odd, so they have inverses modulo 2 to the 64

_BLANK = np.zeros(256, bool)  # white space, and first bytes of characters that may be white space
_BLANK[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def gather(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of a buffer, one behind the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return buffer[:0]
    return buffer[np.arange(int(ends[-1])) + np.repeat(starts - ends + lengths, lengths)]


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin in texts (UTF-8) that stand one behind the other.

    At the beginning of a text, and at every space with no other white space before and behind it,
    as far as single bytes can tell: such a space belongs to what follows.
    """
    spaces = np.flatnonzero(data == 32)
    spaces = spaces[(spaces > 0) & (spaces < len(data) - 1)]
    blank = _BLANK[data[spaces + 1]] | _BLANK[data[spaces - 1]]
    multi = data[spaces - 1] >= 0x80  # the character before has more bytes: look at its first one
    blank |= multi & ((data[np.maximum(spaces - 2, 0)] == 0xC2)
                      | _BLANK[data[np.maximum(spaces - 3, 0)]])
    texts = offsets[:-1][np.diff(offsets) > 0]
    return np.union1d(texts, spaces[~blank])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit hashes of byte ranges that ascend: polynomials in their bytes."""
    out = []
    for table, base in zip(_TABLES, _BASES):
        x = polynomials(data, starts, ends, table, base)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(x ^ (x >> np.uint64(27)))
    return out


class Memory:
    """Ids by 128-bit hash: sorted keys, and where the ids stand in one buffer."""

    def __init__(self, kind: str):
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.buffer = np.zeros(1 << 16, kind)
        self.used = 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and length of the ids of each key, and whether it is known."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.starts[at], self.lengths[at], (self.keys[at] == keys) & (self.checks[at] == checks)

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Remember the ids of new keys; returns where they begin. A key that stands already isn't replaced."""
        begin = self.used
        self.used += len(ids)
        if self.used > len(self.buffer):
            grown = np.zeros(2 * self.used, self.buffer.dtype)
            grown[:begin] = self.buffer[:begin]
            self.buffer = grown
        self.buffer[begin:self.used] = ids
        starts = begin + np.cumsum(lengths) - lengths
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        taken = np.zeros(len(order), bool)
        inside = at < len(self.keys)
        taken[inside] = self.keys[at[inside]] == keys[order][inside]
        order, at = order[~taken], at[~taken]
        self.keys = np.insert(self.keys, at, keys[order])
        self.checks = np.insert(self.checks, at, checks[order])
        self.starts = np.insert(self.starts, at, starts[order])
        self.lengths = np.insert(self.lengths, at, lengths[order])
        return starts

"""Words, their hashes and hashed shingles of whole Arrow batches, by numpy."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: White space that parts words: space and the characters from tab to carriage return.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_RAW = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
#: White space and ASCII punctuation, for words that a comma must not change.
_IS_MARK = _IS_SPACE.copy()
_IS_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, U64), np.full(size, UNBASE, U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts with a space after each, and where each begins (n + 1 places)."""
    raw = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in raw], out=begins[1:])
    return data, begins


def words(
    data: np.ndarray, begins: np.ndarray, marks: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (n + 1)."""
    inside = ~(_IS_MARK if marks else _IS_SPACE)[data]
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    return starts, ends, np.searchsorted(starts, begins)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True
) -> np.ndarray:
    """64-bit hashes of words, A-Z taken as a-z if `lower`.

    Rolling sums over blocks of text; a word longer than a block is a block of its own.
    """
    table = _LOWER if lower else _RAW
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(max(BLOCK, 1 << (hi - lo).bit_length()))
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(table[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` consecutive words; of the whole if it has fewer."""
    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, U64)
    for k in range(size):
        out = mix(out * U64(BASE) + hashes[k : k + n])
    return out


class HashIndex:
    """Finds the places of 64-bit keys, many at a time, by open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = U64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, U64)
        self.places = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.places[slot] < 0
            first = np.unique(slot[free], return_index=True)[1]
            won = np.flatnonzero(free)[first]
            self.places[slot[won]] = left[won]
            self.keys[slot[won]] = keys[left[won]]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(BASE)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the indexed array, -1 where it is absent."""
        out = np.full(len(keys), -1, np.int32)
        open_, slot = np.arange(len(keys)), self._slots(keys)
        while len(open_):
            place = self.places[slot]
            hit = (place >= 0) & (self.keys[slot] == keys[open_])
            out[open_[hit]] = place[hit]
            go = (place >= 0) & ~hit
            open_, slot = open_[go], (slot[go] + 1) & self.mask
        return out

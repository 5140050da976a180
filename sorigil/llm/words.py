"""Words of an Arrow string column as NumPy arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table_of(separators: bytes) -> np.ndarray:
    """True for the bytes that belong to words."""
    keep = np.ones(256, bool)
    keep[list(separators)] = False
    return keep


#: Words of everything but white space, and words of ASCII letters, digits and all other scripts.
NOT_SPACE = table_of(SPACES)
ALNUM = table_of(bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
#: Bytes hashed at once.
STRETCH = 1 << 19
SEED = 20240117


@lru_cache(4)
def _bytes_of(seed: int) -> np.ndarray:
    """An odd factor for each byte value."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts together and the row offsets into them; null is empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """``starts`` and ``ends`` of the words in ``data`` (lower-cased bytes); row r has words ``at[r]`` to ``at[r + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray

    def hashes(self, seed: int = SEED) -> np.ndarray:
        """A 64-bit hash for each word: a polynomial over its bytes (factors by ``seed``), mixed with its length."""
        out, factors = np.empty(len(self.starts), np.uint64), _bytes_of(seed)
        for lo, hi in stretches(self.starts, self.ends):
            a, b = int(self.starts[lo]), int(self.ends[hi - 1])
            power, inverse = _powers(b - a)
            weighted = np.zeros(b - a + 1, np.uint64)
            np.multiply(factors[self.data[a:b]], power, out=weighted[:-1])
            edges = np.empty(2 * (hi - lo), np.int64)
            edges[0::2], edges[1::2] = self.starts[lo:hi] - a, self.ends[lo:hi] - a
            out[lo:hi] = np.add.reduceat(weighted, edges)[0::2] * inverse[edges[0::2]]
        return mix(out ^ (self.ends - self.starts).astype(np.uint64))


_KEPT: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept for the usual length."""
    if n > len(_KEPT.get("power", ())):
        size = max(n, STRETCH)
        made = {"power": np.cumprod(np.full(size, _P), dtype=np.uint64), "inverse": np.cumprod(np.full(size, _P_INVERSE), dtype=np.uint64)}
        if n > STRETCH:
            return made["power"][:n], made["inverse"][:n]
        _KEPT.update(made)
    return _KEPT["power"][:n], _KEPT["inverse"][:n]


def stretches(starts: np.ndarray, ends: np.ndarray, size: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of words that cover about ``size`` bytes each (a longer word has its own)."""
    lo, n = 0, len(starts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + size, "right")))
        yield lo, hi
        lo = hi


def find_words(column: pa.Array, keep: np.ndarray) -> Words:
    """The words of every text: maximal runs of ``keep`` bytes, A-Z lower-cased, never across rows."""
    raw, offsets = text_buffer(column)
    if not len(raw):
        none = np.zeros(0, np.int64)
        return Words(raw, none, none, np.zeros(len(offsets), np.int64))
    inside = keep[raw]
    firsts, lasts = inside.copy(), inside.copy()
    firsts[1:] &= ~inside[:-1]
    lasts[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    firsts[edges] = inside[edges]
    lasts[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(firsts)
    return Words(_LOWER[raw], starts, np.flatnonzero(lasts) + 1, np.searchsorted(starts, offsets))

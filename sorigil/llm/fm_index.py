"""An FM-index over a sequence of word numbers, as NumPy arrays that answer many queries at once.

Symbol 0 separates: it never matches, and every occurrence of it counts as a symbol of its own, so suffixes
are told apart at the latest at the next separator and no match crosses one.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank and access over symbols below ``2**levels``: one bit vector per level, packed, with running counts."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.n = levels, len(symbols)
        self.bits, self.ones, self.zeros = [], [], []
        for level in range(levels):
            bit = ((symbols >> (levels - 1 - level)) & 1).astype(bool)
            packed = np.zeros((self.n >> 6) + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            self.bits.append(packed)
            self.ones.append(before)
            self.zeros.append(self.n - int(np.count_nonzero(bit)))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][word] + np.bitwise_count(self.bits[level][word] & below)

    def down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` arrives when it follows ``symbol``; less ``down(symbol, 0)``, that is the rank."""
        for level in range(self.levels):
            one = self._rank1(level, i)
            i = np.where((symbol >> (self.levels - 1 - level)) & 1, self.zeros[level] + one, i - one)
        return i

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``i`` and where they arrive."""
        symbol = np.zeros_like(i)
        for level in range(self.levels):
            one = self._rank1(level, i)
            bit = (self.bits[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            symbol = symbol << 1 | bit.astype(np.int64)
            i = np.where(bit, self.zeros[level] + one, i - one)
        return symbol, i


def suffix_ranks(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The place of every suffix in sorted order, by prefix doubling over those not yet told apart.

    With ``depth``, suffixes that agree on that many symbols need not be told apart (they get one place)."""
    n, stop = len(text), text == 0
    n_stops = int(np.count_nonzero(stop))
    rank = np.empty(n, np.int64)
    rank[stop] = np.arange(n_stops)  # separators differ, in the order of the text
    counts = np.bincount(text[~stop], minlength=1)
    rank[~stop] = n_stops + (np.cumsum(counts) - counts)[text[~stop]]
    open_ = np.flatnonzero(~stop & (counts[text] > 1))
    span = 1
    while len(open_) and span < (depth or n):
        order = np.argsort(rank[open_] * n + rank[open_ + span])  # a suffix still open has no stop within ``span``
        open_ = open_[order]
        old, nxt = rank[open_], rank[open_ + span]
        place = np.arange(len(open_))
        new_old = np.r_[True, old[1:] != old[:-1]]
        new = new_old | np.r_[True, nxt[1:] != nxt[:-1]]
        group = np.maximum.accumulate(np.where(new_old, place, 0))
        mine = np.maximum.accumulate(np.where(new, place, 0))
        rank[open_] = old + mine - group
        alone = new & np.r_[new[1:], True]
        open_ = open_[~alone]
        span *= 2
    return rank


class FmIndex:
    """Backward search and location over ``text`` (symbols, 0 separates; the last one is 0)."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = 8):
        n = len(text)
        rank = suffix_ranks(text)
        before = np.empty(n, np.int64)  # the symbol before each suffix, in suffix order
        before[rank] = np.r_[0, text[:-1]]
        self.tree = WaveletMatrix(before, max(1, int(n_symbols).bit_length()))
        counts = np.bincount(text, minlength=n_symbols + 1)
        self.first = np.r_[0, np.cumsum(counts)]
        every = np.arange(n_symbols + 1)
        self.base = self.tree.down(every, np.zeros(n_symbols + 1, np.int64))
        # suffixes at every sample-th place and behind separators keep their place in the text
        kept = np.arange(n) % sample == 0
        kept |= np.r_[True, text[:-1] == 0]
        by_rank = np.zeros(n, bool)
        by_rank[rank[kept]] = True
        self.sampled = by_rank
        self.sample_at = np.cumsum(by_rank) - 1
        places = np.flatnonzero(kept)
        self.samples = np.empty(len(places), np.int64)
        self.samples[self.sample_at[rank[places]]] = places

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the phrases (rows, right-aligned symbols)."""
        width = phrases.shape[1] if phrases.ndim == 2 else 0
        lo, hi = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        live = np.flatnonzero(lengths > 0)
        c = phrases[live, width - 1] if len(live) else np.zeros(0, np.int64)
        lo[live], hi[live] = self.first[c], self.first[c + 1]
        for step in range(1, width):
            live = live[hi[live] > lo[live]]
            going = live[lengths[live] > step]
            if not len(going):
                continue
            c = phrases[going, width - 1 - step]
            ends = self.tree.down(np.r_[c, c], np.r_[lo[going], hi[going]]) + (self.first[np.r_[c, c]] - self.base[np.r_[c, c]])
            lo[going], hi[going] = ends[: len(going)], ends[len(going) :]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes at ``rows``, walking back to the next sample."""
        out, steps = np.empty(len(rows), np.int64), 0
        todo = np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            known = self.sampled[rows]
            out[todo[known]] = self.samples[self.sample_at[rows[known]]] + steps
            todo, rows = todo[~known], rows[~known]
            if len(todo):
                symbol, at = self.tree.access(rows)
                rows = self.first[symbol] + at - self.base[symbol]
            steps += 1
        return out

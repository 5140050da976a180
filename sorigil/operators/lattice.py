"""Word lattices as flat edge arrays (word, begin, end, piece): forward-backward and best paths for many words at once.

Words of like length are taken together, and every step runs over one position of all of them in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def _segment_lse(vals: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-sum-exp of ``vals`` per run of equal values in ``seg`` (runs are contiguous):
    (segment keys, results)."""
    starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    m = np.maximum.reduceat(vals, starts)
    sizes = np.diff(np.r_[starts, len(vals)])
    return seg[starts], m + np.log(np.add.reduceat(np.exp(vals - np.repeat(m, sizes)), starts))


LATTICE_CELLS = 1 << 20  # words of one matrix times its longest word


def by_length(lengths: np.ndarray, cells: int = LATTICE_CELLS) -> Iterator[np.ndarray]:
    """Word numbers in groups of like length whose dense matrices have at most ``cells`` cells (a longer
    word is a group of its own), so one long word does not widen the rows of all others."""
    order = np.argsort(lengths, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * (lengths[order[hi]] + 1) <= cells:
            hi += 1
        yield order[lo:hi]
        lo = hi


def _by_place(at: np.ndarray, width: int) -> np.ndarray:
    """Edge numbers by place, in their order (word, begin) within one: a stable sort, by counting for places of 16 bits."""
    return np.argsort(at.astype(np.uint16) if width < 1 << 16 else at, kind="stable")


def forward_backward(
    W: np.ndarray, B: np.ndarray, E: np.ndarray, P: np.ndarray, lengths: np.ndarray, freqs: np.ndarray, score_arr: np.ndarray, unk_score: float
) -> tuple[float, np.ndarray]:
    """(Log-likelihood, expected count per piece number) of a batch of word lattices.

    Alpha is one segmented log-sum-exp per end position over the edges ending there, across
    all words of the batch, and beta the same per begin position. Edges of pieces without a score (nan:
    pruned) are left out."""
    counts = np.zeros(len(score_arr))
    if not len(W):
        return 0.0, counts
    S = np.where(P >= 0, score_arr[np.maximum(P, 0)], unk_score)
    if np.isnan(S).any():
        live = ~np.isnan(S)
        W, B, E, P, S = W[live], B[live], E[live], P[live], S[live]
    width, n = int(lengths.max()) + 1, len(lengths)
    alpha = np.full((n, width), -np.inf)
    alpha[:, 0] = 0.0
    by_end = _by_place(E, width)
    bounds = np.searchsorted(E[by_end], np.arange(width + 1))
    for e in range(1, width):
        sel = by_end[bounds[e] : bounds[e + 1]]
        if len(sel):
            keys, v = _segment_lse(alpha[W[sel], B[sel]] + S[sel], W[sel])
            alpha[keys, e] = v
    beta = np.full((n, width), -np.inf)
    beta[np.arange(n), lengths] = 0.0
    by_begin = _by_place(B, width)
    bounds = np.searchsorted(B[by_begin], np.arange(width + 1))
    for b in range(width - 2, -1, -1):
        sel = by_begin[bounds[b] : bounds[b + 1]]
        if len(sel):
            keys, v = _segment_lse(beta[W[sel], E[sel]] + S[sel], W[sel])
            beta[keys, b] = v
    z = alpha[np.arange(n), lengths]
    known = P >= 0
    post = np.exp(alpha[W, B] + S + beta[W, E] - z[W])
    counts = np.bincount(P[known], weights=(freqs[W] * post)[known], minlength=len(score_arr))
    return float(np.dot(freqs, z)), counts


BLOCK_CELLS = 1 << 15  # words of one block times its longest word
TINY = 1e-200  # a word less likely than this is counted in log space


@dataclass
class Block:
    """The lattice of words of like length as a table of ``width`` ends, ``reach`` begins and ``n`` words: the edge of piece ``p``
    (-1: a character that is no piece) that ends at e and is k long has the place ``(e * reach + reach - k) * n + word``."""

    width: int
    reach: int
    lengths: np.ndarray
    freqs: np.ndarray
    at: np.ndarray
    p: np.ndarray


def blocks(W: np.ndarray, B: np.ndarray, E: np.ndarray, P: np.ndarray, lengths: np.ndarray, freqs: np.ndarray, cells: int = BLOCK_CELLS) -> Iterator[Block]:
    """The edges of many words (sorted by word) in blocks of like length."""
    per_word = np.searchsorted(W, np.arange(len(lengths) + 1))
    for part in by_length(lengths, cells):
        sizes = np.diff(per_word)[part]
        edge = np.repeat(per_word[part] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        word, size = np.repeat(np.arange(len(part)), sizes), E[edge] - B[edge]
        reach = int(size.max()) if len(size) else 1
        yield Block(int(lengths[part].max()) + 1, reach, lengths[part], freqs[part], (E[edge] * reach + reach - size) * len(part) + word, P[edge])


def block_counts(block: Block, scores: np.ndarray, unk_score: float) -> tuple[float, np.ndarray]:
    """``forward_backward`` of a block: (log-likelihood, expected count per piece number; nan scores: pruned).

    Alpha and beta are sums of products of probabilities, one position of all words at a time; words whose likelihood is too
    small for that are counted by ``forward_backward``."""
    n, reach, width = len(block.lengths), block.reach, block.width
    prob = np.exp(np.append(scores, unk_score))
    prob[np.isnan(prob)] = 0.0
    table = np.zeros((width, reach, n))
    flat = table.reshape(-1)
    flat[block.at] = prob[block.p]  # number -1 is the last: the unknown character
    alpha, words = np.zeros((width, n)), np.arange(n)
    alpha[0] = 1.0
    for e in range(1, width):
        k = min(e, reach)
        np.einsum("kn,kn->n", alpha[e - k : e], table[e, reach - k :], out=alpha[e])
    z = alpha[block.lengths, words]
    plain = (z > TINY) & np.isfinite(z)
    # beta already holds the word's frequency over its likelihood, so that alpha * edge * beta is an expected count
    beta = np.zeros((width, n))
    beta[block.lengths[plain], words[plain]] = block.freqs[plain] / z[plain]
    for e in range(width - 1, 0, -1):
        k = min(e, reach)
        into = table[e, reach - k :]
        into *= beta[e]
        beta[e - k : e] += into
        into *= alpha[e - k : e]
    counts = np.bincount(block.p + 1, weights=flat[block.at], minlength=len(scores) + 1)[1:]
    likelihood = float(np.dot(block.freqs[plain], np.log(z[plain])))
    if not plain.all():
        word, place = block.at % n, block.at // n
        rest = np.flatnonzero(~plain[word])
        number = np.cumsum(~plain) - 1
        end = place[rest] // reach
        begin = end - reach + place[rest] % reach
        order = np.lexsort((end, begin, word[rest]))
        rest, begin, end = rest[order], begin[order], end[order]
        ll, more = forward_backward(number[word[rest]], begin, end, block.p[rest], block.lengths[~plain], block.freqs[~plain], scores, unk_score)
        likelihood, counts = likelihood + ll, counts + more
    return likelihood, counts


def best_paths(W: np.ndarray, B: np.ndarray, E: np.ndarray, S: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best path of every word: its score (-inf where no path reaches the end), and the edges of all paths in order with
    their words. A better score replaces, so ties at an end keep the edge with the smallest begin."""
    score = np.zeros(len(lengths))
    words, edges = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    per_word = np.searchsorted(W, np.arange(len(lengths) + 1))
    for part in by_length(lengths):
        sizes = np.diff(per_word)[part]
        edge = np.repeat(per_word[part] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        s, w, e = _best_of(np.repeat(np.arange(len(part)), sizes), B[edge], E[edge], S[edge], lengths[part])
        score[part] = s
        words.append(part[w])
        edges.append(edge[e])
    words, edges = np.concatenate(words), np.concatenate(edges)
    order = np.argsort(words, kind="stable")
    return score, words[order], edges[order]


def _best_of(W: np.ndarray, B: np.ndarray, E: np.ndarray, S: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, width = len(lengths), int(lengths.max()) + 1
    best, back = np.full((n, width), -np.inf), np.full((n, width), -1, np.int64)
    best[:, 0] = 0.0
    by_end = _by_place(E, width)
    bounds = np.searchsorted(E[by_end], np.arange(width + 1))
    for e in range(1, width):
        sel = by_end[bounds[e] : bounds[e + 1]]
        if len(sel):
            total, word = best[W[sel], B[sel]] + S[sel], W[sel]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            top = np.maximum.reduceat(total, starts)
            sizes = np.diff(np.r_[starts, len(sel)])
            first = np.minimum.reduceat(np.where(total == np.repeat(top, sizes), np.arange(len(sel)), len(sel)), starts)
            best[word[starts], e], back[word[starts], e] = top, np.where(np.isneginf(top), -1, sel[np.minimum(first, len(sel) - 1)])
    score = best[np.arange(n), lengths]
    row, at = np.flatnonzero((lengths > 0) & ~np.isneginf(score)), lengths.copy()
    rows, edges = [], []
    while len(row):
        edge = back[row, at[row]]
        rows.append(row)
        edges.append(edge)
        at[row] = B[edge]
        row = row[at[row] > 0]
    if not rows:
        return score, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return score, np.concatenate(rows[::-1]), np.concatenate(edges[::-1])

"""Plain per-word forms of the training steps, for comparison with the library's."""

import math

import numpy as np
import pandas as pd

from sorigil.operators.vocab import MAX_PIECE_LEN, UNK_ID


def _lattice(word: str, scores: dict, max_len: int, pref: frozenset | None = None):
    n = len(word)
    edges = []
    for b in range(n):
        found = False
        for e in range(b + 1, min(n, b + max_len) + 1):
            sub = word[b:e]
            if pref is not None and sub not in pref:
                break
            s = scores.get(sub)
            if s is not None:
                edges.append((b, e, s, word[b:e]))
                found = found or e == b + 1
        if not found:
            edges.append((b, b + 1, None, word[b : b + 1]))
    return edges


def _lse(vals: list) -> float:
    m = max(vals)
    return m + math.log(sum(math.exp(v - m) for v in vals))


def expected_counts(word: str, freq: float, scores: dict, max_len: int, unk_score: float, pref: frozenset | None = None):
    """Forward-backward over one word: (log-likelihood, {piece: expected count}).

    Every position has an edge of length one (a piece or the unknown edge), so
    each end and each start has at least one edge; alpha and beta are one
    log-sum-exp per position over the edges ending (starting) there."""
    n = len(word)
    edges = _lattice(word, scores, max_len, pref)
    sc = [unk_score if s is None else s for _, _, s, _ in edges]
    into: list = [[] for _ in range(n + 1)]
    out_of: list = [[] for _ in range(n + 1)]
    for i, (b, e, _, _) in enumerate(edges):
        into[e].append(i)
        out_of[b].append(i)
    alpha = [0.0] * (n + 1)
    for e in range(1, n + 1):
        alpha[e] = _lse([alpha[edges[i][0]] + sc[i] for i in into[e]])
    beta = [0.0] * (n + 1)
    for b in range(n - 1, -1, -1):
        beta[b] = _lse([beta[edges[i][1]] + sc[i] for i in out_of[b]])
    z = alpha[n]
    out: dict = {}
    for i, (b, e, s, p) in enumerate(edges):
        if s is None:
            continue
        post = math.exp(alpha[b] + s + beta[e] - z)
        if post > 0:
            out[p] = out.get(p, 0.0) + freq * post
    return freq * z, out


def m_step(counts: pd.DataFrame, keep_chars: set, min_count: float = 1e-3) -> dict:
    """M step on the collected count table (bounded by the vocabulary size)."""
    c = counts[(counts["n"] >= min_count) | counts["piece"].isin(keep_chars)]
    total = float(c["n"].sum())
    return {p: math.log(max(n, 1e-12) / total) for p, n in zip(c["piece"].tolist(), c["n"].tolist())}


def prune(scores: dict, counts: dict, keep_chars: set, target: int, shrink: float = 0.75, max_len: int = MAX_PIECE_LEN) -> dict:
    """Drop the pieces whose removal costs least likelihood; never single characters.

    Loss of a piece = its expected count times (its score minus the score of
    its best split into other pieces); pieces with no alternative split are kept."""
    losses = []
    for p, s in scores.items():
        if len(p) == 1 or p in keep_chars:
            continue
        alt = _best_split_without(p, scores, max_len)
        loss = math.inf if alt == -math.inf else counts.get(p, 0.0) * (s - alt)
        losses.append((loss, p))
    n_keep = max(target, int(len(scores) * shrink))
    singles = [p for p in scores if len(p) == 1 or p in keep_chars]
    room = max(n_keep - len(singles), 0)
    losses.sort(key=lambda x: (-x[0], x[1]))
    kept = {p for _, p in losses[:room]} | set(singles)
    return {p: scores[p] for p in kept}


def prefixes(pieces) -> frozenset:
    """Every non-empty prefix of every piece. A substring that is not one starts
    no piece, so a scan of the lattice from a start position stops there."""
    return frozenset(p[:k] for p in pieces for k in range(1, len(p) + 1))


def lattice_edges_of(words: list, index: dict, max_len: int, pref: frozenset) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat edges (word number, begin, end, piece number) of all words. A position whose character is no
    piece has an edge of length one with piece number -1, so no position is without edges."""
    wi, bb, ee, pp = [], [], [], []
    aw, ab, ae, ap = wi.append, bb.append, ee.append, pp.append
    for k, word in enumerate(words):
        n = len(word)
        for b in range(n):
            single = False
            for e in range(b + 1, min(n, b + max_len) + 1):
                sub = word[b:e]
                if sub not in pref:
                    break
                j = index.get(sub)
                if j is not None:
                    aw(k), ab(b), ae(e), ap(j)
                    single = single or e == b + 1
            if not single:
                aw(k), ab(b), ae(b + 1), ap(-1)
    return tuple(np.array(x, dtype=np.int64) for x in (wi, bb, ee, pp))


def _best_split_without(piece: str, scores: dict, max_len: int):
    """Viterbi score of a piece using only other pieces (for the pruning loss)."""
    n = len(piece)
    best = [-math.inf] * (n + 1)
    best[0] = 0.0
    for e in range(1, n + 1):
        for b in range(max(0, e - max_len), e):
            if b == 0 and e == n:
                continue
            s = scores.get(piece[b:e])
            if s is not None and best[b] + s > best[e]:
                best[e] = best[b] + s
    return best[n]


def viterbi(word: str, vocab: dict, max_len: int, unk_score: float, pref: frozenset | None = None):
    """Best split of one word: (pieces, ids, score). ``vocab`` maps piece -> (id, score).

    Edges are relaxed forward from each start position b in increasing order
    (every edge into b starts before b, so ``best[b]`` is final), and replace
    the best at their end only when strictly better: for each end, ties keep
    the edge with the smallest begin. A start whose single character is no
    piece gets an unknown edge (id 1). With ``pref`` (the prefixes of all
    pieces) the scan from b stops at the first substring no piece begins with."""
    n = len(word)
    best = [-math.inf] * (n + 1)
    back: list = [None] * (n + 1)
    best[0] = 0.0
    for b in range(n):
        base = best[b]
        single = False
        for e in range(b + 1, min(n, b + max_len) + 1):
            p = word[b:e]
            if pref is not None and p not in pref:
                break
            hit = vocab.get(p)
            if hit is None:
                continue
            single = single or e == b + 1
            cand = base + hit[1]
            if cand > best[e]:
                best[e], back[e] = cand, (b, hit[0], p)
        if not single:
            cand = base + unk_score
            if cand > best[b + 1]:
                best[b + 1], back[b + 1] = cand, (b, UNK_ID, word[b])
    pieces, ids = [], []
    e = n
    while e > 0:
        b, i, p = back[e]
        pieces.append(p)
        ids.append(i)
        e = b
    return pieces[::-1], ids[::-1], best[n] if n else 0.0

"""Band-limited resampling (R10) by a polyphase filter bank.

Sample j of the result lies at ``t = j * M / L`` of the clip, where L / M is the ratio of the rates in lowest terms. Its weights depend
only on the phase ``(j * M) mod L``, so a ratio has L rows of weights, made once per worker; results are sums of
windows of the clip times those rows, for all samples of a phase in one matrix product."""

from __future__ import annotations

from functools import lru_cache
from math import gcd

import numpy as np

#: Weights times samples of one matrix product.
CELLS = 1 << 21


def ratio(from_rate: int, to_rate: int) -> tuple[int, int]:
    """(L, M): ``to / from`` in lowest terms."""
    g = gcd(int(from_rate), int(to_rate))
    return int(to_rate) // g, int(from_rate) // g


def reach(from_rate: int, to_rate: int, zeros: int) -> int:
    """How many samples on each side of t a result can depend on."""
    up, down = ratio(from_rate, to_rate)
    return int(np.ceil(zeros * max(1.0, down / up))) + 1


@lru_cache(maxsize=64)
def bank(up: int, down: int, zeros: int) -> np.ndarray:
    """Weights ``(L, 2 * reach)``: row p for the samples from ``floor(t) - reach + 1`` to ``floor(t) + reach``. A sinc cut off at the
    lower of the two Nyquist rates under a Hann window of ``zeros`` zero crossings on each side."""
    cut = min(1.0, up / down)
    half, side = zeros / cut, reach(down, up, zeros)
    d = np.arange(up)[:, None] / up - np.arange(1 - side, side + 1)[None, :]
    taper = np.where(np.abs(d) <= half, 0.5 + 0.5 * np.cos(np.pi * d / half), 0.0)
    return cut * np.sinc(cut * d) * taper


def resampled(samples: np.ndarray, first: int, total: int, begin: int, end: int, from_rate: int, to_rate: int, zeros: int) -> np.ndarray:
    """The results whose place ``floor(t)`` is in ``[begin, end)`` of a clip of ``total`` samples, of which ``samples`` are those from
    ``first`` on (all that the results depend on, or up to the clip's ends, beyond which samples count as zero)."""
    up, down = ratio(from_rate, to_rate)
    weights, side = bank(up, down, zeros), reach(from_rate, to_rate, zeros)
    lo, hi = -(-begin * up // down), min(-(-end * up // down), -(-total * up // down))
    out = np.zeros(max(hi - lo, 0))
    if not len(out):
        return out
    at = (lo * down) // up - side + 1  # the first sample of the first window
    stop = ((hi - 1) * down) // up + side + 1
    padded = np.zeros(stop - at)
    a, b = max(at, first), min(stop, first + len(samples))
    padded[a - at : b - at] = samples[a - first : b - first]
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * side)
    for j in range(lo, min(lo + up, hi)):  # one phase: every up-th result, its windows down samples apart
        mine, start = out[j - lo :: up], (j * down) // up - side + 1 - at
        step = max(1, CELLS // (2 * side))
        for k in range(0, len(mine), step):
            n = min(step, len(mine) - k)
            mine[k : k + n] = windows[start + k * down :: down][:n] @ weights[(j * down) % up]
    return out

"""Waveform columns (R7-R10, R14): trimming, re-timing, clipping and decibel scales as array expressions
evaluated inside the JVM, and resampling by an Arrow function."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.functions import polyphase
from sorigil.functions.bind import let

# Fixed values used by the reference clean-up steps and the decibel scale.
TRIM_THRESHOLD = 0.02
TRIM_HOLD_SEC = 0.5
OUTPUT_RATE = 44100
SPEED_MIN, SPEED_MAX = 0.1, 5.0
AMIN_POWER = 1e-10
AMIN_AMPLITUDE = 1e-5
TOP_DB = 80.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def trim_tail(x, threshold: float = TRIM_THRESHOLD, rate=OUTPUT_RATE, hold: float = TRIM_HOLD_SEC) -> Column:
    """Keep samples up to ``last + int(rate * hold)`` (exclusive) where ``last`` is the
    0-based index of the last sample with ``|v| > threshold``; no such sample → unchanged."""
    a = _col(x)
    n = F.size(a)
    last_of = lambda s: F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(s["a"]) - 1, F.lit(0))),
            lambda i: F.when(F.abs(F.get(s["a"], i)) > threshold, i).otherwise(F.lit(-1)),
        )
    )

    def body(s):
        keep = F.least(s["last"] + F.floor(_lit_or_col(rate) * hold).cast("int"), F.size(s["a"]))
        return F.when((F.size(s["a"]) == 0) | (s["last"] < 0), s["a"]).otherwise(F.slice(s["a"], 1, keep))

    return let(lambda s: let(body, a=s["a"], last=last_of(s)), a=a)


def _interp(a: Column, n: Column, m: Column) -> Column:
    """Linear interpolation of ``a`` (n samples) at ``m`` evenly spaced points over [0, n-1]."""

    def body(s):
        a, n, step = s["a"], s["n"], s["step"]

        def at(i):
            xi = i.cast("double") * step
            lo = F.least(F.floor(xi).cast("int"), n - 1)
            hi = F.least(lo + 1, n - 1)
            y0, y1 = F.get(a, lo), F.get(a, hi)
            return y0 + (xi - lo) * (y1 - y0)

        return F.transform(F.sequence(F.lit(0), F.greatest(s["m"] - 1, F.lit(0))), at)

    pts = let(body, a=a, n=n, m=m, step=(n - 1).cast("double") / (m - 1).cast("double"))
    return F.when(m == 1, F.array(F.get(a, 0))).otherwise(pts)


def change_speed(x, factor) -> Column:
    """Factor clamped to [0.1, 5]; ``n' = int(n / f)``; linear interpolation onto n' points.

    A factor of exactly 1, ``n' = n`` or ``n' = 0`` leaves the clip unchanged."""
    a = _col(x)
    f_raw = _lit_or_col(factor).cast("double")
    f = F.greatest(F.lit(SPEED_MIN), F.least(f_raw, F.lit(SPEED_MAX)))
    n = F.size(a)
    m = F.floor(n / f).cast("int")
    return F.when(a.isNull() | (f_raw == 1.0) | (m == n) | (m <= 0) | (n == 0), a).otherwise(_interp(a, n, m))


RESAMPLE_ZEROS = 16  # zero crossings of the kernel on each side


def resample(x, from_rate, to_rate, zeros: int = RESAMPLE_ZEROS) -> Column:
    """Band-limited resampling to ``ceil(n * to / from)`` samples (whole rates).

    Sample j of the result lies at time j / to, that is at ``t = j * from / to`` of the clip. It is the sum of the
    clip's samples near t under a sinc kernel, cut off at the lower of the two Nyquist rates and tapered by a
    Hann window of ``zeros`` zero crossings on each side; samples beyond the ends count as zero. An Arrow function over a polyphase
    filter bank; clips too long for one row go by ``operators.blocks``."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(samples: pa.Array, fr: pa.Array, to: pa.Array) -> pa.Array:
        made, sizes = [], [0]
        for clip, a, b in zip(samples, fr.to_pylist(), to.to_pylist()):
            if not clip.is_valid or a is None or b is None:
                sizes.append(None)
                continue
            v = clip.values.to_numpy(zero_copy_only=False)
            made.append(v if a == b or not len(v) else polyphase.resampled(v, 0, len(v), 0, len(v), a, b, zeros))
            sizes.append(len(made[-1]))
        valid = np.array([s is not None for s in sizes[1:]], bool)
        at = np.cumsum([s or 0 for s in sizes]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*made, np.zeros(0)])), mask=pa.array(~valid))

    whole = lambda c: _lit_or_col(c).cast("long")
    return run(_col(x).cast("array<double>"), whole(from_rate), whole(to_rate))


def clip_amplitude(x, lo: float = -1.0, hi: float = 1.0) -> Column:
    """Clip every sample to [lo, hi]."""
    return F.transform(_col(x), lambda v: F.greatest(F.lit(lo), F.least(F.lit(hi), v)))


def power_to_db(x, ref=None, amin: float = AMIN_POWER, top_db: float | None = TOP_DB) -> Column:
    """``10 log10(max(amin, v)) - 10 log10(max(amin, ref))``, floored at ``max - top_db``.

    ``ref=None`` uses the array maximum (``ref = max``). The reference level and
    the floor are bound once per array (``let``), not per element."""
    a = _col(x)
    r = F.array_max(a) if ref is None else _lit_or_col(ref)
    db = let(
        lambda s: F.transform(s["a"], lambda v: 10.0 * F.log10(F.greatest(F.lit(amin), v)) - s["ref_db"]),
        a=a,
        ref_db=10.0 * F.log10(F.greatest(F.lit(amin), r)),
    )
    if top_db is None:
        return db
    return let(lambda s: F.transform(s["db"], lambda v: F.greatest(v, s["floor"])), db=db, floor=F.array_max(db) - top_db)


def amplitude_to_db(x, amin: float = AMIN_AMPLITUDE, top_db: float | None = TOP_DB) -> Column:
    """Decibels of |x| relative to its maximum: power_to_db(x², ref=max², amin²)."""
    sq = F.transform(_col(x), lambda v: v * v)
    return power_to_db(sq, None, amin * amin, top_db)


def db_to_power(x) -> Column:
    """R14 inverse: ``10 ** (v / 10)``."""
    return F.transform(_col(x), lambda v: F.pow(F.lit(10.0), v / 10.0))


def duration(x, rate) -> Column:
    """Samples / rate in seconds."""
    return F.size(_col(x)) / _lit_or_col(rate).cast("double")

"""Log-mel features of clips.

One row per frame: framing (R11) is an array expression whose frames are
exploded, so a long clip spreads over many rows and tasks. The windowed power
spectrum and mel projection (R12, R13) run in one Arrow function over a batch
of frames as a NumPy matrix (``rfft`` and a matrix product). Clip-level values
(the reference level of ``power_to_db(ref=max)`` and the mean and population
deviation of the z-score) are partial aggregates per clip joined back on
``clip_id`` (one row per clip; Spark broadcasts it by size, or AQE splits a
skewed clip's frames).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.functions.audio import AMIN_POWER, TOP_DB
from sorigil.functions.bind import let
from sorigil.session import task_count

N_FFT = 1024
N_MELS = 80
ZSCORE_EPS = 1e-5
FRAME_BLOCK = 4096  # frames of one clip hashed together
SAMPLE_BLOCK = 1024  # frames made from one stretch of samples

# Fixed values of the Slaney mel scale (linear below 1 kHz, logarithmic above).
MEL_F_SP = 200.0 / 3
MEL_MIN_LOG_HZ = 1000.0
MEL_LOGSTEP = math.log(6.4) / 27.0


def hz_to_mel(hz):
    """Mel of a frequency: proportional up to 1 kHz, a constant ratio per mel above."""
    hz = np.asarray(hz, dtype=np.float64)
    knee = MEL_MIN_LOG_HZ / MEL_F_SP
    above = knee + np.log(np.maximum(hz, MEL_MIN_LOG_HZ) / MEL_MIN_LOG_HZ) / MEL_LOGSTEP
    return np.where(hz < MEL_MIN_LOG_HZ, hz / MEL_F_SP, above)


def mel_to_hz(mel):
    """Inverse of ``hz_to_mel``."""
    mel = np.asarray(mel, dtype=np.float64)
    knee = MEL_MIN_LOG_HZ / MEL_F_SP
    above = MEL_MIN_LOG_HZ * np.exp(MEL_LOGSTEP * (np.maximum(mel, knee) - knee))
    return np.where(mel < knee, mel * MEL_F_SP, above)


def mel_filters(sr: float, n_fft: int, n_mels: int, fmin: float = 0.0, fmax: float | None = None) -> np.ndarray:
    """Triangular mel filters with area normalisation, ``(n_mels, 1 + n_fft // 2)``."""
    top = sr / 2.0 if fmax is None else fmax
    edges = mel_to_hz(np.linspace(hz_to_mel(fmin), hz_to_mel(top), n_mels + 2))
    left, peak, right = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    hz = np.arange(1 + n_fft // 2)[None, :] * (sr / n_fft)
    rising, falling = (hz - left) / (peak - left), (right - hz) / (right - peak)
    return np.clip(np.minimum(rising, falling), 0.0, None) * 2.0 / (right - left)


def hann(n: int) -> np.ndarray:
    """Periodic Hann window."""
    return 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(n) / n)


def frames(x, n_fft: int = N_FFT, hop: int | None = None, center: bool = True) -> Column:
    """``ARRAY<ARRAY<DOUBLE>>`` of overlapping frames (zero padding of n_fft/2 at both
    ends when centred). The padded clip is bound once, so each frame is one slice."""
    hop = hop or n_fft // 4
    a = F.col(x) if isinstance(x, str) else x
    pad = n_fft // 2 if center else 0
    zeros = F.array_repeat(F.lit(0.0), pad)
    padded = F.concat(zeros, a, zeros) if pad else a

    def body(s):
        n_frames = F.floor((F.size(s["p"]) - n_fft) / hop).cast("int") + 1
        idx = F.sequence(F.lit(0), F.greatest(n_frames - 1, F.lit(0)))
        cut = F.transform(idx, lambda f: F.slice(s["p"], f * hop + 1, F.lit(n_fft)))
        return F.when(n_frames > 0, cut).otherwise(F.array().cast("array<array<double>>"))

    return let(body, p=padded)


_MEL_CACHE: dict = {}


def _spectrum_batch(values: np.ndarray, rates: np.ndarray, n_fft: int, n_mels: int | None) -> tuple[np.ndarray, int]:
    m = values.reshape(-1, n_fft) * hann(n_fft)[None, :]
    power = np.abs(np.fft.rfft(m, axis=1)) ** 2
    if not n_mels:
        return power, power.shape[1]
    out = np.empty((power.shape[0], n_mels))
    for sr in np.unique(rates):
        key = (float(sr), n_fft, n_mels)
        if key not in _MEL_CACHE:
            _MEL_CACHE[key] = mel_filters(float(sr), n_fft, n_mels)
        sel = rates == sr
        out[sel] = power[sel] @ _MEL_CACHE[key].T
    return out, n_mels


def power_spectrum_fn(n_fft: int, n_mels: int | None):
    """R12 (+R13 when ``n_mels``): an Arrow function ``(frame, rate) -> ARRAY<DOUBLE>``."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def spectrum(frame: pa.Array, rate: pa.Array) -> pa.Array:
        if isinstance(frame, pa.ChunkedArray):
            frame = frame.combine_chunks()
        n = len(frame)
        if n == 0:
            return pa.array([], type=pa.list_(pa.float64()))
        flat = frame.flatten().to_numpy(zero_copy_only=False)
        rates = np.asarray(rate.to_numpy(zero_copy_only=False), dtype=np.float64)
        out, width = _spectrum_batch(flat, rates, n_fft, n_mels)
        offsets = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1)))

    return spectrum


def frame_rows(clips: DataFrame, n_fft: int = N_FFT, hop: int | None = None, array_col: str = "audio.array", rate_col: str = "audio.sampling_rate", block: int = SAMPLE_BLOCK) -> DataFrame:
    """``clip_id, rate, frame_idx, frame`` — one row per frame.

    A clip is first cut into stretches of samples that hold ``block`` frames each (neighbours overlap by the
    rest of a frame), and every stretch is a row before its frames are made: a long clip's
    overlapping frames, four times its samples, never stand in one row."""
    hop = hop or n_fft // 4
    zeros = F.array_repeat(F.lit(0.0), n_fft // 2)

    def stretches(s):
        n = F.floor((F.size(s["p"]) - n_fft) / hop).cast("int") + 1
        cut = F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")),
            lambda b: F.struct((b * block).alias("first"), F.slice(s["p"], b * (block * hop) + 1, F.lit((block - 1) * hop + n_fft)).alias("samples")),
        )
        return F.when(n > 0, cut)

    cut = clips.select("clip_id", F.col(rate_col).alias("rate"), F.explode(let(stretches, p=F.concat(zeros, F.col(array_col), zeros))).alias("s"))
    rows = cut.select("clip_id", "rate", F.col("s.first").alias("first"), F.posexplode(frames("s.samples", n_fft, hop, center=False)).alias("i", "frame"))
    return rows.select("clip_id", "rate", (F.col("first") + F.col("i")).alias("frame_idx"), "frame")


def clip_stats(rows: DataFrame, col: str) -> DataFrame:
    """A3: per clip max, mean and population deviation over every cell of every frame.

    Per-frame partial sums come from ``aggregate`` over the frame's array, then
    one grouped (map-side combined) sum per clip."""
    per_frame = rows.select(
        "clip_id",
        F.size(col).alias("_n"),
        F.aggregate(col, F.lit(0.0), lambda a, v: a + v).alias("_s"),
        F.aggregate(col, F.lit(0.0), lambda a, v: a + v * v).alias("_q"),
        F.array_max(col).alias("_m"),
    )
    g = per_frame.groupBy("clip_id").agg(F.sum("_n").alias("n"), F.sum("_s").alias("s"), F.sum("_q").alias("q"), F.max("_m").alias("max"))
    mean = F.col("s") / F.col("n")
    var = F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))
    return g.select("clip_id", "max", mean.alias("mean"), F.sqrt(var).alias("std"))


def log_features(
    clips: DataFrame,
    n_fft: int = N_FFT,
    hop: int | None = None,
    n_mels: int | None = N_MELS,
    amin: float = AMIN_POWER,
    top_db: float = TOP_DB,
    eps: float = ZSCORE_EPS,
) -> DataFrame:
    """``clip_id, frame_idx, features ARRAY<DOUBLE>``: (mel) power in dB relative to
    the clip maximum, floored ``top_db`` below it, z-scored over the whole clip."""
    fr = frame_rows(clips, n_fft, hop)
    # Spectra are hashed on (clip, block of FRAME_BLOCK frames): one very long clip spreads
    # over many tasks, and since the partitioning reads frame_idx every reader of this
    # exchange keeps the same columns, so Spark reuses it and the Fourier step runs once.
    # The per-clip tables are one row per clip; Spark broadcasts them by measured size, or
    # AQE splits a hot clip's frames in the join back.
    p = power_spectrum_fn(n_fft, n_mels)("frame", "rate")
    block = F.floor(F.col("frame_idx") / FRAME_BLOCK)
    spec = fr.select("clip_id", "frame_idx", p.alias("p")).repartition(task_count(fr.sparkSession), "clip_id", block)
    ref = spec.groupBy("clip_id").agg(F.max(F.array_max("p")).alias("ref"))
    ref_db = 10.0 * F.log10(F.greatest(F.lit(amin), F.col("ref")))
    db = spec.join(ref, "clip_id").select(
        "clip_id", "frame_idx", F.transform("p", lambda v: 10.0 * F.log10(F.greatest(F.lit(amin), v)) - ref_db).alias("db")
    )
    # With ref = the clip maximum the loudest cell is exactly 0 dB, so the floor is -top_db.
    floored = db.select("clip_id", "frame_idx", F.transform("db", lambda v: F.greatest(v, F.lit(-top_db))).alias("db"))
    st = clip_stats(floored, "db")
    return floored.join(st, "clip_id").select(
        "clip_id", "frame_idx", F.transform("db", lambda v: (v - F.col("mean")) / (F.col("std") + eps)).alias("features")
    )

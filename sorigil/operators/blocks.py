"""Long clips as blocks of samples (R7, R8, R10): a clip is many rows ``(clip_id, block)``, and blocks that need their neighbours'
samples get them from halo rows, so that no task and no group holds a clip.

``split_clips`` makes the blocks of clips that stand in one row; tables written by block have the same columns: ``clip_id, rate, n``
(samples of the clip), ``block, first`` (place of the block's first sample), ``samples``. All blocks of a clip but the last have
``size`` samples; a block's results stay in the block, in order, and may differ in number. An empty clip has one empty block;
clips without samples (null) have none. Results equal the one-row forms of ``functions.audio``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorigil.functions import polyphase
from sorigil.functions.audio import OUTPUT_RATE, RESAMPLE_ZEROS, SPEED_MAX, SPEED_MIN, TRIM_HOLD_SEC, TRIM_THRESHOLD
from sorigil.functions.bind import let

BLOCK = 1 << 16
MADE = "clip_id {id}, rate int, block int, samples array<double>"


def split_clips(clips: DataFrame, size: int = BLOCK, array_col: str = "audio.array", rate_col: str = "audio.sampling_rate", id_col: str = "clip_id") -> DataFrame:
    """Blocks of ``size`` samples of clips that stand in one row each."""

    def cut(s):
        last = F.floor(F.greatest(F.size(s["a"]) - 1, F.lit(0)) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(b.alias("block"), F.slice(s["a"], b * size + 1, F.lit(size)).alias("samples")))

    rows = clips.where(F.col(array_col).isNotNull()).select(F.col(id_col).alias("clip_id"), F.col(rate_col).cast("int").alias("rate"), F.size(array_col).cast("long").alias("n"), F.explode(let(cut, a=F.col(array_col))).alias("b"))
    return rows.select("clip_id", "rate", "n", "b.block", (F.col("b.block").cast("long") * size).alias("first"), F.col("b.samples").cast("array<double>").alias("samples"))


def with_halo(blocks: DataFrame, left: int, right: int, size: int = BLOCK) -> DataFrame:
    """``before`` and ``after``: the last ``left`` samples of the clip before a block and the first ``right`` behind it. Each block sends its
    ends to the blocks next to it (as many as the halo reaches), and rows meet by (clip, block)."""
    none = F.array().cast("array<double>")
    own = blocks.select("clip_id", "block", F.lit(0).alias("way"), "rate", "n", "first", "samples")
    sent = []
    for k in range(1, -(-left // size) + 1):  # to the k-th block behind: its tail, as far as it is within reach
        tail = F.slice("samples", F.greatest(F.size("samples") - (left - (k - 1) * size) + 1, F.lit(1)), F.lit(size))
        sent.append(blocks.where(F.col("first") + k * size < F.col("n")).select("clip_id", (F.col("block") + k).alias("block"), F.lit(-k).alias("way"), tail.alias("samples")))
    for k in range(1, -(-right // size) + 1):
        head = F.slice("samples", 1, min(size, right - (k - 1) * size))
        sent.append(blocks.where(F.col("block") >= k).select("clip_id", (F.col("block") - k).alias("block"), F.lit(k).alias("way"), head.alias("samples")))
    every = own
    for rows in sent:
        every = every.unionByName(rows, allowMissingColumns=True)
    whole = {c: F.max(F.when(F.col("way") == 0, F.col(c))).alias(c) for c in ("rate", "n", "first", "samples")}
    sides = {name: F.array_sort(F.collect_list(F.when(F.col("way") * sign > 0, F.struct("way", "samples")))) for name, sign in (("before", -1), ("after", 1))}
    met = every.groupBy("clip_id", "block").agg(*whole.values(), *(c.alias(name) for name, c in sides.items()))
    # the farthest block before has the least way, the farthest behind the greatest
    return met.select("clip_id", "rate", "n", "block", "first", "samples", *(F.coalesce(F.flatten(F.transform(s, lambda x: x["samples"])), none).alias(s) for s in ("before", "after")))


def _made(blocks: DataFrame, fn: Callable[[dict], np.ndarray]) -> DataFrame:
    """``fn`` of every block's row (arrays as NumPy) as its new samples."""
    arrays = [f.name for f in blocks.schema.fields if f.dataType.simpleString().startswith("array")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            made = []
            for i in range(batch.num_rows):
                made.append(fn({c: v[i].values.to_numpy(zero_copy_only=False) if c in arrays else v[i].as_py() for c, v in columns.items()}))
            at = pa.array(np.r_[0, np.cumsum([len(m) for m in made])], pa.int32())
            samples = pa.ListArray.from_arrays(at, pa.array(np.concatenate([*made, np.zeros(0)])))
            yield pa.RecordBatch.from_arrays([columns["clip_id"], columns["rate"], columns["block"], samples], ["clip_id", "rate", "block", "samples"])

    return blocks.mapInArrow(run, MADE.format(id=blocks.schema["clip_id"].dataType.simpleString()))


def resample_blocks(blocks: DataFrame, to_rate: int, zeros: int = RESAMPLE_ZEROS, size: int = BLOCK, most_rate: int | None = None) -> DataFrame:
    """R10 by blocks. The halo is what the filter of the highest rate reaches (found by an aggregate unless ``most_rate`` is given)."""
    most = most_rate or blocks.agg(F.max("rate")).first()[0] or to_rate
    side = max(polyphase.reach(most, to_rate, zeros), polyphase.reach(1, 1, zeros))

    def fn(r: dict) -> np.ndarray:
        if r["rate"] == to_rate:
            return r["samples"]
        near = np.concatenate([r["before"], r["samples"], r["after"]])
        return polyphase.resampled(near, r["first"] - len(r["before"]), r["n"], r["first"], r["first"] + len(r["samples"]), r["rate"], to_rate, zeros)

    return _made(with_halo(blocks, side, side, size), fn)


def change_speed_blocks(blocks: DataFrame, factor: float, size: int = BLOCK) -> DataFrame:
    """R8 by blocks: a block makes the points whose left neighbour it holds; the right one may be the next block's first sample."""
    f = min(max(float(factor), SPEED_MIN), SPEED_MAX)

    def fn(r: dict) -> np.ndarray:
        n, first, x = r["n"], r["first"], np.concatenate([r["samples"], r["after"]])
        m, own = int(np.floor(n / f)), len(r["samples"])
        if factor == 1.0 or m == n or m <= 0 or n == 0:
            return r["samples"]
        if m == 1:
            return r["samples"][:1] if first == 0 else np.zeros(0)
        step = (n - 1) / (m - 1)
        i = np.arange(max(int(first / step) - 2, 0) if step else 0, min(int((first + own) / step) + 3, m) if step else m)
        xi = i * step
        lo = np.minimum(np.floor(xi).astype(np.int64), n - 1)
        mine = (lo >= first) & (lo < first + own)
        lo, xi = lo[mine], xi[mine]
        y0, y1 = x[lo - first], x[np.minimum(lo + 1, n - 1) - first]
        return y0 + (xi - lo) * (y1 - y0)

    return _made(with_halo(blocks, 0, 1, size), fn)


def trim_tail_blocks(blocks: DataFrame, threshold: float = TRIM_THRESHOLD, hold: float = TRIM_HOLD_SEC, rate: int | None = OUTPUT_RATE) -> DataFrame:
    """R7 by blocks: the last loud sample of a clip is the greatest of its blocks'; blocks behind the cut go. ``rate=None`` takes the clip's own."""
    n = F.size("samples")
    loud = F.array_max(F.transform("samples", lambda v, i: F.when(F.abs(v) > threshold, i).otherwise(F.lit(-1))))
    last = blocks.select("clip_id", F.when(loud >= 0, F.col("first") + loud).alias("at")).groupBy("clip_id").agg(F.max("at").alias("last"))
    held = F.floor((F.lit(rate) if rate else F.col("rate")) * hold)
    keep = F.coalesce(F.least(F.col("last") + held, F.col("n")), F.col("n"))
    cut = blocks.join(last, "clip_id").withColumn("keep", (keep - F.col("first")).cast("long"))
    kept = cut.where((F.col("keep") > 0) | (F.col("block") == 0))
    return kept.select("clip_id", "rate", "block", F.when(F.col("keep") < n, F.slice("samples", F.lit(1), F.greatest(F.col("keep"), F.lit(0)).cast("int"))).otherwise(F.col("samples")).alias("samples"))

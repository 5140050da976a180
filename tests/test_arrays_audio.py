import math

import numpy as np
from pyspark.sql import functions as F

from sorigil.functions import arrays, audio
from sorigil.operators.blocks import change_speed_blocks, resample_blocks, split_clips, trim_tail_blocks


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_truncate_pad(spark):
    rows = [([1, 2, 3], 5), ([1, 2, 3], 2), ([], 3), ([4], 0)]
    got = _one(spark, arrays.truncate_pad("x", F.col("n"), 0), rows, "x array<int>, n int")
    assert got == [[1, 2, 3, 0, 0], [1, 2], [0, 0, 0], []]
    got2 = _one(spark, arrays.truncate_pad_2d("x", F.col("n"), 2, 9), [([[1, 2]], 3), ([[1, 2], [3, 4]], 1)], "x array<array<int>>, n int")
    assert got2 == [[[1, 2], [9, 9], [9, 9]], [[1, 2]]]


def test_masks_and_positions(spark):
    got = _one(spark, arrays.padding_mask("x", 0), [([5, 0, 7],)], "x array<int>")
    assert got == [[True, False, True]]  # a real token equal to pad is masked too
    assert _one(spark, arrays.positions(F.col("n")), [(0,), (3,)], "n int") == [[], [0, 1, 2]]
    assert _one(spark, arrays.attention_mask("x"), [([5, 6],)], "x array<int>") == [[1, 1]]


def _trim_np(x, thr, sr, hold):
    idx = np.where(np.abs(x) > thr)[0]
    if len(idx) == 0:
        return x
    end = min(idx[-1] + int(sr * hold), len(x))
    return x[:end]


def test_trim_tail_matches_numpy(spark):
    rng = np.random.default_rng(1)
    clips = [rng.normal(0, 0.3, 50).tolist() for _ in range(20)] + [[0.0] * 10, [0.0] * 9 + [0.9], []]
    got = _one(spark, audio.trim_tail("x", 0.5, 8, 0.5), [(c,) for c in clips], "x array<double>")
    for c, g in zip(clips, got):
        assert np.allclose(_trim_np(np.array(c), 0.5, 8, 0.5), g)


def _speed_np(x, f):
    if f == 1.0:
        return x
    f = max(0.1, min(f, 5.0))
    n = len(x)
    m = int(n / f)
    if m != n and m > 0:
        return np.interp(np.linspace(0, n - 1, m), np.arange(n), x)
    return x


def test_change_speed_matches_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.normal(0, 1, 40).tolist(), f) for f in (0.0, 0.5, 0.94, 1.0, 1.3, 10.0, 39.0)]
    got = _one(spark, audio.change_speed("x", F.col("f")), rows, "x array<double>, f double")
    for (x, f), g in zip(rows, got):
        assert np.allclose(_speed_np(np.array(x), f), g, atol=1e-12)


def _resample_np(x, fr, to, zeros=16):
    cut = min(1.0, to / fr)
    half = zeros / cut
    k = np.arange(len(x))
    out = []
    for j in range(int(np.ceil(len(x) * to / fr))):
        d = j * fr / to - k
        out.append((x * cut * np.sinc(cut * d) * (0.5 + 0.5 * np.cos(np.pi * d / half)) * (np.abs(d) <= half)).sum())
    return np.array(out)


def test_resample_keeps_low_tones_and_removes_those_above_the_new_limit(spark):
    t = np.arange(400) / 400
    low, high = np.sin(2 * np.pi * 20 * t), np.sin(2 * np.pi * 170 * t)
    rows = [(low.tolist(),), (high.tolist(),), ([],), ([1.0],)]
    down = _one(spark, audio.resample("x", 400, 200), rows, "x array<double>")
    for x, g in zip((low, high), down):
        assert np.allclose(g, _resample_np(x, 400, 200), atol=1e-9)
    inner = slice(40, 160)
    assert np.abs(np.array(down[0])[inner] - np.sin(2 * np.pi * 20 * np.arange(200) / 200)[inner]).max() < 0.01
    assert np.abs(np.array(down[1])[inner]).max() < 0.01  # 170 Hz is above the new limit of 100 Hz
    assert down[2] == [] and len(down[3]) == 1
    up = _one(spark, audio.resample("x", 400, 600), rows[:1], "x array<double>")[0]
    assert len(up) == 600 and np.abs(np.array(up)[60:500] - np.sin(2 * np.pi * 20 * np.arange(600) / 600)[60:500]).max() < 0.01


def test_clip_amplitude(spark):
    assert _one(spark, audio.clip_amplitude("x"), [([-3.0, 0.2, 1.5],)], "x array<double>") == [[-1.0, 0.2, 1.0]]


def test_decibels(spark):
    x = [0.0, 1e-6, 0.5, 2.0]
    got = _one(spark, audio.power_to_db("x"), [(x,)], "x array<double>")[0]
    ref = 10 * np.log10(2.0)
    exp = np.maximum(10 * np.log10(np.maximum(1e-10, np.array(x))) - ref, (10 * np.log10(np.maximum(1e-10, np.array(x))) - ref).max() - 80)
    assert np.allclose(got, exp)
    back = _one(spark, audio.db_to_power("x"), [([0.0, 10.0],)], "x array<double>")[0]
    assert np.allclose(back, [1.0, 10.0])


def test_to_mono(spark):
    got = _one(spark, arrays.to_mono("c"), [([[1.0, 3.0], [3.0, 5.0]],)], "c array<array<double>>")
    assert got == [[2.0, 4.0]]
    assert math.isclose(_one(spark, audio.duration("x", 4), [([0.0] * 10,)], "x array<double>")[0], 2.5)


def test_repeat_rows_and_every_kth(spark):
    """repeat_interleave(2) then [::2] gives the batch back in order."""
    from sorigil.operators import batching

    df = spark.createDataFrame([(s, f"r{s}") for s in range(5)], "slot long, v string")
    doubled = batching.repeat_rows(df, "slot", 2)
    got = sorted((r["slot_k"], r["v"], r["copy"]) for r in doubled.collect())
    assert got == [(2 * s + c, f"r{s}", c) for s in range(5) for c in range(2)]
    back = sorted((r["slot_k"], r["v"]) for r in batching.every_kth(doubled, 2).collect())
    assert [v for _, v in back] == [f"r{s}" for s in range(5)]


def test_select_shape_and_clip_filename(spark):
    """The first of a list of candidate clips; P3: zero-padded 0-based names."""
    from sorigil.functions.text import clip_filename

    got = _one(spark, arrays.select_shape("x"), [([[0.5, -0.5], [9.0]],), ([],)], "x array<array<double>>")
    assert got == [[0.5, -0.5], None]
    names = _one(spark, clip_filename("i"), [(0,), (41,), (1234567,)], "i long")
    assert names == ["zeroth_000000.wav", "zeroth_000041.wav", "zeroth_1234567.wav"]


def _log_features_np(x, sr, n_fft, hop, n_mels):
    from sorigil.functions.audio import AMIN_POWER, TOP_DB
    from sorigil.operators.spectral import ZSCORE_EPS, hann, mel_filters

    p = np.concatenate([np.zeros(n_fft // 2), x, np.zeros(n_fft // 2)])
    n_frames = (len(p) - n_fft) // hop + 1
    fr = np.stack([p[f * hop : f * hop + n_fft] for f in range(n_frames)])
    power = np.abs(np.fft.rfft(fr * hann(n_fft), axis=1)) ** 2
    if n_mels:
        power = power @ mel_filters(float(sr), n_fft, n_mels).T
    db = 10 * np.log10(np.maximum(AMIN_POWER, power)) - 10 * np.log10(max(AMIN_POWER, power.max()))
    db = np.maximum(db, -TOP_DB)
    return (db - db.mean()) / (db.std() + ZSCORE_EPS)


def test_log_features_match_numpy_with_a_long_clip(spark):
    """A clip of about 5,000 frames spans two frame blocks of the partitioning."""
    from sorigil.operators import spectral

    rng = np.random.default_rng(4)
    clips = [(0, rng.normal(0, 0.3, 20_000).tolist(), 16), (1, rng.uniform(-1, 1, 37).tolist(), 32), (2, [0.0] * 40, 16)]
    df = spark.createDataFrame(
        [(i, {"array": x, "sampling_rate": sr}) for i, x, sr in clips], "clip_id long, audio struct<array:array<double>,sampling_rate:int>"
    )
    for n_mels in (None, 4):
        got = {}
        for r in spectral.log_features(df, 16, 4, n_mels).collect():
            got.setdefault(r["clip_id"], {})[r["frame_idx"]] = r["features"]
        for i, x, sr in clips:
            want = _log_features_np(np.array(x), sr, 16, 4, n_mels)
            have = np.array([got[i][f] for f in range(len(want))])
            assert len(got[i]) == len(want) and np.allclose(have, want, atol=1e-9)


def test_frames_of_long_clips_are_made_from_stretches(spark):
    from sorigil.operators import spectral

    rng = np.random.default_rng(4)
    clips = [(1, rng.normal(size=5000).tolist()), (2, [0.5]), (3, []), (4, rng.normal(size=64).tolist())]
    df = spark.createDataFrame([(i, (x, 16)) for i, x in clips], "clip_id long, audio struct<array:array<double>,sampling_rate:int>")
    got = {}
    for r in spectral.frame_rows(df, 16, 4, block=10).collect():
        got[(r["clip_id"], r["frame_idx"])] = r["frame"]
    want = {}
    for i, x in clips:
        p = [0.0] * 8 + x + [0.0] * 8
        want |= {(i, f): p[f * 4 : f * 4 + 16] for f in range((len(p) - 16) // 4 + 1)}
    assert got == want


def _clips(spark, rows):
    return spark.createDataFrame([(i, x, r) for i, (x, r) in enumerate(rows)], "clip_id long, x array<double>, r int").select("clip_id", F.struct(F.col("x").alias("array"), F.col("r").alias("sampling_rate")).alias("audio"))


def _joined(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["block"]):
        out.setdefault(r["clip_id"], []).extend(r["samples"])
    return out


def test_blocks_of_long_clips_equal_the_one_row_forms(spark):
    rng = np.random.default_rng(3)
    rates = [44100, 16000, 22050, 48000, 11025]
    rows = [(rng.uniform(-1, 1, n).tolist(), rates[i % 5]) for i, n in enumerate([0, 1, 2, 99, 100, 101, 1000, 2503, 4096])]
    rows += [([0.9] * 50 + [0.0] * 3000, 16000), ([0.0] * 700, 48000), (None, 16000)]
    clips = _clips(spark, rows)
    for size in (100, 4096):
        blocks = split_clips(clips, size)
        assert blocks.where(F.size("samples") > size).isEmpty()
        for got, col in (
            (change_speed_blocks(blocks, 0.7, size), audio.change_speed("audio.array", 0.7)),
            (change_speed_blocks(blocks, 3.3, size), audio.change_speed("audio.array", 3.3)),
            (trim_tail_blocks(blocks, 0.5, 0.01, None), audio.trim_tail("audio.array", 0.5, F.col("audio.sampling_rate"), 0.01)),
            (resample_blocks(blocks, 22050, size=size), audio.resample("audio.array", F.col("audio.sampling_rate"), 22050)),
        ):
            want = {r["clip_id"]: r["y"] for r in clips.select("clip_id", col.alias("y")).collect() if r["y"] is not None}
            got = _joined(got)
            assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], rtol=0, atol=1e-12) and len(got[i]) == len(want[i]) for i in want)
    wide = split_clips(clips, 20)  # a halo that reaches over several blocks
    want = {r["clip_id"]: r["y"] for r in clips.select("clip_id", audio.resample("audio.array", F.col("audio.sampling_rate"), 8000).alias("y")).collect()}
    got = _joined(resample_blocks(wide, 8000, size=20))
    assert all(np.allclose(got[i], want[i], rtol=0, atol=1e-12) for i in got) and len(got) == 11


def test_an_hour_runs_in_many_tasks(spark):
    """A clip that is written by block: no row holds more than a block, and its blocks are spread over the tasks."""
    size, n = 1 << 14, 3600 * 2000
    blocks = spark.range(0, -(-n // size)).select(
        F.lit(1).cast("long").alias("clip_id"), F.lit(2000).alias("rate"), F.lit(n).cast("long").alias("n"), F.col("id").cast("int").alias("block"), (F.col("id") * size).alias("first"),
        F.transform(F.sequence(F.col("id") * size, F.least((F.col("id") + 1) * size, F.lit(n)) - 1), lambda i: F.sin(i * 0.05)).alias("samples"),
    )
    out = resample_blocks(blocks, 1000, size=size).select("block", F.size("samples").alias("k"), F.spark_partition_id().alias("task")).collect()
    assert sum(r["k"] for r in out) == n // 2 and len({r["task"] for r in out}) > 4
    assert max(r["k"] for r in out) <= size


def test_resample_of_null_clips_and_odd_ratios(spark):
    rows = [(None, 16000), ([1.0, 2.0, 3.0], None), ([0.5] * 40, 44101)]
    got = [r["y"] for r in _clips(spark, rows).select(audio.resample("audio.array", F.col("audio.sampling_rate"), 16000).alias("y")).collect()]
    assert got[0] is None and got[1] is None and np.allclose(got[2], _resample_np(np.array([0.5] * 40), 44101, 16000), atol=1e-9)


def test_join_ints_makes_no_string_per_element(spark):
    df = spark.createDataFrame([([1, -2, 300],), ([],), (None,), ([None],), ([None, 5, None, 7],), ([2**31 - 1],)], "x array<int>")
    got = df.select(arrays.join_ints("x").alias("a"), arrays.join_ints("x", " | ").alias("b"), arrays.join_ints(F.col("x").cast("array<bigint>")).alias("c"))
    want = [("1,-2,300", "1 | -2 | 300"), ("", ""), (None, None), ("", ""), ("5,7", "5 | 7"), ("2147483647", "2147483647")]
    assert [tuple(r) for r in got.collect()] == [(a, b, a) for a, b in want]
    long = spark.range(1, numPartitions=1).select(F.transform(F.sequence(F.lit(1), F.lit(3_000_000)), lambda i: i % 256).alias("x")).cache()
    assert long.select(F.length(arrays.join_ints("x")).alias("n")).collect()[0].n == sum(len(str(i % 256)) + 1 for i in range(1, 3_000_001)) - 1
    jvm = spark._jvm.java.lang
    threads = jvm.management.ManagementFactory.getPlatformMXBean(jvm.Class.forName("com.sun.management.ThreadMXBean"))

    def heap_bytes(column):
        before = {i: threads.getThreadAllocatedBytes(i) for i in threads.getAllThreadIds()}
        long.select(F.length(column)).collect()
        return sum(max(0, threads.getThreadAllocatedBytes(i) - before.get(i, 0)) for i in threads.getAllThreadIds())

    forms = [F.size("x").cast("string"), arrays.join_ints("x"), F.array_join("x", ",")]
    least, new, strings = [min(heap_bytes(f) for _ in range(3)) for f in forms]
    long.unpersist()
    assert new - least < 0.75 * (strings - least), (least, new, strings)

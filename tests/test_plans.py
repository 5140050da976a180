import os

from pyspark.sql import functions as F

from sorigil.plans.corpus import build_trainset, prepare_corpus, training_batches


def _sources(tmp):
    srcs = []
    for name, n in (("first", 3), ("second", 2)):
        d = os.path.join(tmp, name)
        os.makedirs(os.path.join(d, "wavs"))
        with open(os.path.join(d, "metadata.csv"), "w", encoding="utf-8") as f:
            f.write("filename|text\n")
            for i in range(n):
                fn = f"{name}_{i:06d}.wav"
                f.write(f"{fn}|가나 {i}\n")
                if i != 1:
                    open(os.path.join(d, "wavs", fn), "wb").write(b"RIFF")
        srcs.append((name, d, os.path.join(d, "metadata.csv")))
    return srcs


def test_corpus_and_trainset(spark, tmp):
    srcs = _sources(tmp)
    out = os.path.join(tmp, "prep")
    prepare_corpus(spark, srcs, out)
    lines = sorted(r[0] for r in spark.read.text(f"{out}/all_jamo").collect())
    assert lines == sorted(["ㄱㅏㄴㅏ 0", "ㄱㅏㄴㅏ 1", "ㄱㅏㄴㅏ 2", "ㄱㅏㄴㅏ 0", "ㄱㅏㄴㅏ 1"])
    jamo_srcs = []
    for name, d, _ in srcs:
        p = os.path.join(d, "metadata_jamo.csv")
        rows = spark.read.option("sep", "|").option("header", True).csv(f"{out}/metadata_jamo/source={name}").orderBy("filename").collect()
        with open(p, "w", encoding="utf-8") as f:
            f.write("filename|text|jamo\n")
            for r in rows:
                f.write(f"{r['filename']}|{r['text']}|{r['jamo']}\n")
        jamo_srcs.append((name, d, p))
    codes = spark.createDataFrame(
        [(os.path.join(tmp, "first", "wavs", "first_000000.wav"), [[1, 2], [3, 4]]), (os.path.join(tmp, "second", "wavs", "second_000000.wav"), [[5, 6]])],
        "full_path string, audio_tokens array<array<int>>",
    )
    processed, rejects, progress = build_trainset(spark, jamo_srcs, tmp, codes, os.path.join(tmp, "processed"), batch_size=2)
    assert processed.columns == ["text_tokens", "audio_tokens", "original_indices"]  # P5: raw columns dropped
    got = sorted((r["original_indices"], len(r["text_tokens"])) for r in processed.collect())
    # kept rows in order: first_0, first_2, second_0 -> positions 0, 1, 2; first_2 has no codes
    assert [g[0] for g in got] == [0, 2]
    assert [r["reason"] for r in rejects.collect()] == ["audio_tokens failed"]
    prog = sorted((r["batch_id"], r["batch_end"], r["valid_so_far"]) for r in progress.collect())
    assert prog == [(0, 2, 1), (1, 3, 2)]
    b = training_batches(processed, epochs=2, batch_size=2, text_length=8, audio_length=4, channels=2).collect()
    assert len(b) == 4 and all(len(r["text_padded"]) == r["text_len"] for r in b)


def test_trainset_positions_brute_force(spark):
    """Positions by (file number, file name) inside a data set, data sets in order;
    equal file numbers (files in several folders) are ordered by name."""
    import random

    from sorigil.plans.corpus import trainset_positions

    rng = random.Random(5)
    rows = []
    for src, o, n in (("first", 0, 300), ("second", 1, 40), ("empty", 2, 0), ("x", 3, 7)):
        for i in range(n):
            num = rng.randint(0, 9000)
            rows.append((src, o, f"{rng.randint(1, 4)}/{rng.randint(1, 4)}_{num:04d}.wav"))
    rows = list({r[2] + r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "source string, source_ord int, filename string")
    got = {(r["source"], r["filename"]): (r["row_idx"], r["pos"]) for r in trainset_positions(df).collect()}
    pos = 0
    for src in ("first", "second", "x"):
        mine = sorted((int(f.split("_")[1][:4]), f) for s, _, f in rows if s == src)
        for i, (_, f) in enumerate(mine):
            assert got[(src, f)] == (i, pos)
            pos += 1
    assert len(got) == pos


def test_files_without_a_number(spark):
    from sorigil.plans.corpus import trainset_positions

    names = ["intro.wav", "99999999999999999999999.wav", "b_2.wav", "a_10.wav", "outro.wav"]
    df = spark.createDataFrame([("s", 0, n) for n in names], "source string, source_ord int, filename string")
    got = {r["filename"]: r["pos"] for r in trainset_positions(df).collect()}
    assert got == {"99999999999999999999999.wav": 0, "intro.wav": 1, "outro.wav": 2, "b_2.wav": 3, "a_10.wav": 4}


def test_feature_table_rows_are_blocks_of_frames(spark):
    """A long clip comes in blocks, in order; short, empty and text-less clips have a defined row."""
    import math

    from pyspark.sql import functions as F

    from sorigil.operators import spectral
    from sorigil.plans.features import feature_table

    rows = [(1, [math.sin(i * 0.3) for i in range(4000)], 16), (2, [0.5] * 20, 16), (3, None, 16), (4, [0.1] * 30, 32), (5, [], 16)]
    clips = spark.createDataFrame(rows, "clip_id long, x array<double>, r int").select("clip_id", F.struct(F.col("x").alias("array"), F.col("r").alias("sampling_rate")).alias("audio"))
    texts = spark.createDataFrame([(1, "ㄱㅏ ㄱ"), (2, None), (4, ""), (9, "ㄱ")], "clip_id long, jamo string")
    vocab = spark.createDataFrame([(4, "▁", -1.0), (5, "ㄱ", -2.0), (6, "ㅏ", -2.0), (7, "▁ㄱㅏ", -1.5)], "id int, piece string, score double")
    got = {(r["clip_id"], r["block"]): r for r in feature_table(clips, texts, vocab, 16, 4, 4, block_frames=100).collect()}
    frames = {}
    for r in sorted(spectral.log_features(clips, 16, 4, 4).collect(), key=lambda r: r["frame_idx"]):
        frames.setdefault(r["clip_id"], []).append(r["features"])
    assert sorted(got) == [*((1, b) for b in range(11)), (2, 0), (3, 0), (4, 0), (5, 0)]
    for i, want in frames.items():
        mine = [got[i, b] for b in range(got[i, 0]["n_blocks"])]
        assert [f for r in mine for f in r["features"]] == want and all(len(r["features"]) <= 100 and r["n_frames"] == len(want) for r in mine)
    assert got[1, 0]["input_ids"] == [7, 4, 5] and got[1, 0]["attention_mask"] == [1, 1, 1] and got[1, 1]["input_ids"] is None
    assert got[2, 0]["input_ids"] == got[4, 0]["input_ids"] == [] and got[3, 0]["input_ids"] is None
    assert got[3, 0]["features"] is None and got[3, 0]["n_frames"] == 0

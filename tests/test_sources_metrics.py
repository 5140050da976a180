import os

import pytest
from pyspark.sql import functions as F

from sorigil.operators import listing, metrics
from sorigil.sources import metadata as M


def test_metadata_round_trip(spark, tmp):
    rows = [("a.wav", "하나|둘", "ㅎㅏㄴㅏ|ㄷㅜㄹ"), ("b.wav", "줄\n바꿈", "ㅈㅜㄹ\nㅂㅏㄲㅜㅁ"), ("c.wav", None, None)]
    df = spark.createDataFrame(rows, "filename string, text string, jamo string")
    path = os.path.join(tmp, "meta")
    M.write_metadata(df, path, with_jamo=True)
    back = M.read_metadata(spark, path, with_jamo=True).orderBy("filename").collect()
    assert [(r["filename"], r["text"], r["jamo"]) for r in back] == rows
    assert all(r["_bad"] is None for r in back)


def test_malformed_row_set_aside(spark, tmp):
    p = os.path.join(tmp, "m.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("filename|text\nx.wav|hello\ny.wav|a|b\n")
    rows = M.read_metadata(spark, p).collect()
    assert rows[0]["text"] == "hello" and rows[0]["_bad"] is None
    assert rows[1]["_bad"] == "y.wav|a|b"


def test_sources_listing_and_concat(spark, tmp):
    for name, files in (("first", ["1.wav", "2.wav"]), ("second", ["second_000000.wav"])):
        os.makedirs(os.path.join(tmp, name, "wavs"))
        for fn in files:
            open(os.path.join(tmp, name, "wavs", fn), "wb").write(b"RIFF")
        with open(os.path.join(tmp, name, "metadata.csv"), "w", encoding="utf-8") as f:
            f.write("filename|text|jamo\n")
            for fn in files + ["missing.wav"]:
                f.write(f"{fn}|가|ㄱㅏ\n")
    srcs = [(n, os.path.join(tmp, n), os.path.join(tmp, n, "metadata.csv")) for n in ("first", "absent", "second")]
    meta = M.load_sources(spark, srcs)
    listing_df = M.list_audio(spark, tmp)
    assert listing_df.where(F.col("full_path").endswith(".wav")).count() == 3
    kept = listing.with_audio(meta, listing_df)
    assert kept.count() == 3
    counts = {r["source"]: (r["n_before"], r["n_after"]) for r in listing.source_counts(meta, listing_df).collect()}
    assert counts == {"first": (3, 2), "second": (2, 1), None: (5, 3)}
    assert {r["source_ord"] for r in meta.collect()} == {0, 2}
    with pytest.raises(ValueError):
        M.load_sources(spark, [("x", tmp, os.path.join(tmp, "nope.csv"))])
    with pytest.raises(ValueError):
        M.select_sources(meta, [])


def test_corpus_processed_and_vocab_files(spark, tmp):
    df = spark.createDataFrame([("ㄱㅏ\nㄴㅏ",), (None,), ("ㄷ",)], "jamo string")
    M.write_corpus(df, os.path.join(tmp, "corpus"))
    lines = sorted(r[0] for r in spark.read.text(os.path.join(tmp, "corpus")).collect())
    assert lines == ["ㄱㅏ ㄴㅏ", "ㄷ"]
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([([1, 2], [[3, 4]], 0)], M.PROCESSED_SCHEMA)

    p = os.path.join(tmp, "processed")
    a = M.processed_or_build(spark, p, build).collect()
    b = M.processed_or_build(spark, p, build).collect()
    assert a == b and len(built) == 1
    v = spark.createDataFrame([(0, "<pad>", 0.0), (1, "<unk>", 0.0), (4, "ㄱ", -1.5), (5, "▁ㄴ", -2.25)], M.VOCAB_SCHEMA)
    M.write_vocab(v, os.path.join(tmp, "v.tsv"), fmt="tsv")
    back = M.read_vocab(spark, os.path.join(tmp, "v.tsv"), fmt="tsv").orderBy("id").collect()
    assert [(r["piece"], r["score"]) for r in back] == [("<pad>", 0.0), ("<unk>", 0.0), ("ㄱ", -1.5), ("▁ㄴ", -2.25)]
    assert [r["id"] for r in back] == [0, 1, 2, 3]


def test_channel_loss_all_pad_channel(spark):
    rows = []
    for t in range(3):
        rows.append((0, t, 0, [0.0, 1.0, 2.0], 1))
        rows.append((0, t, 1, [0.0, 0.0, 0.0], 2))  # every target is pad 2
    lg = spark.createDataFrame(rows, "seq_id long, t int, channel int, logits array<double>, label int")
    pairs = metrics.next_token_pairs(lg).withColumn("batch_id", F.lit(0))
    per_ch, per_batch = metrics.channel_loss(pairs, 2)
    ch = {r["channel"]: r["loss"] for r in per_ch.collect()}
    assert ch[1] is None
    import math

    lse = math.log(math.exp(0) + math.exp(1) + math.exp(2))
    b = per_batch.collect()[0]
    assert math.isclose(b["loss"], lse - 1.0) and b["n_channels"] == 1


def test_losses_of_split_score_vectors_equal_the_whole_ones(spark):
    import random

    rng = random.Random(2)
    rows = [(0, s, t, c, [rng.choice([-700.0, 0.0, 3.5, 800.0]) + rng.random() for _ in range(11)], rng.randrange(11)) for s in range(4) for t in range(5) for c in range(2)]
    pairs = spark.createDataFrame(rows, "batch_id long, seq_id long, t int, channel int, logits array<double>, target int")
    want = [metrics.channel_loss(pairs, 3)[k].collect() for k in (0, 1)]
    for size in (1, 4, 11, 50):
        blocks = metrics.score_blocks(pairs, size).repartition(7)  # blocks of a step in different tasks
        got = [d.collect() for d in metrics.channel_loss_of_blocks(blocks, 3)]
        for a, b, key in zip(got, want, ("channel", "batch_id")):
            a, b = ({r[key]: (r["loss"], r["n_tokens"]) for r in x} for x in (a, b))
            assert a.keys() == b.keys() and all(a[k][1] == b[k][1] and a[k][0] == pytest.approx(b[k][0], rel=1e-12) for k in a)
    lost = metrics.step_losses(metrics.score_blocks(pairs, 4).where("first <> 8"), ["seq_id", "t", "channel"])
    assert all((r["ce"] is None) == (r["target"] >= 8) for r in lost.collect())


def test_step_counters(spark):
    rows = [(i, i * 1_000_000, 0 if i < 23 else 1, float(i)) for i in range(30)]
    log = spark.createDataFrame(rows, "event_id long, ts_us long, epoch int, loss double")
    st = metrics.step_counters(metrics.step_index(log)).orderBy("epoch", "step").collect()
    assert [(r["epoch"], r["step"], r["epoch_opt_step"], r["global_opt_step"]) for r in st] == [(0, 9, 2, 2), (0, 19, 5, 5)]
    em = {r["epoch"]: r for r in metrics.epoch_metrics(log).collect()}
    assert em[0]["n_steps"] == 23 and em[0]["pending"] == 3 and em[1]["optimizer_steps"] == 1


def test_speech_table_round_trip(spark, tmp):
    """S3: nested audio struct read back with the declared schema."""
    rows = [({"array": [0.0, 0.25, -1.0], "sampling_rate": 16000}, "가"), ({"array": [], "sampling_rate": 44100}, "")]
    path = os.path.join(tmp, "speech")
    spark.createDataFrame(rows, M.SPEECH_SCHEMA).write.parquet(path)
    back = M.read_speech_table(spark, path)
    assert back.schema == M.SPEECH_SCHEMA
    got = sorted((r["text"], list(r["audio"]["array"]), r["audio"]["sampling_rate"]) for r in back.collect())
    assert got == [("", [], 44100), ("가", [0.0, 0.25, -1.0], 16000)]
    assert back.where(M.needs_resample("audio", 16000)).count() == 1


def test_reader_keeps_rows_around_odd_lines(spark, tmp):
    """An unclosed quote, a carriage return, a wrong number of fields, an empty and a missing text."""
    path = os.path.join(tmp, "metadata.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write('filename|text\r\n1.wav|"open quote\n2.wav|say "hi"\n3.wav|a|b\nno separator\n4.wav|\n\n5.wav|""\n6.wav|"x|y"\n7.wav|C:\\new\n')
    meta = M.read_metadata(spark, path)
    got = {r["filename"]: r["text"] for r in meta.where("_bad is null").collect()}
    assert got == {"1.wav": '"open quote', "2.wav": 'say "hi"', "4.wav": None, "5.wav": "", "6.wav": "x|y", "7.wav": "C:\\new"}
    assert sorted(r["line"] for r in M.rejected(meta).collect()) == ["3.wav|a|b", "no separator"]


def test_written_metadata_reads_back_in_batch_and_stream(spark, tmp):
    from sorigil.streaming.ingest import metadata_stream

    rows = [("a|b.wav", 'q"uo"te'), ("b.wav", "line\nbreak\r\n"), ("c.wav", ""), ("d.wav", None), ("e.wav", "back\\nslash \\\\"), ("f.wav", '"'), ("g.wav", " \\ "), ("h.wav", '"whole"')]
    path = os.path.join(tmp, "meta")
    M.write_metadata(spark.createDataFrame(rows, "filename string, text string"), path)
    assert sorted((r["filename"], r["text"]) for r in M.read_metadata(spark, path).collect()) == sorted(rows, key=lambda r: r[0])
    query = metadata_stream(spark, path).writeStream.format("memory").queryName("odd_lines").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((r["filename"], r["text"]) for r in spark.table("odd_lines").collect()) == sorted(rows, key=lambda r: r[0])


def test_listing_takes_any_file_type_and_spelling_of_the_path(spark, tmp):
    wavs = os.path.join(tmp, "set", "wavs")
    os.makedirs(wavs)
    for name in ("1.wav", "2.WAV", "3.flac"):
        open(os.path.join(wavs, name), "wb").write(b"x")
    meta = spark.createDataFrame([(n, "t") for n in ("1.wav", "2.WAV", "3.flac", "4.wav")], "filename string, text string")
    from sorigil.operators import listing

    for spelling in (f"{tmp}/set", f"file:{tmp}/set/", f"file://{tmp}//set"):
        rows = M.with_full_path(M.add_source(meta, spelling, "set", 0))
        assert sorted(r["filename"] for r in listing.with_audio(rows, M.list_audio(spark, tmp)).collect()) == ["1.wav", "2.WAV", "3.flac"]
    assert M.list_audio(spark, tmp, "*.wav").count() == 1


def test_a_table_is_built_again_when_unfinished_or_when_its_input_changed(spark, tmp):
    path = os.path.join(tmp, "processed")
    os.makedirs(path)
    open(os.path.join(path, "part-0.parquet.tmp"), "wb").write(b"half")
    made = spark.createDataFrame([([1], [[1]], 0)], M.PROCESSED_SCHEMA)
    two = made.union(made)
    first, second = M.fingerprint(made, limit=3), M.fingerprint(two, limit=3)
    assert first == M.fingerprint(made.repartition(3), limit=3) and len({first, second, M.fingerprint(made, limit=4), M.fingerprint(made.limit(0), limit=3)}) == 4
    assert M.processed_or_build(spark, path, lambda: made, first).count() == 1
    assert M.processed_or_build(spark, path, lambda: 1 / 0, first).count() == 1
    assert M.processed_or_build(spark, path, lambda: 1 / 0).count() == 1
    assert M.processed_or_build(spark, path, lambda: two, second).count() == 2
    with pytest.raises(ZeroDivisionError):  # a build that fails leaves no table that would be read
        M.processed_or_build(spark, path, lambda: 1 / 0, first)
    assert M.read_manifest(spark, path) is None
    assert M.processed_or_build(spark, path, lambda: made, first).count() == 1


def test_every_string_comes_back_from_metadata_files(spark, tmp):
    import random

    rng = random.Random(9)
    parts = [" ", "\t", "|", '"', "\\", "\n", "\r", "\0", "\u0001", "\ue000", "\u2028", "n", "q", "0", "1", "가", "😀", "filename", "text", ""]
    rows = [(f"{i:04d}" + "".join(rng.choices(parts, k=rng.randint(0, 3))), "".join(rng.choices(parts, k=rng.randint(0, 6)))) for i in range(600)]
    rows += [("filename", "text"), ("x ", " y\t"), (None, None), ("filename", None), (None, "text"), ('"', '""'), ("a\u0001b", "\0c\u0001")]
    path = os.path.join(tmp, "odd")
    M.write_metadata(spark.createDataFrame(rows, "filename string, text string"), path)
    back = M.read_metadata(spark, path)
    assert sorted(((r["filename"], r["text"]) for r in back.where("_bad is null").collect()), key=str) == sorted(rows, key=str)
    assert M.rejected(back).count() == 0


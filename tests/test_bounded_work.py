"""Workers hold a run of texts or words, not a batch; an encoding runs once a row; rounds of EM read blocks."""

import math
import os
import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sorigil.functions import jamo as J
from sorigil.operators import batching, encode, lattice, listing, trie, vocab
from sorigil.plans import file_queries
from sorigil.sources import fixtures as fx
from sorigil.sources import metadata as M


def test_texts_are_converted_in_runs():
    texts = ["각a" * 1000, None, "", "나" * 500] * 400 + ["다" * (J.RUN_BYTES // 2)]
    got = list(J.jamo_runs(iter([pa.array(texts, pa.string())])))
    assert len(got) > 2 and max(x.nbytes for x in got[:-1]) <= 4 * J.RUN_BYTES
    assert [t for x in got for t in x.to_pylist()] == [None if t is None else "".join(map(J.decompose_syllable, t)) for t in texts]
    lists = list(J.byte_runs(iter([pa.array(texts, pa.string())])))
    assert len(lists) > 2 and max(x.nbytes for x in lists[:-1]) <= 5 * J.RUN_BYTES
    assert [v for x in lists for v in x.to_pylist()] == [None if t is None else list(t.encode()) for t in texts]


def test_jamo_of_a_run_are_those_of_its_characters():
    edges = [0, 0x7F, 0x80, 0x7FF, 0x800, 0xABFF, 0xAC00, 0xD7A3, 0xD7A4, 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x10FFFF]
    texts = ["".join(map(chr, edges)), None, "", "a\n닭\r값😀"] * 3 + [chr(c) for c in edges] + ["닭a" * J._STEP, None]
    for given in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(3, 9), pa.array([None, None], pa.string()), pa.array([], pa.string())):
        want = [None if t is None else "".join(map(J.decompose_syllable, t)) for t in given.to_pylist()]
        assert [t for x in J.jamo_runs(iter([given])) for t in x.to_pylist()] == want


def test_texts_whose_bytes_are_made(spark):
    df = spark.createDataFrame([("닭a값\n",), ("",), (None,)], "text string")
    got = df.select(J.utf8_tokens(J.jamo("text")).alias("a"), J.utf8_made(J.jamo("text")).alias("made")).collect()
    assert [r["made"] for r in got] == [r["a"] is not None for r in got] == [True, True, False]


def test_a_reader_takes_few_tokens_of_the_processed_table_at_once(spark, tmp):
    tokens = F.transform(F.sequence(F.lit(1), F.when(F.col("id") < 50, 3).otherwise(30_000)), lambda i: (i % 100).cast("int"))
    df = spark.range(0, 400, 1, 1).select(tokens.alias("text_tokens"), F.array(F.array(F.lit(1))).alias("audio_tokens"), F.col("id").alias("original_indices"))
    M.save_processed(df, os.path.join(tmp, "t"))
    files = [pq.ParquetFile(os.path.join(tmp, "t", f)).metadata for f in os.listdir(os.path.join(tmp, "t")) if f.endswith(".parquet")]
    values = [m.row_group(g).column(0).num_values for m in files for g in range(m.num_row_groups)]
    assert sum(values) == 50 * 3 + 350 * 30_000 and max(values) <= (16 << 20) // 4 + 10 * 30_000
    assert M.load_processed(spark, os.path.join(tmp, "t")).agg(F.sum(F.size("text_tokens"))).first()[0] == sum(values)


def test_processed_rows_and_rejects_with_nulls_and_repeats(spark, tmp):
    docs = [(1, "Ab", "s", "s1", 2), (1, "c", "s", "s1", 1), (2, None, "s", "s1", 0), (3, "", "s", "s1", 0), (4, "x", "s", "s1", 1), (None, "y", "s", "s1", 1), (5, None, "s", "s1", 0)]
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    bytes_of = lambda t: ",".join(str(b) for c in t for b in "".join(map(J.decompose_syllable, fx.hangul_of(ord(c)))).encode())
    want = [(1, bytes_of("Ab"), "1,0", ""), (1, bytes_of("c"), "1,0", ""), (3, "", "1", ""), (2, "", "", "text_tokens failed"), (4, "", "", "audio_tokens failed"), (None, "", "", "audio_tokens failed"), (5, "", "", "text_tokens failed,audio_tokens failed")]
    assert sorted(map(repr, map(tuple, file_queries.file_processed(spark, tmp).collect()))) == sorted(map(repr, want))


def _counted(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(t):
        seen.add(1)
        return t

    return seen, same


def test_the_corpus_writer_computes_a_text_once(spark, tmp):
    seen, same = _counted(spark)
    df = spark.createDataFrame([("a\nb",), ("",), (None,)], "text string").select(same("text").alias("jamo"))
    M.write_corpus(df, os.path.join(tmp, "corpus"))
    assert sorted(r["value"] for r in spark.read.text(os.path.join(tmp, "corpus")).collect()) == ["", "a b"]
    assert seen.value == 3


def test_the_corpus_on_disk_follows_what_its_texts_say(spark, tmp, monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefgh \n") for _ in range(5000)) for _ in range(40)] + ["", None, "a\r\n"]
    rows = [(i, t, "en", "s1", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    monkeypatch.setattr(file_queries, "fresh_folder", lambda _, name: f"{tmp}/{name}")
    got = sorted(r["line"] for r in file_queries.file_corpus(spark, tmp).collect())
    syllables = {c: J.decompose_syllable(fx.hangul_of(ord(c))) for c in "abcdefgh"}
    assert got == sorted(re.sub("[\r\n]+", " ", "".join(syllables.get(c, c) for c in t)) for t in texts if t is not None)
    on_disk = sum(os.path.getsize(f"{tmp}/corpus/{f}") for f in os.listdir(f"{tmp}/corpus"))
    assert on_disk < sum(len(t or "") for t in texts) < sum(len(t.encode()) for t in got) / 5


def test_valid_rows_and_rejects_are_encoded_once(spark):
    seen, same = _counted(spark)
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, None, None)], "k int, t string, c string")
    ok, rejects = listing.keep_valid(df.select("k", same("t").alias("t"), "c"), ("t", "c"))
    assert [r["k"] for r in ok.collect()] == [1] and seen.value == 3
    assert {r["k"]: r["reason"] for r in rejects.collect()} == {2: "t failed", 3: "t failed,c failed"} and seen.value == 6


def test_batches_exchange_heads_and_sizes(spark):
    df = spark.createDataFrame([(0, 0, 0, [1, 2, 3, 4, 5]), (0, 0, 1, [7]), (0, 1, 2, None)], "epoch int, batch_id int, pos int, text_tokens array<int>")
    out = batching.collate_text(df, max_len=3)
    rows = {r["pos"]: r for r in out.collect()}
    assert out.columns == ["epoch", "batch_id", "pos", "text_tokens", "batch_len", "padded", "padding_mask", "attention_mask", "positions"]
    assert rows[0]["padded"] == [1, 2, 3] and len(rows[0]["attention_mask"]) == 5 and rows[0]["text_tokens"] == [1, 2, 3, 4, 5]
    assert rows[1]["padded"] == [7, 0, 0] and rows[1]["positions"] == [0, 1, 2] and rows[2]["padded"] is None
    node = out.select("pos", "padded", "attention_mask")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().apply(0)
    below = node.children().apply(0).output()
    assert "text_tokens" not in {below.apply(i).name() for i in range(below.size())}


def _random_model(rnd):
    letters = "▁ㄱㅏㄴㅎ"
    names = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))) for _ in range(200)} | set(letters))
    scores = np.array([-rnd.uniform(1, 9) for _ in names])
    scores[[len(p) > 1 and rnd.random() < 0.3 for p in names]] = np.nan
    words = ["▁" + "".join(rnd.choice(letters + "x") for _ in range(rnd.randint(0, 30))) for _ in range(500)] + ["▁" + "ㄱㅏ" * 400, ""]
    return names, scores, words


def test_blocks_count_as_flat_edges_do():
    names, scores, words = _random_model(random.Random(5))
    freqs, lengths = np.arange(1.0, len(words) + 1), np.array([len(w) for w in words])
    edges = trie.build(names).lattice(words, 16)
    want_ll, want = lattice.forward_backward(*edges, lengths, freqs, scores, -20.0)
    parts = [lattice.block_counts(b, scores, -20.0) for b in lattice.blocks(*edges, lengths, freqs, 1000)]
    assert len(parts) > 5 and math.isclose(sum(ll for ll, _ in parts), want_ll, rel_tol=1e-9)
    assert np.allclose(sum(c for _, c in parts), want, rtol=1e-9, atol=1e-12)


def test_lattices_are_stored_in_blocks_of_words(spark):
    names, scores, words = _random_model(random.Random(6))
    wc = spark.createDataFrame([(w, 1) for w in sorted(set(words)) if w], "word string, n long").coalesce(1)
    assert vocab.word_lattices(wc, trie.share(spark, names)).count() < 20


def test_words_are_segmented_in_runs(monkeypatch):
    names = ["▁", "ㄱ", "ㅏ", "ㄱㅏ"]
    monkeypatch.setattr(encode, "opened", lambda _: (trie.build(names), np.arange(4, 8), pa.array(names)))
    run = encode._segment_fn(None, SimpleNamespace(value=np.array([-1.0, -2.0, -2.0, -2.5])), 16, -20.0)
    words = ["▁" + "ㄱㅏ" * (i % 30) for i in range(10_000)]
    got = list(run(iter([pa.RecordBatch.from_arrays([pa.array(words)], ["word"])])))
    assert len(got) > 4 and [w for b in got for w in b.column(0).to_pylist()] == words
    assert all(p == ["▁"] + ["ㄱㅏ"] * (i % 30) for i, p in enumerate(p for b in got for p in b.column(1).to_pylist()))

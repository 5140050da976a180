"""FM-index, decontamination and packing against brute force; edge rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sorigil.llm import fm_decontamination as fm
from sorigil.llm import packing
from sorigil.llm.fm_index import FmIndex, suffix_ranks

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_report(docs, items):
    windows = defaultdict(lambda: defaultdict(set))
    for i, t in items:
        w = words(t)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[size][tuple(w[k : k + size])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, found = words(t), set()
        hit = [False] * len(w)
        for size, known in windows.items():
            for k in range(len(w) - size + 1):
                if got := known.get(tuple(w[k : k + size])):
                    found |= got
                    hit[k : k + size] = [True] * size
        n = sum(hit)
        out.append((i, len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 4, rng.integers(1, 400))
    text[rng.random(len(text)) < 0.05] = 0
    if seed == 5:
        text[:] = 1  # one long run
    text = np.r_[text, 0].astype(np.int64)
    index = FmIndex(text, 3, sample=4)
    ranks = suffix_ranks(text)
    assert sorted(ranks) == list(range(len(text)))
    phrases = np.zeros((60, 5), np.int64)
    lengths = rng.integers(0, 6, 60)
    for row, n in zip(phrases, lengths):
        row[5 - n :] = rng.integers(1, 4, n)
    lo, hi = index.search(phrases, lengths)
    for row, n, a, b in zip(phrases, lengths, lo, hi):
        want = [k for k in range(len(text) - n + 1) if n and (text[k : k + n] == row[5 - n :]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_report_matches_brute_force_on_edge_rows(spark):
    item = " ".join(f"w{k}" for k in range(30))
    items = [(1, item), (2, "short é item"), (3, ""), (4, None), (None, " ".join(f"w{k}" for k in range(10, 25))), (1, "other words " * 7), (5, item)]
    docs = [
        (1, f"lead {item} tail"), (2, item.upper().replace(" ", ", ")), (3, None), (4, ""), (5, "!!"), (6, "short"), (7, "x short É item y"), (7, "x short é item y " * 40),
        (None, item), (8, " ".join(["z"] * 700) + " " + item), (9, "other words " * 4000), (10, item.replace("w7 ", "v7 ")), (11, " ".join(["w1"] * 3000)), (1, f"lead {item} tail"),
    ]
    df = spark.createDataFrame([(*d, "f", [1]) for d in docs], "doc_id long, text string, found string, spans array<int>")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_report(docs, items)
    assert order(fm.report(df, bench).collect()) == order(want)
    clean = fm.keep_clean(df, bench)
    assert clean.schema == df.schema
    assert order((r.doc_id, r.text) for r in clean.collect()) == order(d for d, w in zip(docs, want) if not w[5])
    assert fm.report(df.limit(0), bench).collect() == []
    assert all(r.n_hit == 0 and not r.contaminated for r in fm.report(df, bench.limit(0)).collect())


def test_blocks_of_the_benchmark_and_pieces_of_a_long_text_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = plain_report([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert order(fm.report(docs, bench).collect()) == order(want)
    found = fm.find_passages(docs.select("doc_id", "text"), bench, block_bytes=2000)
    assert {r.doc_id: sum(r.found.spans[1::2]) - sum(r.found.spans[::2]) for r in found.collect()} == {w[0]: w[2] for w in want}
    monkeypatch.setattr(fm, "SHARD_WORDS", 40)
    rows = bench.collect()
    phrases = fm.Phrases([str(r.item_id) for r in rows], [r.text for r in rows])
    texts = [r.text for r in docs.collect()]
    n_words, n_hit, _, _ = fm.search_shard(pa.array(texts), phrases)
    assert list(zip(n_words, n_hit)) == [(w[1], w[2]) for w in want]


def test_cut_spans():
    assert fm.cut_spans("a, b c. d", [1, 3]) == "a, . d" and fm.cut_spans(None, []) is None


def check_packing(rows, ids_of, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for (doc, n), pieces in by_doc.items():
        ids = [x for x in ids_of[doc] if len(x) == n][0]
        copies = sum(p.start == 0 for p in pieces)
        assert sum(p.length for p in pieces) == copies * n
        for p in pieces:
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    return len(by_sequence)


def plain_ids(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    out = defaultdict(list)
    for i, t in rows:
        out[i].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    return out


def test_packing_of_the_small_table(spark):
    from sorigil.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    ids = plain_ids(docs)
    rows = QUERIES["op8_best_fit_decreasing"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(ids)
    n = check_packing(rows, ids, 2048)
    assert n <= sum(len(x) for v in ids.values() for x in v) / 2048 * 1.03 + 1


def test_packing_of_edge_rows_in_small_windows_and_groups(spark):
    docs = [(1, None), (2, ""), (3, "word " * 5000), (3, "word " * 5000), (None, "naïve <|endoftext|> 中文 \U0001f600"), (4, " " * 3000 + "x"), (5, "a" * 20_000), *((k, "x y z " * (k % 9)) for k in range(10, 60))]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, start int, sequence_id int")
    rows = packing.pack(df, window=64, group=20).collect()
    assert sum(r.start == 0 for r in rows) == len(docs)
    check_packing(rows, plain_ids(docs), 64)
    assert packing.pack(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_best_fit_decreasing_takes_the_tightest_window(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 33, 300)
    number, offset = packing.best_fit_decreasing(lengths, 32)
    room, got = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [c for c in room if c >= lengths[i]]
        best = min(fits, default=32)
        if fits:
            room.remove(best)
        got[i] = 32 - best
        if best > lengths[i]:
            room.append(best - lengths[i])
    assert [got[i] for i in range(300)] == offset.tolist()
    assert np.bincount(number, lengths).max() <= 32

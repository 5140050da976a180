import itertools
import math
import random

import pytest

import numpy as np
from pyspark.sql import functions as F

from sorigil.operators import encode, lattice, trie, vocab
from sorigil.sources import fixtures as fx
from tests import vocab_reference

SMALL = "/root/testdata/sf0.001"


def _paths(word, pieces, max_len=16):
    """Every split of ``word`` into pieces of the dictionary (brute force)."""
    n = len(word)
    out = []
    for cuts in itertools.product([0, 1], repeat=max(n - 1, 0)):
        bounds = [0] + [i + 1 for i, c in enumerate(cuts) if c] + [n]
        segs = [word[a:b] for a, b in zip(bounds, bounds[1:])]
        if all(s in pieces and len(s) <= max_len for s in segs):
            out.append(segs)
    return out


VOC = {"▁": -2.0, "ㄱ": -3.0, "ㅏ": -3.5, "ㄱㅏ": -2.5, "▁ㄱ": -2.2, "ㄴ": -4.0, "ㅏㄴ": -3.1, "▁ㄱㅏ": -6.0}


def test_viterbi_is_best_enumerated_path():
    vocab_ids = {p: (i + 4, s) for i, (p, s) in enumerate(sorted(VOC.items()))}
    for w in ["▁ㄱㅏㄱㅏ", "▁ㄱㅏㄴ", "ㄱㅏㄴㄱ", "▁", "ㄴㅏㄱㅏㄴ"]:
        pieces, ids, score = vocab_reference.viterbi(w, vocab_ids, 16, -100.0)
        best = max(sum(VOC[p] for p in path) for path in _paths(w, VOC))
        assert math.isclose(score, best)
        assert "".join(pieces) == w
        assert [vocab_ids[p][0] for p in pieces] == ids


def test_probed_split_and_unknown():
    vocab_ids = {p: (i + 4, s) for i, (p, s) in enumerate(sorted(VOC.items()))}
    pieces, ids, _ = vocab_reference.viterbi("▁ㄱㅏㄱㅏ", vocab_ids, 16, -100.0)
    assert pieces == ["▁ㄱ", "ㅏ", "ㄱㅏ"] or sum(VOC[p] for p in pieces) >= -7.7
    pieces, ids, _ = vocab_reference.viterbi("ㄱㅎㅏ", vocab_ids, 16, -100.0)
    assert pieces == ["ㄱ", "ㅎ", "ㅏ"] and ids[1] == vocab.UNK_ID


def test_forward_total_equals_sum_over_paths():
    for w in ["▁ㄱㅏㄱㅏ", "ㄱㅏㄴ", "▁ㄱㅏㄴ"]:
        ll, counts = vocab_reference.expected_counts(w, 1.0, VOC, 16, -100.0)
        paths = _paths(w, VOC)
        z = math.log(sum(math.exp(sum(VOC[p] for p in path)) for path in paths))
        assert math.isclose(ll, z, rel_tol=1e-12)
        # expected counts: sum over paths of P(path) * occurrences
        exp = {}
        for path in paths:
            pr = math.exp(sum(VOC[p] for p in path) - z)
            for p in path:
                exp[p] = exp.get(p, 0.0) + pr
        for p, c in exp.items():
            assert math.isclose(counts.get(p, 0.0), c, rel_tol=1e-9, abs_tol=1e-12)


def test_native_substrings_match_python(spark):
    words = ["▁ㄱㅏㄴㅏ", "▁ㅎ", "▁" + "ㄱ" * 20]
    wc = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    native = {r["piece"]: r["n"] for r in vocab.substring_counts(wc).collect()}
    exp = {}
    for w in words:
        for b in range(len(w)):
            for e in range(b + 1, min(len(w), b + 16) + 1):
                p = w[b:e]
                if b > 0 and "▁" in p:
                    continue
                exp[p] = exp.get(p, 0) + 2
    assert native == exp
    arr = wc.select(F.explode(vocab.substrings(F.col("word"))).alias("s")).select("s.piece").collect()
    assert sorted(r[0] for r in arr) == sorted(p for w in words for p in [w[b:e] for b in range(len(w)) for e in range(b + 1, min(len(w), b + 16) + 1)] if not (p[0] != "▁" and "▁" in p) and (p.startswith("▁") or "▁" not in p))


def test_train_vocab_invariants(spark):
    docs = fx.table(spark, SMALL, "documents").select("text")
    wc = vocab.word_counts(docs, "text", True, fx.hangulize)
    hist = []
    v = vocab.train_vocab(wc, vocab_size=300, seed_size=1200, em_rounds=2, shrink=0.6, history=hist).orderBy("id").collect()
    assert [(r["id"], r["piece"]) for r in v[:4]] == [(0, "<pad>"), (1, "<unk>"), (2, "<s>"), (3, "</s>")]
    pieces = [r["piece"] for r in v[4:]]
    scores = [r["score"] for r in v[4:]]
    assert len(pieces) == len(set(pieces)) and len(v) == 300
    assert all(a >= b for a, b in zip(scores, scores[1:]))
    assert all(len(p) <= 16 for p in pieces)
    chars = {c for r in wc.collect() for c in r["word"]}
    assert chars <= set(pieces)
    assert hist[1] >= hist[0] - 1e-6 * abs(hist[0])  # EM does not lower the likelihood


def test_rank_keeps_rare_characters_and_refuses_a_size_below_the_alphabet(spark):
    scores = spark.createDataFrame([("ab", -1.0), ("bc", -1.5), ("a", -2.0), ("b", -9.0), ("c", -8.0)], "piece string, score double")
    got = [(r["id"], r["piece"]) for r in vocab.rank_vocab(scores, 8).orderBy("id").collect()]
    assert got[4:] == [(4, "ab"), (5, "a"), (6, "c"), (7, "b")]
    with pytest.raises(ValueError, match="alphabet of 3"):
        vocab.rank_vocab(scores, 6)


def test_coverage_leaves_rare_characters_out_of_training(spark):
    wc = spark.createDataFrame([("▁ab", 90), ("▁ba", 9), ("▁q", 1)], "word string, n long")
    every = {r["piece"] for r in vocab.train_vocab(wc, 12, 50, em_rounds=1, min_freq=1).collect()}
    most = {r["piece"] for r in vocab.train_vocab(wc, 12, 50, em_rounds=1, min_freq=1, coverage=0.99).collect()}
    assert "q" in every and not any("q" in p for p in most) and {"a", "b", "▁"} <= most


def test_encode_decode_round_trip(spark):
    docs = fx.table(spark, SMALL, "documents").select("doc_id", "text")
    wc = vocab.word_counts(docs, "text", True, fx.hangulize)
    v = vocab.rank_vocab(vocab.initial_scores(vocab.top_pieces(vocab.seed_pieces(wc), 500)), 600)
    texts = docs.select("doc_id", vocab.hangul_to_jamo(fx.hangulize("text")).alias("jamo"))
    seg = encode.segment_words(wc, v)
    enc = encode.encode_texts(texts, "doc_id", seg)
    dec = {r["doc_id"]: r["text"] for r in encode.decode_ids(enc, "doc_id", v).collect()}
    for r in texts.collect():
        assert dec[r["doc_id"]] == " ".join(r["jamo"].split())
    # every piece of every segmented word concatenates back to the word
    for r in seg.limit(200).collect():
        assert "".join(r["pieces"]) == r["word"]
    stats = encode.token_stats(enc.withColumn("g", F.lit("all")), "g").collect()[0]
    assert stats["n_texts"] == texts.count() and stats["unk_rate"] == 0.0


def pruned(spark, scored, scores, target, shrink):
    """The pieces that ``prune`` keeps of a score table."""
    names = sorted(scores)
    n = {r["piece"]: r["n"] for r in scored.collect()}
    arr, counts = (np.array([x[p] for p in names]) for x in (scores, n))
    kept = vocab.prune(spark, trie.share(spark, names), arr, counts, np.array([len(p) == 1 for p in names]), target, shrink)
    assert all(np.isnan(k) or k == a for k, a in zip(kept, arr))
    return {p for p, k in zip(names, kept) if not np.isnan(k)}


def test_spark_m_step_and_prune_match_python(spark):
    import pandas as pd

    counts = {"▁": 5.0, "ㄱ": 3.0, "ㅏ": 0.0, "ㄱㅏ": 4.0, "▁ㄱ": 2.5, "ㅏㄴ": 1e-4, "▁ㄱㅏ": 1.5, "ㄴ": 0.7}
    rows = list(counts.items()) + [(None, -42.0)]
    cdf = spark.createDataFrame(rows, "piece string, n double")
    chars = {p for p in counts if len(p) == 1}
    py = vocab_reference.m_step(pd.DataFrame(list(counts.items()), columns=["piece", "n"]), chars)
    arr = np.array([-1.0] * len(counts) + [np.nan])
    got, n = vocab.m_step(arr, np.array([*counts.values(), 9.0]))
    total = sum(max(c, vocab.COUNT_FLOOR) for c in counts.values())
    assert np.isnan(got[-1]) and all(math.isclose(g, math.log(max(c, vocab.COUNT_FLOOR) / total)) for g, c in zip(got, counts.values()))
    scored = vocab.m_step_df(cdf)
    sp = {r["piece"]: r["score"] for r in scored.collect()}
    assert sp.keys() == py.keys()
    assert all(math.isclose(sp[p], py[p], rel_tol=1e-12) for p in py)
    for target, shrink in [(4, 0.5), (6, 0.9), (100, 0.75)]:
        want = vocab_reference.prune(py, counts, chars, target, shrink)
        assert pruned(spark, scored, py, target, shrink) == want.keys()


def test_prefix_cut_changes_nothing():
    import random

    rnd = random.Random(7)
    alphabet = "▁ㄱㅏㄴㅎ"
    for _ in range(300):
        pieces = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        scores = {p: -float(rnd.randint(1, 8)) for p in pieces}  # integer scores: many exact ties
        ids = {p: (i + 4, s) for i, (p, s) in enumerate(sorted(scores.items()))}
        pref = vocab_reference.prefixes(scores)
        w = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12)))
        assert vocab_reference.viterbi(w, ids, 16, -20.0, pref) == vocab_reference.viterbi(w, ids, 16, -20.0)
        ll1, c1 = vocab_reference.expected_counts(w, 1.0, scores, 16, -20.0, pref)
        ll2, c2 = vocab_reference.expected_counts(w, 1.0, scores, 16, -20.0)
        assert math.isclose(ll1, ll2, rel_tol=1e-12, abs_tol=1e-12) and c1.keys() == c2.keys()


def test_native_segmentation_equals_arrow(spark):
    """Beyond the broadcast bound the vocabulary is joined, not shipped: same splits."""
    import random

    rnd = random.Random(11)
    alphabet = "▁ㄱㅏㄴㅎ"
    voc = [(i + 4, p, s) for i, (p, s) in enumerate(sorted(VOC.items()))] + [(99, "ㅎㅏ", -2.5)]  # ties with ㄱㅏ
    v = spark.createDataFrame([(0, "<pad>", 0.0), (1, "<unk>", 0.0)] + voc, "id int, piece string, score double")
    words = {"▁ㄱㅏㄱㅏ", "ㄱㅎㅏ", "▁ㅋ", "▁ㄱ▁ㄱㅏ", "▁"} | {"▁" + "".join(rnd.choice(alphabet + "ㅋ") for _ in range(rnd.randint(0, 14))) for _ in range(60)}
    wdf = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    arrow = {r["word"]: (r["pieces"], r["ids"], r["score"]) for r in encode.segment_words(wdf, v).collect()}
    native = {r["word"]: (r["pieces"], r["ids"], r["score"]) for r in encode.segment_words(wdf, v, broadcast_limit=3).collect()}
    assert arrow.keys() == native.keys() == words
    for w in words:
        assert arrow[w][0] == native[w][0] and arrow[w][1] == native[w][1]
        assert math.isclose(arrow[w][2], native[w][2], rel_tol=1e-12)


def test_batch_forward_backward_equals_per_word():
    import random

    rnd = random.Random(3)
    alphabet = "▁ㄱㅏㄴㅎ"
    for _ in range(20):
        pieces = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4))) for _ in range(15)}
        scores = {p: -rnd.uniform(1, 9) for p in pieces}
        words = ["▁" + "".join(rnd.choice(alphabet + "ㅋ") for _ in range(rnd.randint(0, 20))) for _ in range(25)]
        freqs = np.array([float(rnd.randint(1, 5)) for _ in words])
        names = list(scores)
        index = {p: i for i, p in enumerate(names)}
        arr = np.array([scores[p] for p in names])
        ll, counts = vocab.batch_expected_counts(words, freqs, trie.build(names), arr, 16, -30.0)
        want_ll, want = 0.0, {}
        for w, f in zip(words, freqs):
            l1, c1 = vocab_reference.expected_counts(w, f, scores, 16, -30.0)
            want_ll += l1
            for p, c in c1.items():
                want[p] = want.get(p, 0.0) + c
        assert math.isclose(ll, want_ll, rel_tol=1e-10)
        for p, i in index.items():
            assert math.isclose(counts[i], want.get(p, 0.0), rel_tol=1e-9, abs_tol=1e-12)


def test_encode_decode_empty_and_null_texts(spark):
    voc = [(i + 4, p, s) for i, (p, s) in enumerate(sorted(VOC.items()))]
    v = spark.createDataFrame([(0, "<pad>", 0.0), (1, "<unk>", 0.0)] + voc, "id int, piece string, score double")
    texts = spark.createDataFrame([(1, "ㄱㅏ  ㄱㅏㄴ"), (2, ""), (3, "   "), (4, None), (5, "ㅋ")], "k long, jamo string")
    words = encode.text_words(texts, "k").select("word").distinct()
    enc = encode.encode_texts(texts, "k", encode.segment_words(words, v))
    got = {r["k"]: (r["pieces"], r["ids"]) for r in enc.collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[2] == ([], []) and got[3] == ([], []) and got[4] == ([], [])
    assert "".join(got[1][0]) == "▁ㄱㅏ▁ㄱㅏㄴ" and got[5][1][-1] == vocab.UNK_ID
    dec = {r["k"]: r["text"] for r in encode.decode_ids(enc, "k", v).collect()}
    assert dec == {1: "ㄱㅏ ㄱㅏㄴ", 2: "", 3: "", 4: "", 5: "<unk>"}


def test_token_counts_with_a_hot_word(spark):
    """One word is about a third of all word occurrences: per-text counts equal brute force
    and do not depend on the number of shuffle partitions."""
    import random

    rnd = random.Random(9)
    alphabet = "ㄱㅏㄴㅎㅋ"
    texts = []
    for k in range(300):
        ws = ["ㄱㅏ" if rnd.random() < 0.34 else "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(0, 30))]
        texts.append((k, " ".join(ws)))
    tdf = spark.createDataFrame(texts, "k long, jamo string")
    voc = [(i + 4, p, s) for i, (p, s) in enumerate(sorted(VOC.items()))]
    v = spark.createDataFrame([(0, "<pad>", 0.0), (1, "<unk>", 0.0)] + voc, "id int, piece string, score double")
    seg = encode.segment_words(encode.text_words(tdf, "k").select("word").distinct(), v)
    vocab_ids = {p: (i, s) for i, p, s in voc}
    want = {}
    for k, t in texts:
        ids = [i for w in t.split() for i in vocab_reference.viterbi("▁" + w, vocab_ids, 16, min(VOC.values()) - vocab.UNKNOWN_PENALTY)[1]]
        want[k] = (len(ids), sum(1 for i in ids if i == vocab.UNK_ID))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r["k"]: (r["n"], r["u"]) for r in encode.text_token_counts(tdf, "k", seg).collect()}
            assert got == {k: c for k, c in want.items() if c[0] > 0}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_native_em_and_prune_match_broadcast_forms(spark):
    """Beyond the broadcast limit the E step and pruning are native folds: same results."""
    import random

    rnd = random.Random(21)
    alphabet = "▁ㄱㅏㄴㅎ"
    scores = {p: -rnd.uniform(1, 9) for p in {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4))) for _ in range(25)}}
    words = {"▁" + "".join(rnd.choice(alphabet + "ㅋ") for _ in range(rnd.randint(0, 12))) for _ in range(80)}
    wc = spark.createDataFrame([(w, rnd.randint(1, 5)) for w in sorted(words)], "word string, n long")
    sdf = spark.createDataFrame(list(scores.items()), "piece string, score double")
    names = [*scores, "ㅋㅋ", "ㄱㅎㄱ"]  # pieces that were pruned: in the lattices, without a score
    arr = np.array([scores.get(p, np.nan) for p in names])
    rows = vocab.em_step(vocab.word_lattices(wc, trie.share(spark, names)), arr).collect()
    a = {None if r["p"] is None else names[r["p"]]: r["n"] for r in rows}
    want = {}
    for r in wc.collect():
        ll, counts = vocab_reference.expected_counts(r["word"], r["n"], scores, 16, min(scores.values()) - vocab.UNKNOWN_PENALTY)
        for p, n in [(None, ll), *counts.items()]:
            want[p] = want.get(p, 0.0) + n
    assert all(math.isclose(a.get(p, 0.0), n, rel_tol=1e-9, abs_tol=1e-12) for p, n in want.items()) and a.keys() <= want.keys()
    b = {r["piece"]: r["n"] for r in vocab.em_step_native(wc, sdf).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[p], b[p], rel_tol=1e-9, abs_tol=1e-12) for p in a)
    counts = spark.createDataFrame([(p, n) for p, n in a.items()], "piece string, n double")
    scored = vocab.m_step_df(counts)
    sc = {r["piece"]: r["score"] for r in scored.collect()}
    for target, shrink in [(5, 0.5), (12, 0.8)]:
        want = pruned(spark, scored, sc, target, shrink)
        got = {r["piece"] for r in vocab.prune_native(scored, target, shrink).collect()}
        assert got == want


def test_train_vocab_native_path_matches(spark):
    """The same vocabulary whether the scores are broadcast or kept as a table."""
    docs = fx.table(spark, SMALL, "documents").select("text")
    wc = vocab.word_counts(docs, "text", True, fx.hangulize).where(F.length("word") <= 8)
    a = {r["piece"]: r["score"] for r in vocab.train_vocab(wc, 120, 400, em_rounds=1, shrink=0.6).collect()}
    b = {r["piece"]: r["score"] for r in vocab.train_vocab(wc, 120, 400, em_rounds=1, shrink=0.6, broadcast_limit=10).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[p], b[p], abs_tol=2e-6) for p in a)


def test_a_long_word_does_not_widen_the_others():
    import tracemalloc

    words = ["▁ab" * 2] * 1000 + ["▁" + "ab" * 100_000]
    groups = list(vocab.by_length(np.array([len(w) for w in words])))
    assert sorted(i for g in groups for i in g) == list(range(1001)) and groups[-1].tolist() == [1000]
    scores = {"▁": -1.0, "a": -2.0, "b": -2.0, "ab": -2.5}
    index, pieces = {p: i for i, p in enumerate(scores)}, trie.build(list(scores))
    arr = np.array(list(scores.values()))
    tracemalloc.start()
    total = np.zeros(len(arr))
    for g in groups:
        total += vocab.batch_expected_counts([words[i] for i in g], np.ones(len(g)), pieces, arr, 16, -30.0)[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and total[0] > 0
    per = vocab_reference.expected_counts(words[0], 1.0, scores, 16, -30.0)[1]
    long = vocab_reference.expected_counts(words[-1][:2001], 1.0, scores, 16, -30.0)[1]
    short = vocab.batch_expected_counts([words[-1][:2001]], np.ones(1), pieces, arr, 16, -30.0)[1]
    assert math.isclose(short[index["ab"]], long["ab"], rel_tol=1e-9) and math.isclose(per["▁"], 2.0)


def test_trie_lattice_and_batched_paths_match_the_plain_forms():
    """Integer scores make many exact ties; characters outside the alphabet, long words and empty words included."""
    rnd = random.Random(4)
    letters = "▁ㄱㄴㅏㅓ😀"
    for _ in range(40):
        names = sorted({"".join(rnd.choices(letters, k=rnd.randint(1, 6))) for _ in range(60)})
        rnd.shuffle(names)
        scores = np.array([-float(rnd.randint(1, 6)) for _ in names])
        words = ["", *("".join(rnd.choices(letters + "z", k=rnd.randint(0, 25))) for _ in range(40)), "ㄱㄴ" * 200]
        built = trie.build(names)
        for max_len in (16, 3):
            want = vocab_reference.lattice_edges_of(words, {p: i for i, p in enumerate(names)}, max_len, vocab_reference.prefixes(names))
            got = built.lattice(words, max_len)
            assert list(zip(*(x.tolist() for x in got))) == sorted(zip(*(x.tolist() for x in want)))
            batch = encode.split_batch(words, built, np.array(names, dtype=object), np.arange(4, len(names) + 4), scores, max_len, -20.0)
            ids = {p: (i + 4, s) for i, (p, s) in enumerate(zip(names, scores.tolist()))}
            for row in batch.to_pylist():
                assert (row["pieces"], row["ids"], row["score"]) == vocab_reference.viterbi(row["word"], ids, max_len, -20.0)
        alt = vocab.split_scores(names, built, scores)
        plain = dict(zip(names, scores.tolist()))
        assert all(a == vocab_reference._best_split_without(p, plain, 16) for a, p in zip(alt.tolist(), names))


def test_trie_refuses_what_it_cannot_hold_and_an_empty_one_works():
    for bad in (["a", "a"], ["a", ""]):
        with pytest.raises(ValueError):
            trie.build(bad)
    empty = trie.build([])
    assert [x.tolist() for x in empty.lattice(["ab"], 16)] == [[0, 0], [0, 1], [1, 2], [-1, -1]]
    assert lattice.best_paths(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0), np.array([0, 2]))[0].tolist() == [0.0, -np.inf]


def test_turns_are_counted_with_the_vocabulary_trained_on_them(spark):
    from sorigil.plans.catalog import trained_on

    rng = random.Random(8)
    rows = [(str(i), " ".join("".join(rng.choices("ㄱㄴㄷㅏㅓ", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))) + (" ㅋ" if i == 7 else "")) for i in range(120)]
    texts = spark.createDataFrame([*rows, ("null", None)], "k string, jamo string")
    trained, counts = trained_on(texts, "k", "jamo", 40, coverage=0.9985)
    pieces = {r["piece"]: (r["id"], r["score"]) for r in trained.collect() if r["id"] >= 4}
    assert "ㅋ" not in pieces and len(pieces) == 36
    unk = min(s for _, s in pieces.values()) - vocab.UNKNOWN_PENALTY
    got = {r["k"]: (r["n"], r["u"]) for r in counts.collect()}
    for k, text in rows:
        ids = [i for w in text.split() for i in vocab_reference.viterbi("▁" + w, pieces, 16, unk)[1]]
        assert got.get(k, (0, 0)) == (len(ids), ids.count(vocab.UNK_ID))
    assert got["7"][1] == 1

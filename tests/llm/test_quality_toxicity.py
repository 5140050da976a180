"""Quality verdicts against plain counts, toxicity by held-out rows; edge rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from sorigil.llm import quality_divergence as quality
from sorigil.llm import toxicity_fm

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, kept string, n_words string, classes int, of int, words string"
SPACE = r"[\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n = Counter(windows)
    hit = set()
    for k, w in enumerate(windows):
        if n[w] > 1:
            hit.update(range(k, k + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def plain_histograms(text):
    text = text or ""
    classes = [len(re.findall(p, text)) for p in (r"[a-z]", r"[\x20\x09-\x0D]", r"[^\x00-\x7F]", r"[A-Z]", r"[0-9]", r"[#*$%&|<>]")]
    words = Counter(w if w in quality.COMMON else "" for w in re.split(SPACE, text) if w)
    return [*classes, len(text) - sum(classes)], [words[w] for w in [*quality.COMMON, ""]]


def plain_distance(p, q):
    p, q = ([x / sum(v) if sum(v) else 0 for x in v] for v in (p, q))
    return math.sqrt(max(0, sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)) / 2))


def plain_verdicts(rows):
    hist = [plain_histograms(t) for _, t, _ in rows]
    bucket = [lang if lang in quality.FUNCTION_WORDS else "other" for _, _, lang in rows]
    ref = {b: [[sum(x) for x in zip(*(h[k] for h, c in zip(hist, bucket) if c == b))] for k in (0, 1)] for b in set(bucket)}
    out = []
    for (i, t, _), h, b in zip(rows, hist, bucket):
        n, chars, symbols, dup, rep = plain_counts(t)
        failed = n < 10 or 100 * rep > 20 * n
        strange = (len(t or "") >= quality.LEAST_CHARS and plain_distance(h[0], ref[b][0]) > quality.MOST_CLASS) or (n >= quality.LEAST_WORDS and plain_distance(h[1], ref[b][1]) > quality.MOST_WORD)
        out.append((i, n, chars, symbols, dup, rep, failed, not failed and not strange))
    return out


def test_verdicts_match_plain_counts_on_edge_rows(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs += [
        (1, None, "en"), (2, "", None), (3, " \n\t\x0b ", "xx"), (4, "a b c d e a b c d e", "en"), (5, "x " * 4000, "en"), (None, "the cat " * 30, None), (6, "a\n a\na\n\n\na", "de"),
        (6, "a\n a\na\n\n\na", "de"), (7, "é   ß", "de"), (8, " lead", "fr"), (9, "AAA!! " * 200, "en"),
    ]
    df = spark.createDataFrame([(*d, "k", "n", 1, 2, "w") for d in docs], SCHEMA)
    got = sorted(map(tuple, quality.judge(df).collect()), key=str)
    want = plain_verdicts(docs)
    assert got == sorted(want, key=str)
    good = quality.keep_good(df)
    assert good.schema == df.schema
    assert sorted((r.doc_id, r.text) for r in good.collect()) == sorted((i, t) for (i, t, _), v in zip(docs, want) if v[-1])
    assert quality.judge(df.limit(0)).collect() == [] and quality.keep_good(df.limit(0)).collect() == []


def test_plan_has_no_python_and_no_shuffle_of_texts(spark):
    plan = quality.judge(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan


def test_languages_and_scripts_are_not_judged_by_each_other(spark):
    rng = random.Random(5)

    def prose(letters, words=150):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(words))

    latin, cyrillic, han = "abcdefghilmnoprstuz", "абвгдежзиклмнопрсту", "的一是不了人我在有他这中大来上国"
    groups = [("pl", latin, 90), ("ru", cyrillic, 60), (None, latin, 40), (None, cyrillic, 60), ("und", latin, 5), ("sr-Latn", latin, 5), ("sr", cyrillic, 5), ("ka", "აბგდევზთი", 3)]
    rows = [(lang, prose(letters)) for lang, letters, n in groups for _ in range(n)] + [(None, prose(han).replace(" ", "") + " a" * 3 + " b c d e f g") for _ in range(100)]
    english = [("en", prose(latin)) for _ in range(40)] + [("en-US", prose(latin)), ("EN_gb", prose(latin))]
    strange = [("en-US", prose(cyrillic)), ("pl", "#$% &*| " * 3 + " ".join("".join(rng.choices("#$%&*|", k=9)) for _ in range(60)))]
    rows = [(i, t, lang) for i, (lang, t) in enumerate([*rows, *english, *strange])]
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [i for i, k in got.items() if not k] == [len(rows) - 2, len(rows) - 1]


def toxic_rows(n=900):
    """A pair of terms is toxic where both come, each is harmless alone."""
    rows, labels = [], []
    for i in range(n):
        kind = i % 4
        extra = {0: "", 1: " grimble", 2: " floxen", 3: " grimble floxen"}[kind]
        rows.append((i, f"some plain words number{i % 17} about{i % 13} nothing" + extra))
        labels.append((i, int(kind == 3)))
    return rows, labels


def test_pairs_of_terms_are_learnt_and_held_out_rows_are_right(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id long, text string, score double, held_out boolean")
    got = toxicity_fm.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_toxicity_edge_rows(spark):
    rows, labels = toxic_rows(200)
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "grimble floxen"), (3, "grimble floxen"), (1002, "word " * 50_000)], "doc_id long, text string")
    label = spark.createDataFrame([*labels, (0, None), (None, 1), (3, 0), (99999, 1)], "doc_id long, toxic int")
    got = toxicity_fm.toxicity(docs, label).collect()
    assert len(got) == 205 and all(r.score is not None for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.predicted for r in toxicity_fm.toxicity(docs, label.limit(0)).collect()} == {0}
    assert toxicity_fm.toxicity(docs.limit(0), label).collect() == []


def test_a_bounded_sample_and_held_out_labels_do_not_reach_the_fit(spark):
    rows, labels = toxic_rows(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = [(i, 1 - y) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, y) for i, y in labels]
    a, b = (toxicity_fm.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, held))
    assert a.bias == b.bias and (a.weights == b.weights).all()
    assert toxicity_fm.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), sample=50).weights is not None


def test_an_exclusive_or_of_terms_is_learnt(spark):
    """Every term is even between the classes alone; only pairs tell."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(2000):
        a, b = rng.randint(0, 1), rng.randint(0, 1)
        noise = " ".join(f"w{rng.randint(0, 40)}" for _ in range(6))
        rows.append((i, f"{noise} {('alpha', 'bravo')[a]} {('carol', 'delta')[b]} more{i % 13}"))
        labels.append((i, int(a != b)))
    got = toxicity_fm.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r.predicted == labels[r.doc_id][1] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.95


def test_scores_are_the_sum_over_all_pairs():
    """The machine against its definition: bias, weights and every pair's inner product, one by one."""
    rng = np.random.default_rng(2)
    buckets = np.sort(rng.choice(toxicity_fm.BUCKETS, 50, replace=False))
    size = 50 + toxicity_fm.LENGTHS + toxicity_fm.SHARED
    machine = toxicity_fm.Machine(buckets, 0.3, rng.normal(0, 0.1, size), rng.normal(0, 0.1, (size, toxicity_fm.FACTORS)))
    texts = ["one two three two longerword longerworld", "", None, "alpha " * 9 + "beta gamma", "x"]
    row, cell, x = machine.entries(*toxicity_fm.term_counts(pa.array(texts), machine.cells()))
    got = machine.probability(row, cell, x, len(texts))
    for i in range(len(texts)):
        mine = [(c, v) for r, c, v in zip(row, cell, x) if r == i]
        raw = 0.3 + sum(machine.weights[c] * v for c, v in mine)
        raw += sum(machine.factors[c] @ machine.factors[d] * v * u for k, (c, v) in enumerate(mine) for d, u in mine[:k])
        assert abs(got[i] - 1 / (1 + math.exp(-raw))) < 1e-9

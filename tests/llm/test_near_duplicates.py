"""SuperMinHash: signature properties, groups against all pairs, edge rows."""

import numpy as np
import pyarrow as pa
import pytest

from sorigil.llm import superminhash as smh

SCHEMA = "doc_id long, text string, kept string, component_id int, id string"


def plain_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def plain_groups(rows):
    """Component of every doc_id, all pairs compared; a doc_id has the sets of all its rows."""
    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in root}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "k", 1, "x") for i, t in rows], SCHEMA)
    got = smh.near_duplicates(df).collect()
    want = plain_groups(rows)
    sizes = sorted((i is None, i or 0, len(plain_set(t))) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sizes
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return df


def test_shingle_sets_are_exact():
    texts = ["a b c", "", None, "A\tb  C a b c", "one", "x y z", " lead and trail "]
    values, at = smh.shingle_sets(pa.array(texts))
    assert np.diff(at).tolist() == [len(plain_set(t)) for t in texts]
    assert set(values[at[0] : at[1]]) <= set(values[at[3] : at[4]])


@pytest.mark.parametrize("n", [1, 3, 40, 2000])
def test_signature_estimates_similarity(n):
    rng = np.random.default_rng(n)
    pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
    a, b = pool[: n], pool[n // 4 : n + n // 4]
    sig = smh.signatures(np.concatenate([a, b, a[::-1]]), np.array([0, n, 2 * n, 3 * n]))
    true = len(set(a) & set(b)) / len(set(a) | set(b))
    assert (sig[0] == sig[2]).all()  # order does not matter
    assert (sig < np.iinfo(np.uint64).max).all()  # every register is filled
    assert abs((sig[0] == sig[1]).mean() - true) < 0.15


def test_groups_match_all_pairs_on_edge_rows(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 400, 120)]
    rows = [(100, " ".join(base)), (7, " ".join(base)), (None, " ".join(base)), (50, None), (51, ""), (52, "  \n"), (60, "one"), (61, "One"), (62, "two")]
    for k in range(60):  # near copies at all distances around the threshold
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(1, 14)):
            words[at] = f"n{rng.integers(0, 10**6)}"
        rows.append((200 + k, " ".join(words)))
    rows += [(7, " ".join(base)), (300, "a b c d e f"), (300, "p q r s t u"), (301, "p q r s t u"), (299, "a b c d e f")]
    df = check(spark, rows)
    kept = smh.keep_one_of_each_group(df)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and None in ids and kept.schema == df.schema
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert all(t is None or t == min(u for j, u in rows if j == i) for i, t in texts.items() if i is not None)
    several = spark.createDataFrame([(i, t, "k", 1, "x") for t in ("p q r s", None, "a b c d") for i in (5, 6)] + [(8, "z y x w", "k", 1, "x"), (8, "a b", "k", 1, "x")], df.schema)
    assert sorted((r.doc_id, r.text or "") for r in smh.keep_one_of_each_group(several).collect()) == [(5, "a b c d"), (6, ""), (8, "a b")]


def test_open_members_are_compared_in_blocks(spark, monkeypatch):
    """Many documents in common buckets that are not linked with the hub."""
    monkeypatch.setattr(smh, "VOLUME", 300)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(90):
        words = list(base)
        for at in rng.choice(60, rng.integers(4, 9), replace=False):
            words[at] = f"n{rng.integers(0, 40)}"
        rows.append((k, " ".join(words)))
    check(spark, rows)


def test_whole_small_table_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_groups(rows)
    from sorigil.llm.queries import QUERIES

    got = QUERIES["op7_superminhash"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert smh.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long").repartition(7)
    got = {r.node: r.root for r in smh.components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}

import random

from pyspark.sql import functions as F

from sorigil.operators import order


def _skewed(spark):
    rng = random.Random(3)
    rows = []
    key = 0
    for src, n in (("a", 900), ("b", 7), ("c", 1), ("d", 300)):
        for _ in range(n):
            key += rng.randint(1, 50)  # gaps in the key
            rows.append((key, src, {"a": 2, "b": 0, "c": 3, "d": 1}[src]))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k long, source string, source_ord int"), rows


def test_concat_positions_match_brute_force(spark):
    df, rows = _skewed(spark)
    got = {r["k"]: (r["row_idx"], r["pos"]) for r in order.concat_positions(df, "k").collect()}
    by_src = {}
    for k, s, o in rows:
        by_src.setdefault((o, s), []).append(k)
    pos = 0
    for (o, s) in sorted(by_src):
        for i, k in enumerate(sorted(by_src[(o, s)])):
            assert got[k] == (i, pos)
            pos += 1


def test_positions_independent_of_partitions(spark):
    df, _ = _skewed(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(tuple(r) for r in order.concat_positions(df, "k").collect())
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = sorted(tuple(r) for r in order.concat_positions(df.repartition(5), "k").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_shuffle_is_permutation_per_epoch(spark):
    df = spark.range(500).withColumnRenamed("id", "pos")
    sh = order.shuffled_positions(df, 3, seed=7).collect()
    for e in range(3):
        s = sorted(r["shuffled_pos"] for r in sh if r["epoch"] == e)
        assert s == list(range(500))
    e0 = [r["pos"] for r in sorted((r for r in sh if r["epoch"] == 0), key=lambda r: r["shuffled_pos"])]
    e1 = [r["pos"] for r in sorted((r for r in sh if r["epoch"] == 1), key=lambda r: r["shuffled_pos"])]
    assert e0 != e1


def test_running_total_and_prefix(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(1000)], "b long, v long")
    got = {r["b"]: r["c"] for r in order.running_total(df, "b", "v", "c", width=37).collect()}
    acc = 0
    for i in range(1000):
        acc += i % 3
        assert got[i] == acc
    p = spark.range(100).withColumnRenamed("id", "pos")
    assert order.max_samples(p, 10).count() == 10
    assert order.max_samples(p, None).count() == 100


def test_positions_for_any_key(spark):
    """Hashed, string, sparse, equal-second and missing keys; null data sets keep their rows."""
    rng = random.Random(11)
    rows = [(rng.getrandbits(62), f"file{rng.random()}.wav", "s" if i % 3 else None, 0 if i % 3 else None, 5 if i % 2 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "h long, name string, source string, source_ord int, num long")
    got = order.concat_positions(df, "h").collect()
    want = sorted(rows, key=lambda r: (r[3] is not None, r[3] or 0, r[2] or "", r[0]))
    assert [r["h"] for r in sorted(got, key=lambda r: r["pos"])] == [r[0] for r in want]
    for src in ("s", None):
        assert sorted(r["row_idx"] for r in got if r["source"] == src) == list(range(sum(r[2] == src for r in rows)))
    by_name = order.range_index(df, ["num", "name"], ["source"], "i").collect()
    for src in ("s", None):
        mine = sorted((r for r in rows if r[2] == src), key=lambda r: (r[4] is not None, r[1]))
        assert [r["name"] for r in sorted((r for r in by_name if r["source"] == src), key=lambda r: r["i"])] == [r[1] for r in mine]


def test_no_task_holds_a_data_set_or_a_second(spark):
    """Sparse keys of one data set spread evenly over the tasks."""
    df = spark.range(20_000).select((F.col("id") * 1_000_003).alias("k"), F.lit("one").alias("source"), F.lit(0).alias("source_ord"))
    sizes = [r["count"] for r in order.placed(df, ["source_ord", "source", "k"]).groupBy("_task").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 20_000 / len(sizes) * 2 and len(sizes) >= 8


def test_permutation_has_an_inverse_and_no_exchange(spark):
    for n in (1, 2, 3, 5, 17, 64, 1000, 4097):
        df = spark.range(n).withColumnRenamed("id", "pos")
        there = df.select("pos", order.permuted("pos", n, 1, 5).alias("at"))
        rows = there.select("pos", "at", order.permuted("at", n, 1, 5, forward=False).alias("back")).collect()
        assert sorted(r["at"] for r in rows) == list(range(n)) and all(r["back"] == r["pos"] for r in rows)
    plan = order.shuffled_positions(df, 2)._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    big = 3 * 10**12 + 7  # places far beyond 32 bits
    far = spark.range(big - 500, big).select(F.col("id").alias("pos"), order.permuted("id", big, 0).alias("at"))
    got = far.select("pos", "at", order.permuted("at", big, 0, forward=False).alias("back")).collect()
    assert all(0 <= r["at"] < big and r["back"] == r["pos"] for r in got) and len({r["at"] for r in got}) == 500


def test_shuffle_of_positions_with_gaps_and_of_none(spark):
    df = spark.range(0, 900, 3).select(F.col("id").alias("pos"), F.lit("x").alias("t"))
    rows = order.shuffled_positions(df, [4, 9], 1).collect()
    for e in (4, 9):
        assert sorted(r["shuffled_pos"] for r in rows if r["epoch"] == e) == list(range(300))
        assert sorted(r["pos"] for r in rows if r["epoch"] == e) == list(range(0, 900, 3))
    assert order.shuffled_positions(df.limit(0), 2).collect() == []


def test_texts_are_not_in_the_order_table_and_equal_keys_stay(spark):
    rows = [(i % 7, i % 3, f"text {i}", None if i % 5 else "s") for i in range(60)] + [(1, 1, "text", "s")] * 2
    df = spark.createDataFrame(rows, "k long, source_ord int, text string, source string")
    plan = order.range_index(df, ["k"], ["source_ord"], "i").select("k", "i")._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan.split("RDD")[-1]
    out = order.range_index(df, ["k"], ["source_ord"], "i").collect()
    assert sorted((r["k"], r["source_ord"], r["text"], r["source"]) for r in out if r["source"]) == sorted(r for r in rows if r[3])
    for o in range(3):
        mine = sorted((r["i"], r["k"]) for r in out if r["source_ord"] == o)
        assert [i for i, _ in mine] == list(range(len(mine))) and [k for _, k in mine] == sorted(k for _, k in mine)

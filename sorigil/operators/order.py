"""Row order on an unordered engine.

The reference numbers rows by enumeration order: inside a data set (W1), after
concatenating data sets (W2), in batches of B (W3), with running progress
counts (W4), as a prefix (L1) and in a shuffled order per epoch (L3).

``range_index`` gives every row its 0-based position for any key (dense, sparse, hashed, a string, null) without
a window over the whole table: the keys alone are range-partitioned on the order, sorted within their partitions and written
once; a partition's rows are counted, and offsets over that small table (one row per task and group) turn places
within a partition into positions. Spark's sampled ranges keep the partitions even, so no task depends on how the
keys are spread or how large a data set is. The shuffle of an epoch is a keyed
permutation of the positions, computed per row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorigil.session import cut_lineage, task_count

DEFAULT_BUCKET_WIDTH = 4096


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


_TASK_BITS = 33  # monotonically_increasing_id: the task above, the row within it below


def placed(df: DataFrame, order_cols: Sequence) -> DataFrame:
    """``df`` range-partitioned and sorted on ``order_cols``, written once, with ``_task`` and ``_row`` (its place in the task)."""
    order = _cols(order_cols)
    sorted_df = df.repartitionByRange(task_count(df.sparkSession), *order).sortWithinPartitions(*order)
    kept = cut_lineage(sorted_df.withColumn("_at", F.monotonically_increasing_id()))
    return kept.withColumns({"_task": F.shiftright("_at", _TASK_BITS), "_row": F.col("_at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))}).drop("_at")


def join_null_safe(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the other columns of ``small``, whose rows are unique on ``keys``; null keys meet."""
    renamed = small.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(renamed, on).drop(*(f"_k{i}" for i in range(len(keys))))


def _numbered(keys: DataFrame, order_cols: Sequence, partition_cols: Sequence[str], name: str) -> DataFrame:
    rows = placed(keys, [*partition_cols, *order_cols])
    by = [*partition_cols, "_task"]
    blocks = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*partition_cols).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*by, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    out = join_null_safe(rows, offsets, by)
    return out.withColumn(name, (F.col("_row") + F.col("_off")).cast("bigint")).drop("_task", "_row", "_off")


def attached(df: DataFrame, numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the positions of the key-only table ``numbered``: one join on the keys, null keys included.

    Rows that share all keys are told apart by a count within their key (in any order, on both sides); that window is
    made only when a count over the narrow table finds such rows."""
    if set(df.columns) == set(keys):
        return numbered.select(*df.columns, *(c for c in numbered.columns if c not in keys))
    if numbered.groupBy(*keys).count().where("count > 1").isEmpty():
        return join_null_safe(df, numbered, keys)
    same = Window.partitionBy(*keys)
    nth = F.row_number()
    left = df.withColumn("_nth", nth.over(same.orderBy(F.lit(0))))
    right = numbered.withColumn("_nth", nth.over(same.orderBy(next(c for c in numbered.columns if c not in keys))))
    return join_null_safe(left, right, [*keys, "_nth"]).drop("_nth")


def _names(cols: Sequence) -> list[str] | None:
    """The columns' names, None where one is an expression."""
    return list(cols) if all(isinstance(c, str) for c in cols) else None


def range_index(df: DataFrame, order_cols: Sequence, partition_cols: Sequence[str] = (), name: str = "idx") -> DataFrame:
    """0-based position of each row ordered by ``order_cols`` inside ``partition_cols``, for any keys.

    Only the key columns are range-partitioned, sorted and written; the other columns join the positions once, and those
    that no reader asks for are never read. Nulls come first and are a group of their own. Rows that are equal on the whole order come in any
    order, so the order should end with a key that tells them apart. An order by expressions numbers whole rows."""
    names = _names([*partition_cols, *order_cols])
    if names is None:
        return _numbered(df, order_cols, partition_cols, name)
    keys = list(dict.fromkeys(names))
    return attached(df, _numbered(df.select(*keys), order_cols, partition_cols, name), keys)


def source_index(df: DataFrame, key: str, source_col: str = "source", name: str = "row_idx") -> DataFrame:
    """0-based position by ``key`` inside each data set."""
    return range_index(df, [key], [source_col], name)


def global_pos(df: DataFrame, key: str, source_ord: str = "source_ord", name: str = "pos") -> DataFrame:
    """Position after concatenating data sets in ``source_ord`` order, each in ``key`` order."""
    return range_index(df, [source_ord, key], (), name)


def concat_positions(df: DataFrame, key: str, source_col: str = "source", source_ord: str = "source_ord", order_cols: Sequence | None = None) -> DataFrame:
    """W1 + W2 together: ``row_idx`` inside the data set and global ``pos``.

    Rows are ordered by ``order_cols`` (default: ``key``) inside a data set and data sets by
    ``(source_ord, source)``; null data sets and keys come first. The global position needs one
    range partitioning; a data set's first position, from an aggregate with one row per data set, gives the rest."""
    keys = list(dict.fromkeys([source_ord, source_col, *(order_cols if order_cols is not None else [key])]))
    numbered = _numbered(df.select(*keys), keys, (), "pos")
    first = numbered.groupBy(source_ord, source_col).agg(F.min("pos").alias("_start"))
    numbered = join_null_safe(numbered, first, [source_ord, source_col]).withColumn("row_idx", F.col("pos") - F.col("_start")).drop("_start")
    return attached(df, numbered, keys)


def batch_id(pos="pos", batch_size: int = 8) -> Column:
    """``floor(pos / B)``; the last batch may be short."""
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(p / batch_size).cast("bigint")


def max_samples(df: DataFrame, n: int | None, pos: str = "pos") -> DataFrame:
    """L1: the first ``n`` rows in concatenated order (all rows when ``n`` is None); a filter, no sort."""
    return df if n is None else df.where(F.col(pos) < n)


# Fixed values of the keyed permutation: the modulus of its round function, rounds, and most steps of a walk.
SHUFFLE_PRIME = (1 << 31) - 1
SHUFFLE_ROUNDS = 6
SHUFFLE_WALK = 32


def round_key(seed: int, epoch: int, i: int) -> int:
    return int(hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:8], 16) % SHUFFLE_PRIME


def _halves(n: int) -> tuple[int, int]:
    """Sides a, b of the smallest near-square with at least ``n`` places: fewer than a are beyond n."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, -(-max(n, 1) // a)


def _feistel(x: str, n: int, seed: int, epoch: int, forward: bool) -> str:
    """One pass of the Feistel network on ``x = l * b + r``, as SQL: in turn l and r get a keyed cube of the other added (or, backwards,
    taken away). The rounds are a fold over their keys."""
    a, b = _halves(n)
    order = range(SHUFFLE_ROUNDS) if forward else reversed(range(SHUFFLE_ROUNDS))
    rounds = ", ".join(f"named_struct('key', {round_key(seed, epoch, i)}L, 'left', {i % 2 == 0})" for i in order)
    sign, p = "+" if forward else "-", SHUFFLE_PRIME
    step = f"""transform(array((if(k.left, s.r, s.l) + k.key) % {p}L), y -> if(k.left,
        named_struct('l', pmod(s.l {sign} y * y % {p} * y % {p} % {a}, {a}L), 'r', s.r),
        named_struct('l', s.l, 'r', pmod(s.r {sign} y * y % {p} * y % {p} % {b}, {b}L))))[0]"""
    return f"aggregate(array({rounds}), named_struct('l', {x} div {b}L, 'r', {x} % {b}L), (s, k) -> {step}, s -> s.l * {b}L + s.r)"


def permuted(index: str, n: int, epoch: int, seed: int = 0, forward: bool = True) -> Column:
    """L3: where ``index`` of ``[0, n)`` goes in the epoch's random order (``forward=False``: where a place came from).

    A keyed Feistel permutation of a near-square of at least n places; a value beyond n is passed on until it falls below (cycle
    walking). Fewer than sqrt(n) + 1 values lie beyond, so 32 steps always do up to n = 1,024, and for larger n all but a
    share of n^-16; a longer walk is an error, never a wrong place. Computed per row, without an exchange."""
    n = max(int(n), 1)
    walk = f"aggregate(sequence(2, {SHUFFLE_WALK}), x, (v, i) -> if(v < {n}L, v, {_feistel('v', n, seed, epoch, forward)}))"
    found = f"transform(array({walk}), w -> if(w < {n}L, w, cast(raise_error('a walk of the shuffle is too long') as bigint)))[0]"
    return F.expr(f"transform(array({_feistel(f'cast(`{index}` as bigint)', n, seed, epoch, forward)}), x -> if(x < {n}L, x, {found}))[0]")


def shuffled_positions(df: DataFrame, epochs: Sequence[int] | int, seed: int = 0, pos: str = "pos", name: str = "shuffled_pos") -> DataFrame:
    """L3: for each epoch, every row's position in that epoch's random order (``permuted``).

    Positions that fill ``[0, n)`` are permuted where they are, without an exchange. Others (with gaps, where rows were rejected) are
    numbered first, which exchanges positions only."""
    ep = list(range(epochs)) if isinstance(epochs, int) else list(epochs)
    n, low, high, total = df.agg(F.count(pos), F.min(pos), F.max(pos), F.sum(F.col(pos).cast("decimal(38,0)"))).first()
    dense = n == 0 or (low == 0 and high == n - 1 and int(total) == n * (n - 1) // 2)
    rows = df.withColumn("_i", F.col(pos).cast("bigint")) if dense else range_index(df, [pos], (), "_i")
    places = F.array(*(F.struct(F.lit(e).alias("epoch"), permuted("_i", n, e, seed).alias("at")) for e in ep))
    return rows.select(*df.columns, F.explode(places).alias("_p")).select(*df.columns, F.col("_p.epoch").alias("epoch"), F.col("_p.at").alias(name))


def running_total(df: DataFrame, order_col: str, value_col: str, name: str, width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Cumulative sum of ``value_col`` along a unique integer ``order_col``.

    Two levels, so no task holds more than ``width`` rows or the block table:
    block totals are summed over the small block table, then added to a running
    sum inside each block."""
    blk = F.floor(F.col(order_col) / width)
    with_b = df.withColumn("_blk", blk)
    totals = with_b.groupBy("_blk").agg(F.sum(value_col).alias("_t"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_blk", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (
        with_b.join(offsets, "_blk")
        .withColumn(name, F.sum(value_col).over(inside) + F.col("_off"))
        .drop("_blk", "_off")
    )

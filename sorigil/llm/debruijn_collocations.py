"""Collocations from a weighted de Bruijn graph of the corpus, per language.

Nodes are word pairs, edges are word triples (the longest grams); an edge (a, b, c) leads from node (a, b) to node (b, c), and its
weight is how often the triple stands in a piece. Only edges are counted in the texts. Shorter counts follow from flow:

* f(a b) is the weight that leaves node (a, b): its edges, plus the pieces that end with it (edges to ``END``);
* f(a) is the weight of all nodes that begin with a, again with the pieces that end there.

1. ``word_table``: words of each language with a 64-bit code (a hash; were two words to share one, another seed is taken).
2. ``_count_edges``: every task counts the edges of a stretch of its texts and writes them, sorted and packed with the stretch's own
   word list, as one block per bucket; blocks of a bucket meet in one group of bounded size (``BUCKET`` edges on average; the
   hash is of the whole edge, so no word or pair makes a bucket large). Very many buckets are dealt in two steps.
3. Buckets emit their heavy edges and, again as blocks, the flow of their nodes; node buckets emit heavy nodes and the flow of words.
4. ``unary_paths``: a node whose whole flow enters by one edge and leaves by one is inside a unary path. Paths are compacted by
   pointer doubling (rounds grow with the logarithm of the longest path); inside a path every count is the path's weight, so
   only path ends are joined with the nodes.
5. ``collocations``: scores by exact decimal arithmetic (for counts up to 10^16), subsumed candidates go, best rows per language.

Defined results: a null text is empty, a null language is ``und``; repeated rows count each time; rows without words add nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorigil.llm.common import batches_of, slices, stored
from sorigil.llm.words import SEED, find_words, mix, table_of

#: Bytes that end a piece, and those that part words inside one.
SPLITS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
KEEP, SPLIT = table_of(SPLITS + BLANKS), ~table_of(SPLITS)
#: The code behind a piece's last word.
END = 0
#: Least count of a candidate, share (in percent) at which a longer one subsumes it, rows per language.
LEAST, SUBSUMED, TOP = 10, 50, 2000
#: Words counted at once in a task, edges of a bucket, buckets that a task deals to at once.
STRETCH, BUCKET, FANOUT = 1 << 21, 1 << 20, 2048
_ROWS, _BYTES = 4000, 8 << 20
#: Groups of the first ranking step.
SHARES = 64


@dataclass
class Stretch:
    """Words of some texts: their codes, and whether each is the last of its piece."""

    codes: np.ndarray
    last: np.ndarray


def _read(part: pa.RecordBatch, seed: int):
    """Words of a slice (columns lang, text), their codes by language, their row and whether they end a piece."""
    words = find_words(part.column(1), KEEP)
    row = np.repeat(np.arange(part.num_rows), np.diff(words.at))
    langs = [x if x is not None else "und" for x in part.column(0).to_pylist()]
    of = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    salt = np.array([of[x] for x in langs], np.uint64)
    codes = mix(words.hashes(seed) ^ salt[row])
    codes[codes == END] = 1
    piece = np.cumsum(SPLIT[words.data])[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    last = np.ones(len(codes), bool)
    last[:-1] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
    return words, codes, last, row, langs


def _count_words(seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, _ROWS, _BYTES):
            words, codes, _, row, langs = _read(part, seed)
            code, first, n = np.unique(codes, return_index=True, return_counts=True)
            raw = words.data.tobytes()
            names = [raw[s:e].decode() for s, e in zip(words.starts[first].tolist(), words.ends[first].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array([langs[r] for r in row[first].tolist()], pa.string()), pa.array(names, pa.string()), pa.array(n)], ["code", "lang", "word", "n"])


def word_table(texts: DataFrame) -> tuple[DataFrame, int]:
    """``code, lang, word, n`` of all words, and the seed of the codes."""
    seed = SEED
    while True:
        counted = texts.mapInArrow(partial(_count_words, seed), "code long, lang string, word string, n long")
        table = stored(counted.groupBy("code", "lang", "word").agg(F.sum("n").alias("n")), "collocation-words")
        if table.groupBy("code").count().where("count > 1").isEmpty():
            return table, seed
        seed += 1


@dataclass
class Edges:
    """Distinct edges in the order of their local word numbers (0 is END) with their weights; ``words`` are the codes of 1, 2, ..."""

    words: np.ndarray
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    n: np.ndarray

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        return np.r_[np.uint64(END), self.words][numbers]


def _summed(words: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> Edges:
    ab = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    order = np.lexsort((c, ab))
    ab, c = ab[order], c[order]
    new = np.ones(len(ab), bool)
    new[1:] = (ab[1:] != ab[:-1]) | (c[1:] != c[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(n[order], at) if len(at) else np.zeros(0, np.int64)
    ab = ab[at]
    return Edges(words, (ab >> np.uint64(32)).astype(np.uint32), (ab & np.uint64(0xFFFFFFFF)).astype(np.uint32), c[at], total)


def _edges_of(parts: list[Stretch]) -> Edges:
    codes, last = (np.concatenate([getattr(p, x) for p in parts]) for x in ("codes", "last"))
    words, number = np.unique(codes, return_inverse=True)
    a = (number + 1).astype(np.uint32)
    b = np.where(last, 0, np.r_[a[1:], 0]).astype(np.uint32)
    c = np.where(last | np.r_[last[1:], True], 0, np.r_[a[2:], 0, 0][: len(a)]).astype(np.uint32)
    return _summed(words, a, b, c, np.ones(len(a), np.int64))


def _packed(x: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compress well."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _block(e: Edges, some: np.ndarray) -> bytes:
    """The edges ``some`` with the words that they have."""
    used, number = np.unique(np.concatenate([e.a[some], e.b[some], e.c[some]]), return_inverse=True)
    if used[0] != 0:
        used, number = np.r_[np.uint32(0), used], number + 1
    a, b, c = number.astype(np.uint32).reshape(3, -1)
    step = np.diff(a, prepend=np.uint32(0))
    raw = b"".join([np.array([len(used) - 1, len(some)], np.int64).tobytes(), _packed(e.words[used[1:] - 1]), _packed(step), _packed(b), _packed(c), _packed(e.n[some])])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(raw: bytes, at: int, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).reshape(n)


def _opened(block: bytes) -> Edges:
    raw = pa.decompress(block[8:], int(np.frombuffer(block[:8], np.int64)[0]), "zstd", asbytes=True)
    k, n = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16 + 8 * k
    a = np.cumsum(_unpacked(raw, at, n, np.uint32), dtype=np.uint32)
    return Edges(_unpacked(raw, 16, k, np.uint64), a, _unpacked(raw, at + 4 * n, n, np.uint32), _unpacked(raw, at + 8 * n, n, np.uint32), _unpacked(raw, at + 12 * n, n, np.int64))


def _merged(blocks: list[bytes]) -> Edges:
    parts = [_opened(x) for x in blocks]
    words = np.unique(np.concatenate([p.words for p in parts]))
    numbers = [np.r_[0, np.searchsorted(words, p.words) + 1].astype(np.uint32) for p in parts]
    a, b, c = (np.concatenate([m[getattr(p, x)] for m, p in zip(numbers, parts)]) for x in "abc")
    return _summed(words, a, b, c, np.concatenate([p.n for p in parts]))


def _bucket(e: Edges, buckets: int) -> np.ndarray:
    h = mix(e.codes(e.a) ^ mix(e.codes(e.b) ^ mix(e.codes(e.c) + np.uint64(1))))
    return (h % np.uint64(buckets)).astype(np.int64)


def _dealt(e: Edges, buckets: int, per: int = 1) -> Iterator[tuple[int, bytes]]:
    """A block for each bucket (of ``per`` buckets together) that has edges."""
    of = _bucket(e, buckets) // per
    order = np.argsort(of, kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(of[order]) != 0, True]) + 1 if len(order) else []
    lo = 0
    for hi in ends:
        yield int(of[order[lo]]), _block(e, order[lo:hi])
        lo = hi


BLOCKS = "bucket int, block binary"


def _rows(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in pairs], pa.int32()), pa.array([b for _, b in pairs], pa.binary())], ["bucket", "block"])


def _count_edges(seed: int, buckets: int, per: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[Stretch] = []
    for batch in batches:
        for part in slices(batch, _ROWS, _BYTES):
            _, codes, last, _, _ = _read(part, seed)
            if len(codes):
                held.append(Stretch(codes, last))
            if sum(len(s.codes) for s in held) >= STRETCH:
                yield _rows(list(_dealt(_edges_of(held), buckets, per)))
                held = []
    if held:
        yield _rows(list(_dealt(_edges_of(held), buckets, per)))


def _deal_again(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of several buckets, merged and dealt to the single ones."""
    held, size = [], 0
    for batch in batches:
        for block in batch.column("block").to_pylist():
            held.append(block)
            size += int(np.frombuffer(block[:8], np.int64)[0])
            if size >= 20 * STRETCH:
                yield _rows(list(_dealt(_merged(held), buckets)))
                held, size = [], 0
    if held:
        yield _rows(list(_dealt(_merged(held), buckets)))


HEAVY = "kind string, a long, b long, c long, n long, bucket int, block binary"


def _emitted(kind: str, a=None, b=None, c=None, n=None, blocks: list[tuple[int, bytes]] = ()) -> pa.Table:
    size = len(blocks) if blocks else len(a)
    longs = [pa.nulls(size, pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (a, b, c, n)]
    packed = [pa.array([k for k, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())] if blocks else [pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())]
    return pa.table([pa.array([kind] * size, pa.string()), *longs, *packed], ["kind", "a", "b", "c", "n", "bucket", "block"])


def _flow(e: Edges, keys: tuple[str, ...]) -> Edges:
    """Weights summed over what follows the first words."""
    zero = np.zeros(len(e.a), np.uint32)
    return _summed(e.words, e.a, e.b if "b" in keys else zero, zero, e.n)


def _edge_merger(least: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def merge(group: pa.Table) -> pa.Table:
        e = _merged(group.column("block").to_pylist())
        heavy = (e.n >= least) & (e.c != 0)
        nodes = list(_dealt(_flow(e, ("a", "b")), buckets))
        return pa.concat_tables([_emitted("edge", *(e.codes(x[heavy]) for x in (e.a, e.b, e.c)), e.n[heavy]), _emitted("flow", blocks=nodes)])

    return merge


def _node_merger(least: int) -> Callable[[pa.Table], pa.Table]:
    def merge(group: pa.Table) -> pa.Table:
        e = _merged(group.column("block").to_pylist())
        heavy = (e.n >= least) & (e.b != 0)
        w = _flow(e, ("a",))
        return pa.concat_tables([_emitted("node", e.codes(e.a[heavy]), e.codes(e.b[heavy]), None, e.n[heavy]), _emitted("word", w.codes(w.a), None, None, w.n)])

    return merge


@dataclass
class Graph:
    """Heavy ``edges`` (a, b, c, n) and ``nodes`` (a, b, n), the flow of all words that may stand in them (``a, n``), and the words' table."""

    edges: DataFrame
    nodes: DataFrame
    flow: DataFrame
    words: DataFrame


def graph(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", bucket: int = BUCKET, fanout: int = FANOUT) -> Graph:
    """The weighted graph of ``docs``; counts are exact, only what is heavier than ``least`` is written apart."""
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    with batches_of(spark, 1000):
        words, seed = word_table(texts)
        total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        buckets = max(1, -(-total // bucket))
        per = -(-buckets // fanout)
        blocks = texts.mapInArrow(partial(_count_edges, seed, buckets, per), BLOCKS)
        if per > 1:  # a first exchange of coarse buckets, each shared by many tasks
            blocks = blocks.repartition("bucket", F.pmod(F.xxhash64("block"), F.lit(64))).mapInArrow(partial(_deal_again, buckets), BLOCKS)
        edges = stored(blocks.groupBy("bucket").applyInArrow(_edge_merger(least, buckets), HEAVY), "collocation-edges")
        flows = edges.where("kind = 'flow'").select("bucket", "block")
        nodes = stored(flows.groupBy("bucket").applyInArrow(_node_merger(least), HEAVY), "collocation-nodes")
    flow = nodes.where("kind = 'word'").groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return Graph(edges.where("kind = 'edge'").select("a", "b", "c", "n"), nodes.where("kind = 'node'").select("a", "b", "n"), flow, words)


def unary_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every edge with its unary path: the path's first edge (``pa, pb, pc``), its place ``at`` in it and whether it is the ``last``.

    An edge whose node before it is unary points to the edge before; pointers are doubled until all reach a first edge. Paths end,
    since every piece does: a circle of unary nodes would be a text without end."""
    x, into, out = nodes.alias("x"), edges.alias("i"), edges.alias("o")
    inner = x.join(into, (F.col("i.b") == F.col("x.a")) & (F.col("i.c") == F.col("x.b")) & (F.col("i.n") == F.col("x.n")))
    inner = inner.join(out, (F.col("o.a") == F.col("x.a")) & (F.col("o.b") == F.col("x.b")) & (F.col("o.n") == F.col("x.n")))
    links = stored(inner.select(F.col("o.a").alias("a"), F.col("o.b").alias("b"), F.col("o.c").alias("c"), F.col("i.a").alias("pa"), F.col("i.b").alias("pb"), F.col("i.c").alias("pc"), F.lit(1).cast("long").alias("at")), "path-links")
    paths = links.withColumn("more", F.lit(True))
    while not paths.where("more").isEmpty():
        goal = paths.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("c").alias("pc"), *(F.col(c).alias(f"next_{c}") for c in ("pa", "pb", "pc", "at")))
        moved = paths.where("more").drop("more").join(goal, ["pa", "pb", "pc"], "left")
        moved = moved.select("a", "b", "c", *(F.coalesce(f"next_{c}", c).alias(c) for c in ("pa", "pb", "pc")), (F.col("at") + F.coalesce("next_at", F.lit(0))).alias("at"), F.col("next_at").isNotNull().alias("more"))
        paths = stored(paths.where("not more").unionByName(moved), "path-pointers")
    placed = paths.drop("more")
    before = links.select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("pc").alias("c"), F.lit(False).alias("last"))
    every = edges.join(placed, ["a", "b", "c"], "left").join(before, ["a", "b", "c"], "left")
    first = {"pa": "a", "pb": "b", "pc": "c"}
    return every.select("a", "b", "c", "n", *(F.coalesce(p, e).alias(p) for p, e in first.items()), F.coalesce("at", F.lit(0)).alias("at"), F.coalesce("last", F.lit(True)).alias("last"))


def scored(n: str, left: str, right: str) -> Column:
    """floor(10^6 n n / (left right)), exactly; an error, never a wrong value, for counts from 10^16."""
    wide = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide(n)} * {wide(n)})) div ({wide(left)} * {wide(right)})")


def _triples(g: Graph, paths: DataFrame, of: DataFrame) -> DataFrame:
    """Candidates of three words. Inside a path the pairs' counts are its weight; path ends take them from the nodes."""
    first, last = F.col("at") == 0, F.col("last")
    ends = paths.select("*", *(F.when(first, F.col(c)).alias(f"l_{c}") for c in ("a", "b")), *(F.when(last, F.col(c)).alias(f"r_{c}") for c in ("b", "c")))
    left, right = (g.nodes.select(F.col("a").alias(x), F.col("b").alias(y), F.col("n").alias(name)) for x, y, name in (("l_a", "l_b", "l_n"), ("r_b", "r_c", "r_n")))
    rows = ends.join(left, ["l_a", "l_b"], "left").join(right, ["r_b", "r_c"], "left")
    rows = rows.withColumns({"ab": F.coalesce("l_n", "n"), "bc": F.coalesce("r_n", "n")})
    for c in ("a", "b", "c"):
        rows = rows.join(of.select(F.col("a").alias(c), F.col("n").alias(f"f_{c}"), F.col("word").alias(f"w_{c}"), F.col("lang").alias(f"lang_{c}")), c)
    rows = rows.withColumns({"s1": scored("n", "f_a", "bc"), "s2": scored("n", "ab", "f_c")})
    one = F.col("s1") <= F.col("s2")
    return rows.select(
        F.col("lang_a").alias("lang"), F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"), F.col("n").alias("a"),
        F.when(one, F.col("f_a")).otherwise(F.col("ab")).alias("l"), F.when(one, F.col("bc")).otherwise(F.col("f_c")).alias("r"), F.least("s1", "s2").alias("score"),
    )


def _pairs(g: Graph, of: DataFrame, subsumed: int) -> DataFrame:
    """Candidates of two words that no triple subsumes."""
    longer = g.edges.select("a", "b", "n").union(g.edges.select(F.col("b").alias("a"), F.col("c").alias("b"), "n")).groupBy("a", "b").agg(F.max("n").alias("longest"))
    rows = g.nodes.join(longer, ["a", "b"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < subsumed * F.col("n")))
    for c in ("a", "b"):
        rows = rows.join(of.select(F.col("a").alias(c), F.col("n").alias(f"f_{c}"), F.col("word").alias(f"w_{c}"), F.col("lang").alias(f"lang_{c}")), c)
    return rows.select(
        F.col("lang_a").alias("lang"), F.concat_ws(" ", "w_a", "w_b").alias("phrase"), F.col("n").alias("a"),
        F.col("f_a").alias("l"), F.col("f_b").alias("r"), scored("n", "f_a", "f_b").alias("score"),
    )


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP, lang_col: str = "lang", text_col: str = "text", bucket: int = BUCKET, fanout: int = FANOUT) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    g = graph(docs, least, lang_col, text_col, bucket, fanout)
    names = g.words.select(F.col("code").alias("a"), "lang", "word")
    of = stored(g.flow.join(names, "a"), "collocation-flow")
    found = _triples(g, unary_paths(g.edges, g.nodes), of).unionByName(_pairs(g, of, subsumed))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = g.words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

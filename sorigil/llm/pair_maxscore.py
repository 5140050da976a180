"""Ranked lexical search with pair-bound MaxScore over an index sharded by documents.

1. ``raw_shards``: one scan of the texts. Documents go into shards of bounded size (sorted by id, so that places are in
   the order of ties); a shard is one row with the postings (place, frequency) of the terms that the items have. Document
   lengths and totals count every term.
2. ``impact_shards``: with the totals known, frequencies become exact integer impacts. Each shard stores, per term, its
   postings and maximum impact, and for each planned pair of terms the intersection list with the *joint* maximum impact.
   Pairs are planned by matching each item's terms (heaviest with next heaviest), so their number is linear in the items' terms.
3. ``search``: per shard and item, pairs are visited by falling bound. A document holds both terms of a pair (at most the joint
   maximum) or one (at most the larger single maximum); the pair's bound is the larger of these, which is less than the sum
   of two independent maxima. Once the bounds still to come cannot lift an unseen document to the k-th best sum so far, only
   documents already met are scored on; a pair whose single maxima cannot but whose joint maximum can brings in its intersection
   list alone. Bounds are compared with ``<``, so documents that tie are never skipped.

Each task keeps the best k scores per item over its shards; ranks come from windows in two steps (buckets of documents, then all).
The items go along in blocks of bounded text (a larger set is more passes); the terms' counts are as many as a block's terms.

Defined results: a null or empty text has no terms and is no document of N; a repeated doc_id is a document for each row; items
are grouped by item_id (null included) and take the terms of all their rows; an item without terms, or without documents
above 0, has no rows; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sorigil.llm.common import batches_of, slices, stored
from sorigil.llm.words import ALNUM, find_words

#: Bounds of a shard, bytes of item texts in a block, buckets of the first ranking step.
SHARD_ROWS, SHARD_BYTES, BLOCK_BYTES, BUCKETS = 2000, 8 << 20, 16 << 20, 64
TOP = 10

# The scoring rule of the contract.
WEIGHT, IMPACT, LENGTH_SHARE = 1000, 1_000_000_000, 90


@dataclass
class Items:
    """A block of items: ids and, for each, the numbers of its terms in ``terms`` (sorted by hash)."""

    ids: list
    terms_of: list[np.ndarray]
    texts: list[bytes]
    hashes: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.hashes = find_words(pa.array([t.decode() for t in self.texts], pa.string()), ALNUM).hashes()
        order = np.argsort(self.hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.hashes, self.texts = self.hashes[order], [self.texts[i] for i in order]
        self.terms_of = [np.sort(rank[t]) for t in self.terms_of]
        if len(order) and (np.diff(self.hashes) == 0).any():
            raise ValueError("two terms of the items have one hash")
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.at = np.r_[0, np.cumsum(self.sizes)].astype(np.int64)


def words_of(text: str | None) -> list[bytes]:
    words = find_words(pa.array([text], pa.string()), ALNUM)
    raw = words.data.tobytes()
    return [raw[s:e] for s, e in zip(words.starts.tolist(), words.ends.tolist())]


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about ``size`` bytes of text; all rows of an item are in one block."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    n = max(1, -(-(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // size))
    for k in range(n):
        of: dict = {}
        for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k).collect():
            of.setdefault(r["id"], set()).update(words_of(r["t"]))
        of = {i: terms for i, terms in of.items() if terms}
        number = {t: j for j, t in enumerate(sorted(set().union(*of.values())))} if of else {}
        yield Items(list(of), [np.array(sorted(number[t] for t in terms), np.int64) for terms in of.values()], list(number))


def term_numbers(words, items: Items) -> np.ndarray:
    """The number of each word among the items' terms, -1 for others; found by hash, confirmed byte by byte."""
    h = words.hashes()
    if not len(items.hashes) or not len(h):
        return np.full(len(h), -1, np.int64)
    at = np.minimum(np.searchsorted(items.hashes, h), len(items.hashes) - 1)
    size = words.ends - words.starts
    found = np.flatnonzero((items.hashes[at] == h) & (items.sizes[at] == size))
    for lo in range(0, len(found), 1 << 18):
        some = found[lo : lo + (1 << 18)]
        n = size[some]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = words.data[np.repeat(words.starts[some], n) + inside] == items.data[np.repeat(items.at[at[some]], n) + inside]
        at[some[np.add.reduceat(~same, np.cumsum(n) - n) > 0]] = -1
    out = np.full(len(h), -1, np.int64)
    out[found] = at[found]
    return out


def _ints(x: np.ndarray) -> list[np.ndarray]:
    return [np.asarray(x, np.int64)]


def _lists(*columns: np.ndarray) -> list[pa.Array]:
    """One-row list columns of longs."""
    return [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(np.asarray(c, np.int64))) for c in columns]


LONGS = T.ArrayType(T.LongType())
RAW = ("lengths", "terms", "counts", "docs", "tfs")
SHARD = ("terms", "counts", "docs", "impacts", "most", "pair_a", "pair_b", "pair_most", "pair_counts", "pair_docs")


def _index(items: Items, id_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, SHARD_ROWS, SHARD_BYTES):
            part = part.take(pc.sort_indices(part.column(0), sort_keys=[("", "ascending")], null_placement="at_start"))
            words = find_words(part.column(1), ALNUM)
            number = term_numbers(words, items)
            row = np.repeat(np.arange(part.num_rows), np.diff(words.at))
            mine = number >= 0
            key, tf = np.unique(number[mine] * part.num_rows + row[mine], return_counts=True)
            term, doc = np.divmod(key, part.num_rows)
            terms, counts = np.unique(term, return_counts=True)
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0).cast(id_type))
            yield pa.RecordBatch.from_arrays([ids, *_lists(np.diff(words.at), terms, counts, doc, tf)], ["ids", *RAW])


def raw_shards(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), *(T.StructField(c, LONGS) for c in RAW)])
    with batches_of(docs.sparkSession, SHARD_ROWS):
        return stored(rows.mapInArrow(partial(_index, items, to_arrow_type(kind)), schema), "search-postings")


@dataclass
class Plan:
    """What every shard needs: totals, term weights and the pairs to store."""

    n_docs: int
    n_terms: int
    weights: np.ndarray
    pairs: np.ndarray
    pairs_of: list[list[tuple[int, int]]]


def plan(raw: DataFrame, items: Items) -> Plan:
    """Totals over all documents, weights, and each item's terms matched into pairs by falling weight."""
    held = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + F.when(n > 0, 1).otherwise(0))
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    n_docs, n_terms = raw.select(held.alias("d"), total.alias("t")).agg(F.coalesce(F.sum("d"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    df = np.zeros(len(items.texts), np.int64)
    per_term = raw.select(F.explode(F.arrays_zip("terms", "counts")).alias("z")).groupBy("z.terms").agg(F.sum("z.counts").alias("df"))
    for r in per_term.collect():  # at most one row per term of this block of items
        df[r["terms"]] = r["df"]
    weights = np.array([math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
    pairs_of = []
    for terms in items.terms_of:
        order = sorted((t for t in terms.tolist() if weights[t] > 0), key=lambda t: (-weights[t], t))
        pairs_of.append([(a, b) for a, b in zip(order[::2], [*order[1::2], -1])] if len(order) % 2 else list(zip(order[::2], order[1::2])))
    every = sorted({(a, b) for pairs in pairs_of for a, b in pairs if b >= 0})
    return Plan(int(n_docs), int(n_terms), weights, np.array(every, np.int64).reshape(-1, 2), pairs_of)


def impacts_of(plan: Plan, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * plan.n_docs) // max(plan.n_terms, 1)
    return plan.weights[term] * ((IMPACT * tf) // (1000 * tf + 8 * m))


def _pairs(plan: Plan, n_docs: int, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray, impacts: np.ndarray) -> list[np.ndarray]:
    """The planned pairs that meet in this shard: terms, joint maximum, intersection lists."""
    place = np.full(len(plan.weights), -1, np.int64)
    place[terms] = np.arange(len(terms))
    a, b = (place[plan.pairs[:, i]] for i in (0, 1))
    kept, most, counts, lists = [], [], [], []
    score, mark = np.zeros(n_docs, np.int64), np.full(n_docs, -1, np.int64)
    last = -1
    for k in np.flatnonzero((a >= 0) & (b >= 0)).tolist():
        x, y = (slice(starts[p], starts[p + 1]) for p in (a[k], b[k]))
        if a[k] != last:
            last = int(a[k])
            score[docs[x]], mark[docs[x]] = impacts[x], last
        both = mark[docs[y]] == last
        if both.any():
            kept.append(k)
            common = docs[y][both]
            most.append(int((score[common] + impacts[y][both]).max()))
            counts.append(len(common))
            lists.append(common)
    pairs = plan.pairs[kept] if kept else np.zeros((0, 2), np.int64)
    return [pairs[:, 0], pairs[:, 1], np.array(most, np.int64), np.array(counts, np.int64), np.concatenate(lists) if lists else np.zeros(0, np.int64)]


def _row(batch: pa.RecordBatch, r: int, names: tuple[str, ...]) -> list[np.ndarray]:
    return [batch.column(n)[r].values.to_numpy(zero_copy_only=False) for n in names]


def _with_impacts(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            lengths, terms, counts, docs, tfs = _row(batch, r, RAW)
            starts = np.r_[0, np.cumsum(counts)].astype(np.int64)
            impacts = impacts_of(plan, np.repeat(terms, counts), tfs, lengths[docs])
            most = np.maximum.reduceat(impacts, starts[:-1]) if len(terms) else impacts
            pairs = _pairs(plan, len(lengths), terms, starts, docs, impacts)
            yield pa.RecordBatch.from_arrays([batch.column("ids").slice(r, 1), *_lists(terms, counts, docs, impacts, most, *pairs)], ["ids", *SHARD])


def impact_shards(raw: DataFrame, plan: Plan) -> DataFrame:
    schema = T.StructType([raw.schema["ids"], *(T.StructField(c, LONGS) for c in SHARD)])
    with batches_of(raw.sparkSession, 1):
        return stored(raw.mapInArrow(partial(_with_impacts, plan), schema), "search-index")


class Shard:
    def __init__(self, n_docs: int, terms, counts, docs, impacts, most, pair_a, pair_b, pair_most, pair_counts, pair_docs) -> None:
        self.n_docs, self.docs, self.impacts = n_docs, docs, impacts
        ends = np.cumsum(counts).tolist()
        self.lists = {t: (slice(e - c, e), m) for t, c, e, m in zip(terms.tolist(), counts.tolist(), ends, most.tolist())}
        pair_ends = np.cumsum(pair_counts).tolist()
        self.pairs = {(a, b): (m, pair_docs[e - c : e]) for a, b, m, c, e in zip(pair_a.tolist(), pair_b.tolist(), pair_most.tolist(), pair_counts.tolist(), pair_ends)}

    def best(self, pairs: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that may be among the k best, given that scores below ``least`` are not."""
        units = []
        for a, b in pairs:
            lists = [self.lists[t] for t in (a, b) if t in self.lists]
            if lists:
                single = max(m for _, m in lists)
                joint, common = self.pairs.get((a, b), (0, None))
                units.append((max(single, joint), single, common, [s for s, _ in lists]))
        units.sort(key=lambda u: -u[0])
        rest = sum(u[0] for u in units)
        score, met = np.zeros(self.n_docs, np.int64), np.zeros(self.n_docs, bool)
        least = max(least, 1)
        for bound, single, common, lists in units:
            rest -= bound
            every = single + rest >= least
            if not every and bound + rest >= least and common is not None:
                met[common] = True
            for s in lists:
                docs = self.docs[s]
                if every:
                    score[docs] += self.impacts[s]
                    met[docs] = True
                else:
                    mine = met[docs]
                    score[docs[mine]] += self.impacts[s][mine]
            if self.n_docs > k:
                least = max(least, int(np.partition(score, self.n_docs - k)[self.n_docs - k]))
            met &= score + rest >= least
            if not met.any() and rest < least:
                break
        found = np.flatnonzero(met & (score >= least))
        found = found[np.argsort(-score[found], kind="stable")][:k]
        return found, score[found]


def _search(ids: list, id_type: pa.DataType, plan: Plan, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best = [np.zeros(0, np.int64) for _ in ids]
    for batch in batches:
        for r in range(batch.num_rows):
            own = batch.column("ids")[r].values
            shard = Shard(len(own), *_row(batch, r, SHARD))
            item, place, score = [], [], []
            for i, pairs in enumerate(plan.pairs_of):
                found, scores = shard.best(pairs, k, int(best[i][0]) if len(best[i]) == k else 1)
                best[i] = np.sort(np.r_[best[i], scores])[-k:]
                item += [i] * len(found)
                place.append(found)
                score.append(scores)
            if item:
                columns = [pa.array(ids, id_type).take(pa.array(item)), own.take(pa.array(np.concatenate(place))), pa.array(np.concatenate(score))]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])


def _block(docs: DataFrame, items: Items, item_type: T.DataType, k: int, id_col: str, text_col: str) -> DataFrame:
    raw = raw_shards(docs, items, id_col, text_col)
    planned = plan(raw, items)
    index = impact_shards(raw, planned)
    schema = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    with batches_of(docs.sparkSession, 1):
        return stored(index.mapInArrow(partial(_search, items.ids, to_arrow_type(item_type), planned, k), schema), "search-found")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    kind = items.schema[item_col].dataType
    found = reduce(DataFrame.unionByName, [_block(docs, block, kind, k, id_col, text_col) for block in item_blocks(items, item_col, item_text, block_bytes)])
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    some = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "score"), F.lit(BUCKETS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "bucket").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

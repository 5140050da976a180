"""Benchmark decontamination with an FM-index per shard of training texts.

Each task cuts its documents into shards of bounded size and indexes a shard's words: words that no
benchmark item has cannot be part of a match and become separators, as do the ends of documents. All
benchmark windows are then searched backwards at once through the wavelet tree, occurrences are placed by
the sampled suffix positions, and the covered words of a document are merged to spans.

No text is shuffled. The benchmark is the stated query set: it goes to the tasks in blocks of at most
``BLOCK_BYTES`` of text (measured first); one block is the usual case, and each further block is one more pass that
carries the spans found so far.

Results: null texts and texts without words have no words, no hits and are not contaminated. A null or
wordless benchmark text has no window. Repeated rows get their own result each; benchmark rows with one item_id
count as one item, a null item_id counts as the empty id. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.llm.common import slices, stored
from sorigil.llm.fm_index import FmIndex
from sorigil.llm.words import ALNUM, find_words

WINDOW = 13  # contract: words in a window
SHARE = 20  # contract: contaminated from one twentieth of the words
BLOCK_BYTES = 16 << 20
SHARD_BYTES, SHARD_ROWS = 6 << 20, 20_000
SHARD_WORDS = 1 << 20  # a longer document is indexed in overlapping pieces


class Phrases:
    """The windows of a block of items: distinct, as right-aligned symbols over the items' words."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW):
        words = find_words(pa.array(texts, pa.string()), ALNUM)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        symbols = np.searchsorted(self.vocabulary, hashes) + 1
        known: dict[bytes, int] = {}
        rows, pairs, names = [], set(), {}
        for i, (a, b) in enumerate(zip(words.at[:-1], words.at[1:])):
            item = names.setdefault(ids[i], len(names))
            for at in range(a, max(a + 1, b - window + 1) if b > a else a):
                row = np.zeros(window, np.int64)
                part = symbols[at : min(b, at + window)]
                row[window - len(part) :] = part
                pairs.add((known.setdefault(row.tobytes(), len(known)), item))
                if len(known) > len(rows):
                    rows.append(row)
        self.rows = np.array(rows, np.int64).reshape(-1, window)
        self.lengths = np.count_nonzero(self.rows, axis=1)
        pair = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.item = pair[:, 1]
        self.item_at = np.searchsorted(pair[:, 0], np.arange(len(rows) + 1))
        self.names = np.array(list(names), object)

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def occurrences(self, symbols: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence in a shard's words; ``cuts``: words that begin a document."""
        word = np.flatnonzero(symbols)
        if not len(word) or not len(self.rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        document = np.cumsum(cuts)[word]
        apart = np.r_[False, (np.diff(word) > 1) | (np.diff(document) > 0)]
        place = np.arange(len(word)) + np.cumsum(apart)
        text = np.zeros(place[-1] + 2, np.int64)
        text[place] = symbols[word]
        word_at = np.zeros(len(text), np.int64)
        word_at[place] = word
        index = FmIndex(text, len(self.vocabulary))
        lo, hi = index.search(self.rows, self.lengths)
        n = hi - lo
        phrase = np.repeat(np.arange(len(n)), n)
        row = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return phrase, word_at[index.locate(row)]


def pieces(n: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        yield at, min(n, at + size)
        if at + size >= n:
            return
        at += size - overlap


def search_shard(column: pa.Array, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[set[str]], list[list[int]]]:
    """Words, hit words, items and merged word spans (start, end, start, ...) of every row of a shard."""
    words = find_words(column, ALNUM)
    n = len(words.starts)
    symbols = phrases.symbols_of(words.hashes())
    cuts = np.zeros(n + 1, np.int64)
    np.add.at(cuts, words.at[:-1], 1)
    found = [(p, w + a) for a, b in pieces(n, SHARD_WORDS * 2, WINDOW - 1) for p, w in [phrases.occurrences(symbols[a:b], cuts[a:b])]]
    phrase, first = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + phrases.lengths[phrase], -1)
    hit = np.cumsum(change)[:-1] > 0
    total = np.r_[0, np.cumsum(hit)]
    n_hit = total[words.at[1:]] - total[words.at[:-1]]
    items: list[set[str]] = [set() for _ in range(len(column))]
    spans: list[list[int]] = [[] for _ in range(len(column))]
    row = np.searchsorted(words.at, first, "right") - 1
    for r, p in np.unique(np.stack([row, phrase], 1), axis=0).tolist() if len(row) else ():
        items[r].update(phrases.names[phrases.item[phrases.item_at[p] : phrases.item_at[p + 1]]])
    for r in np.flatnonzero(n_hit).tolist():
        mine = np.r_[False, hit[words.at[r] : words.at[r + 1]], False]
        spans[r] = np.flatnonzero(mine[1:] != mine[:-1]).tolist()
    return np.diff(words.at), n_hit, items, spans


FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])


def _search(phrases: Phrases, text_at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds this block's spans and items to the last column of every row."""
    for batch in batches:
        for part in slices(batch, SHARD_ROWS, SHARD_BYTES):
            n_words, _, items, spans = search_shard(part.column(text_at), phrases)
            earlier = part.column(part.num_columns - 1).to_pylist()
            found = [
                {"n_words": n, "spans": merge(e["spans"], s) if e else s, "items": sorted(i.union(e["items"]) if e else i)}
                for n, s, i, e in zip(n_words.tolist(), spans, items, earlier)
            ]
            kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
            yield part.set_column(part.num_columns - 1, "found", pa.array(found, kind))


def merge(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[Phrases]:
    """The benchmark's windows in blocks of about ``size`` bytes of text."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("t"))
    n = max(1, -(-(items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // size))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == k).collect()
        yield Phrases([r["id"] for r in rows], [r["t"] for r in rows])


def find_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", bench_id: str = "item_id", bench_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a column ``found``: n_words, merged word spans of all occurrences, sorted item ids."""
    schema = T.StructType([*docs.schema.fields, T.StructField("found", FOUND)])
    out, first = docs.withColumn("found", F.lit(None).cast(FOUND)), True
    for phrases in blocks(benchmark, bench_id, bench_text, block_bytes):
        out = (out if first else stored(out, "passages")).mapInArrow(partial(_search, phrases, docs.columns.index(text_col)), schema)
        first = False
    return out


def hit_words() -> Column:
    signed = F.transform("found.spans", lambda at, i: F.when(i % 2 == 1, at).otherwise(-at))  # ends less starts
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, b: a + b)


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("found.n_words"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its counts, the digest of its items and the verdict."""
    found = find_passages(docs.select(id_col, text_col), benchmark, text_col).withColumn("n_hit", hit_words())
    return found.select(
        id_col, F.col("found.n_words").alias("n_words"), "n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    every = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    found = find_passages(docs.select(F.col(text_col).alias("text"), every), benchmark).withColumn("n_hit", hit_words())
    return found.where(~contaminated()).select("row.*")


def cut_spans(text: str | None, spans: list[int]) -> str | None:
    """``text`` without the words of ``spans`` and what stands between them."""
    if text is None or not spans:
        return text
    words, raw = find_words(pa.array([text]), ALNUM), text.encode()
    out, at = [], 0
    for s, e in zip(spans[::2], spans[1::2]):
        out.append(raw[at : words.starts[s]])
        at = int(words.ends[e - 1])
    return b"".join([*out, raw[at:]]).decode()

"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words (ASCII letters, digits and all other scripts; A-Z lower-cased) and the first
5 and 7 bytes of longer words, hashed to ``BUCKETS``. A bucket's value is log(1 + count); one more input is the
length class of the text. The score is the logistic of a bias, a linear weight per input and, for every
pair of inputs, the inner product of their factors: an insult can weigh more beside a mention of a group, or
less in a very long text, which a sum of single weights cannot say.

Fitting uses at most about ``SAMPLE`` labelled documents, chosen by a hash of their id, none of them held out
(crc32 of the id modulo 3 is 1). Every term is an input: the ``OWN`` buckets that differ most between the classes one
by one have a cell each, all others share ``SHARED`` cells by their hash, so what reaches the driver is bounded by the
sample and by these widths. Adaptive gradient steps over mini-batches fit the machine there in two stages: first the
terms that tell alone, then all terms together on what is left to explain. The second stage finds pairs of terms that
are even between the classes alone; with little left to explain its steps are small, so it does not learn the sample by
heart. Every document is then scored in one scan; only the model (five megabytes) is sent along. Labels, language,
source and id are never inputs.

Results: null and empty texts score like any text without known terms. A label that comes several times for an
id counts once, as toxic if any row says so; null labels are no labels. An id with several texts is learnt from the least. Without labels of both classes
every score is the share of toxic ones (0 without any). Rows that repeat an id are scored each; a null id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.llm.common import slices, stored
from sorigil.llm.words import ALNUM, Words, find_words, mix

BUCKETS = 1 << 20
PREFIXES = (5, 7)
SAMPLE = 20_000
OWN, SHARED = 2048, 1 << 16
LEAST_DOCS, LEAST_Z = 3, 3.0  # a bucket with a cell of its own: documents it is in, and standard errors between the classes
FACTORS = 8
LENGTHS = 24  # length classes: powers of two of the number of words
THRESHOLD = 0.7  # contract
HELD_OUT = 1  # contract: crc32 of the id modulo 3


def term_counts(column: pa.Array, cells: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of all distinct terms, and the words of each row. With ``cells`` (a cell for each
    bucket) the terms are counted by their cells."""
    words = find_words(column, ALNUM)
    row = np.repeat(np.arange(len(column)), np.diff(words.at))
    rows, hashes = [row], [words.hashes()]
    for k in PREFIXES:
        longer = words.ends - words.starts > k
        starts = words.starts[longer]
        hashes.append(mix(Words(words.data, starts, starts + k, words.at).hashes() + np.uint64(k)))
        rows.append(row[longer])
    row, bucket = np.concatenate(rows), (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)
    if cells is not None:
        bucket = cells[bucket]
    pair, n = np.unique(row * BUCKETS + bucket, return_counts=True)
    return pair // BUCKETS, pair % BUCKETS, n, np.diff(words.at)


def length_class(n_words: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n_words + 1).astype(np.int64), LENGTHS - 1)


@dataclass
class Machine:
    """Buckets with cells of their own, then bias, weights and factors by cell: own cells, length classes, shared cells."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def cells(self) -> np.ndarray:
        """The cell of every bucket."""
        out = len(self.buckets) + LENGTHS + (np.arange(BUCKETS) & (SHARED - 1))
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def entries(self, row: np.ndarray, cell: np.ndarray, count: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, value) of the terms and of the length class of every row."""
        every = np.arange(len(n_words))
        return np.r_[row, every], np.r_[cell, len(self.buckets) + length_class(n_words)], np.r_[np.log1p(count), np.ones(len(n_words))]

    def probability(self, row: np.ndarray, cell: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        raw = self.bias + np.bincount(row, x * self.weights[cell], n)
        for factor in self.factors.T:  # all pairs: half of the squared sum less the sum of squares
            own = x * factor[cell]
            raw += 0.5 * (np.bincount(row, own, n) ** 2 - np.bincount(row, own**2, n))
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


@dataclass(frozen=True)
class Stage:
    """Gradient steps: rounds over the sample, rate, first sum of squares, decay of weights and factors, documents a step."""

    epochs: int
    rate: float
    floor: float
    decay: float
    factor_decay: float
    batch: int


ALONE = Stage(epochs=30, rate=0.25, floor=1e-2, decay=1e-6, factor_decay=1e-6, batch=256)
TOGETHER = Stage(epochs=20, rate=0.05, floor=1e-2, decay=1e-5, factor_decay=1e-4, batch=128)
Document = tuple[np.ndarray, np.ndarray, int]  # cells, counts, words


def fit(m: Machine, rows: list[Document], labels: np.ndarray, stage: Stage) -> None:
    """Adaptive gradient steps over shuffled mini-batches. A batch is a dense matrix over the cells it has, never
    wider than the machine."""
    rng = np.random.default_rng(7)
    sum_b, sum_w, sum_v = stage.floor, np.full(m.weights.shape, stage.floor), np.full(m.factors.shape, stage.floor)
    order = np.arange(len(rows))
    for _ in range(stage.epochs):
        rng.shuffle(order)
        for at in range(0, len(order), stage.batch):
            some = order[at : at + stage.batch]
            row, cell, x = m.entries(
                np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some]),
                np.concatenate([rows[i][0] for i in some]),
                np.concatenate([rows[i][1] for i in some]),
                np.array([rows[i][2] for i in some]),
            )
            used, to = np.unique(cell, return_inverse=True)
            values = np.zeros((len(some), len(used)), np.float32)
            values[row, to] = x
            w, v = m.weights[used].astype(np.float32), m.factors[used].astype(np.float32)
            total, squares = values @ v, values * values
            raw = m.bias + values @ w + 0.5 * ((total**2).sum(1) - squares @ (v * v).sum(1))
            slope = ((1 / (1 + np.exp(-np.clip(raw, -35, 35))) - labels[some]) / len(some)).astype(np.float32)
            g_b, g_w = float(slope.sum()), values.T @ slope + stage.decay * w
            g_v = values.T @ (slope[:, None] * total) - v * (squares.T @ slope)[:, None] + stage.factor_decay * v
            sum_b += g_b**2
            sum_w[used] += g_w**2
            sum_v[used] += g_v**2
            m.bias -= stage.rate * g_b / np.sqrt(sum_b)
            m.weights[used] -= stage.rate * g_w / np.sqrt(sum_w[used])
            m.factors[used] -= stage.rate * g_v / np.sqrt(sum_v[used])


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 2000, 4 << 20):
            row, bucket, n, n_words = term_counts(part.column(2))
            at = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v, pa.int32())) for v in (bucket, n)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n_words, pa.int64()), *lists], names=["id", "toxic", "n_words", "bucket", "n"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Machine:
    """A machine fitted on at most about ``sample`` labelled documents that are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    share = sample / max(known.count(), 1)
    chosen = known if share >= 1 else known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("t").alias("t"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T._parse_datatype_string("toxic int, n_words long, bucket array<int>, n array<int>")])
    terms = stored(texts.mapInArrow(_terms, schema), "terms")
    by = {r["toxic"]: r["n"] for r in terms.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    toxic, rest = by.get(True, 0), by.get(False, 0)
    base = toxic / max(toxic + rest, 1)
    if not toxic or not rest:
        return Machine(np.zeros(0, np.int64), 35.0 if base else -35.0, np.zeros(LENGTHS + SHARED), np.zeros((LENGTHS + SHARED, FACTORS)))
    counts = terms.select((F.col("toxic") > 0).cast("int").alias("y"), F.explode("bucket").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    z = F.abs(F.col("k") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)))
    best = counts.where(F.col("n") >= LEAST_DOCS).select("bucket", z.alias("z")).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "bucket").limit(OWN)
    buckets = np.array(sorted(r["bucket"] for r in best.collect()), np.int64)
    size = len(buckets) + LENGTHS + SHARED
    machine = Machine(buckets, float(np.log(base / (1 - base))), np.zeros(size), np.random.default_rng(11).normal(0, 0.01, (size, FACTORS)))
    rows, y = [], []
    for r in terms.mapInArrow(partial(_cells, machine), "toxic int, n_words long, cell binary, n binary, id " + docs.schema[id_col].dataType.simpleString()).orderBy("id").toLocalIterator():
        rows.append((np.frombuffer(r["cell"], np.int32), np.frombuffer(r["n"], np.int32), r["n_words"]))
        y.append(r["toxic"] > 0)
    labels_of = np.array(y, np.float64)
    alone = [c < len(buckets) for c, _, _ in rows]
    fit(machine, [(c[k], n[k], words) for (c, n, words), k in zip(rows, alone)], labels_of, ALONE)
    fit(machine, rows, labels_of, TOGETHER)
    return machine


def _cells(machine: Machine, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of terms as cells and counts, buckets of one cell added up."""
    cells = machine.cells()
    for batch in batches:
        for part in slices(batch, 2000, 8 << 20):
            lists = part.column(3)
            bucket, n = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            pair, to = np.unique(row * BUCKETS + cells[bucket], return_inverse=True)
            cell, count = (pair % BUCKETS).astype(np.int32), np.bincount(to, n, len(pair)).astype(np.int32)
            at = np.searchsorted(pair // BUCKETS, np.arange(part.num_rows + 1))
            packed = [pa.array([v[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()) for v in (cell, count)]
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), *packed, part.column(0)], names=["toxic", "n_words", "cell", "n", "id"])


def _score(machine: Machine, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = machine.cells()
    for batch in batches:
        for part in slices(batch, 2000, 2 << 20):
            p = machine.probability(*machine.entries(*term_counts(part.column(1), cells)), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64())], names=[batch.schema.names[0], "score"])


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
    scored = docs.select(id_col, text_col).mapInArrow(partial(_score, machine), schema)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    return score(docs, train(docs, labels, id_col, text_col, label_col), id_col, text_col)

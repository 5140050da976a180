"""Unigram subword vocabulary: corpus statistics, seed pieces, EM training,
pruning and ranking (A4-A8, L2, S7-S8).

Training works on the table of distinct words with their frequencies (A5):
pieces never cross a word start, so every statistic over the corpus is a
frequency-weighted statistic over distinct words. That table is small next to
the corpus and removes hot-word skew (a word holding a third of all tokens is
one row with a large count after map-side partial aggregation).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorigil.functions.bind import let
from sorigil.functions.jamo import hangul_to_jamo
from sorigil.functions.text import WHITESPACE_RE, WORD_START, mark_word
from sorigil.operators.lattice import Block, best_paths, block_counts, blocks, by_length, forward_backward
from sorigil.operators.trie import Shared, Trie, opened, share
from sorigil.session import cut_lineage, task_count

# Reserved ids and pieces of the vocabulary file.
RESERVED = (("<pad>", 0), ("<unk>", 1), ("<s>", 2), ("</s>", 3))
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3
MAX_PIECE_LEN = 16


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_counts(df: DataFrame, text_col="text", to_jamo: bool = True, transform_word=None) -> DataFrame:
    """A5: ``word, n`` — distinct ``▁``-prefixed words with their frequencies.

    Words are counted on the raw text first (partial aggregation map-side),
    then per-character conversions (``transform_word`` such as Hangul
    derivation, and the jamo decomposition) run once per distinct word, and
    counts are re-aggregated in case two words map to one."""
    # explode then filter (no lambda): keeps the split inside codegen and the plan reusable
    split = df.select(F.explode(F.split(_col(text_col), WHITESPACE_RE)).alias("w")).where(F.length("w") > 0)
    raw = split.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    w = F.col("w")
    if transform_word is not None:
        w = transform_word(w)
    if to_jamo:
        w = hangul_to_jamo(w)
    return raw.select(mark_word(w).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))


def char_counts(wc: DataFrame) -> DataFrame:
    """Character frequencies of the corpus from the word table: ``char, n``."""
    chars = wc.select(F.explode(F.split("word", "")).alias("char"), "n")
    return chars.groupBy("char").agg(F.sum("n").alias("n"))


def char_coverage(wc: DataFrame, coverage: float = 1.0) -> DataFrame:
    """A4: characters by frequency with running share; ``kept`` until ``coverage`` is reached.

    The window runs over the table of distinct characters (bounded by the
    alphabet, a few hundred rows for jamo)."""
    cc = char_counts(wc)
    order = Window.orderBy(F.col("n").desc(), F.col("char"))
    running = Window.orderBy(F.col("n").desc(), F.col("char")).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy()
    out = cc.select(
        "char",
        "n",
        F.row_number().over(order).alias("rank"),
        (F.sum("n").over(running) / F.sum("n").over(total)).alias("share"),
        ((F.sum("n").over(running) - F.col("n")) / F.sum("n").over(total)).alias("_before"),
    )
    return out.withColumn("kept", (F.col("_before") < F.lit(coverage)) | F.lit(coverage >= 1.0)).drop("_before")


def substrings(word: Column, max_len: int = MAX_PIECE_LEN) -> Column:
    """All substrings of length <= max_len that may be pieces: ``▁`` only at position 1.

    ``ARRAY<STRUCT<b INT, e INT, piece STRING>>`` with 0-based begin and
    exclusive end. The word and its length are bound once, and each start's
    window of ``max_len`` characters is cut once; pieces are prefixes of it."""

    def per_word(s):
        w, n = s["w"], s["n"]

        def from_start(b):
            def per_window(t):
                win = t["win"]
                lens = F.sequence(F.lit(1), F.greatest(F.length(win), F.lit(1)))
                return F.transform(lens, lambda k: F.struct(b.alias("b"), (b + k).alias("e"), F.substring(win, 1, k).alias("piece")))

            return let(per_window, win=F.substring(w, b + 1, max_len))

        subs = F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), from_start))
        return F.when(n > 0, F.filter(subs, lambda x: (x["b"] == 0) | (F.instr(x["piece"], WORD_START) == 0)))

    return let(per_word, w=word, n=F.length(word))


def substring_counts(wc: DataFrame, max_len: int = MAX_PIECE_LEN) -> DataFrame:
    """Frequency-weighted counts of every candidate substring: ``piece, n, len``.

    Two aggregations instead of one over every substring: first the windows
    of ``max_len`` characters starting at each position are counted (weighted
    by word frequency, with a flag for the word-initial window), then the
    prefixes of each distinct window are counted. Windows repeat across words,
    so the second explosion runs over far fewer rows. Plain ``explode`` of
    ``sequence`` and ``substring`` keep both steps inside whole-stage codegen;
    both aggregations combine map-side before shuffling."""
    starts = wc.select("word", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.length("word") - 1, F.lit(0)))).alias("b"))
    wins = starts.where(F.length("word") > 0).select(
        F.substring("word", F.col("b") + 1, max_len).alias("win"), (F.col("b") == 0).alias("first"), "n"
    )
    wcount = wins.groupBy("win", "first").agg(F.sum("n").alias("n"))
    pre = wcount.select("first", "n", "win", F.explode(F.sequence(F.lit(1), F.length("win"))).alias("k")).select(
        F.expr("substring(win, 1, k)").alias("piece"), "first", "n", "k"
    )
    kept = pre.where(F.col("first") | (F.instr("piece", WORD_START) == 0))
    # the length leaves the aggregation as an aggregate value: filters on it stay above
    # the aggregation, so consumers that split by length share one exchange
    return kept.groupBy("piece").agg(F.sum("n").alias("n"), F.max("k").cast("int").alias("len"))


def seed_pieces(wc: DataFrame, max_len: int = MAX_PIECE_LEN, min_freq: int = 2) -> DataFrame:
    """Candidate pieces with frequency-weighted occurrence counts.

    ``piece, n, len``. Substrings of each distinct word (len <= max_len, ``▁``
    only as the first character) are counted with the word's frequency;
    pieces seen fewer than ``min_freq`` times are dropped except single
    characters, which are always candidates."""
    agg = substring_counts(wc, max_len)
    return agg.where((F.col("n") >= min_freq) | (F.col("len") == 1)).select("piece", "n", "len")


def top_pieces(seeds: DataFrame, k: int) -> DataFrame:
    """Top ``k`` seeds by ``n * len`` (ties by piece), single characters always kept.

    ``orderBy().limit(k)`` plans as a per-partition top-k with a bounded merge."""
    multi = seeds.where(F.col("len") > 1).orderBy((F.col("n") * F.col("len")).desc(), F.col("piece")).limit(k)
    singles = seeds.where(F.col("len") == 1)
    return multi.unionByName(singles)


def initial_scores(pieces: DataFrame) -> DataFrame:
    """Log relative frequency as the starting score: ``piece, score``.

    The total is an uncorrelated scalar subquery (one partial aggregate,
    evaluated once and inlined as a value), not a join."""
    tot = pieces.agg(F.sum("n")).scalar()
    return pieces.select("piece", (F.log("n") - F.log(tot)).alias("score"))


def rank_vocab(scores: DataFrame, vocab_size: int) -> DataFrame:
    """L2: ``id, piece, score``: reserved ids 0-3, then pieces by score descending, ties by piece.

    Every single character has a place, whatever its score, so no text of the corpus has an
    unknown token; the best longer pieces fill the rest of exactly ``vocab_size`` rows (fewer only when
    there are fewer pieces). A size that cannot hold the alphabet is an error. Scores are rounded to 1e-6
    before ranking so partition-dependent float sums do not reorder equal scores. At most
    ``vocab_size - 4`` pieces are ranked (a bounded top-k), so the final window is over a bounded table."""
    k = vocab_size - len(RESERVED)
    single = F.length("piece") == 1
    n_single = scores.where(single).count()
    if n_single > k:
        raise ValueError(f"a vocabulary of {vocab_size} cannot hold the alphabet of {n_single} characters")
    rounded = scores.select("piece", F.round("score", 6).alias("score"))
    top = rounded.orderBy(single.desc(), F.col("score").desc(), F.col("piece")).limit(k)
    w = Window.orderBy(F.col("score").desc(), F.col("piece"))
    ranked = top.select((F.row_number().over(w) + len(RESERVED) - 1).cast("int").alias("id"), "piece", "score")
    spark = scores.sparkSession
    reserved = spark.createDataFrame([(i, p, 0.0) for p, i in RESERVED], "id int, piece string, score double")
    return reserved.unionByName(ranked)


def covered(seeds: DataFrame, wc: DataFrame, coverage: float) -> DataFrame:
    """A4 in training: seeds made of the most frequent characters that cover ``coverage`` of the corpus.

    The characters left out are collected (bounded by the alphabet); none at coverage 1.0."""
    if coverage >= 1.0:
        return seeds
    out = "".join(r["char"] for r in char_coverage(wc, coverage).where(~F.col("kept")).select("char").collect())
    return seeds.where(F.translate("piece", out, "") == F.col("piece")) if out else seeds


# --------------------------------------------------------------------------
# EM over the lattice of each distinct word (A7) and pruning.
# The per-word forward-backward is a small NumPy/Python helper run inside
# Arrow batches; Spark partitions the words, sums the expected counts per
# piece with a shuffle on ``piece`` and carries the scores between rounds.

UNKNOWN_PENALTY = 10.0


def batch_expected_counts(words: list, freqs: np.ndarray, pieces: Trie, score_arr: np.ndarray, max_len: int, unk_score: float) -> tuple[float, np.ndarray]:
    """Forward-backward for a batch of words at once: (log-likelihood, expected count per piece number)."""
    lengths = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    return forward_backward(*pieces.lattice(words, max_len), lengths, freqs, score_arr, unk_score)


LATTICE_SCHEMA = "width int, reach int, lengths binary, freqs binary, at binary, p binary"
RUN_PLACES = 1 << 16  # characters whose lattice is made at once


def _lattice_partitions(shared: Shared, max_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _, _ = opened(shared)
        for batch in batches:
            lengths = pc.utf8_length(batch.column(0)).to_numpy().astype(np.int64)
            for part in by_length(lengths, RUN_PLACES):
                words = batch.column(0).take(pa.array(part)).to_pylist()
                freqs = batch.column(1).take(pa.array(part)).to_numpy().astype(np.float64)
                for b in blocks(*pieces.lattice(words, max_len), lengths[part], freqs):
                    arrays = (b.lengths.astype(np.int32), b.freqs, b.at.astype(np.int32), b.p.astype(np.int32))
                    columns = [pa.array([b.width], pa.int32()), pa.array([b.reach], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)]
                    yield pa.RecordBatch.from_arrays(columns, names=["width", "reach", "lengths", "freqs", "at", "p"])

    return run


def word_lattices(wc: DataFrame, shared: Shared, max_len: int = MAX_PIECE_LEN) -> DataFrame:
    """The lattices of all distinct words over the shared pieces, for all rounds of EM: pruning takes scores away, never
    adds a piece, so the edges are found once. A row is a block of words of like length (``lattice.Block``), its arrays as bytes,
    which a round reads without touching single values."""
    return wc.select("word", "n").mapInArrow(_lattice_partitions(shared, max_len), LATTICE_SCHEMA)


COUNT_BLOCK = 1 << 13  # piece numbers whose counts are one row on their way to the sum


def _em_partitions(scores_bc, unk_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scores_bc.value
        acc, ll = np.zeros(len(scores)), 0.0
        for batch in batches:
            for i in range(batch.num_rows):
                width, reach, *arrays = (batch.column(c)[i] for c in range(batch.num_columns))
                kinds = (np.int32, np.float64, np.int32, np.int32)
                block = Block(width.as_py(), reach.as_py(), *(np.frombuffer(x.as_buffer(), t) for x, t in zip(arrays, kinds)))
                lw, c = block_counts(block, scores, unk_score)
                ll += lw
                acc += c
        parts = {k: acc[k * COUNT_BLOCK : (k + 1) * COUNT_BLOCK] for k in range(-(-len(acc) // COUNT_BLOCK))}
        sent = [(-1, np.array([ll])), *((k, v) for k, v in parts.items() if (v > 0).any())]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sent], pa.int32()), pa.array([v.tobytes() for _, v in sent], pa.binary())], names=["block", "counts"])

    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(v, np.float64)
            total[k] = total[k] + counts if k in total else counts
    for k, v in total.items():
        hit = np.flatnonzero(v > 0) if k >= 0 else np.zeros(1, np.int64)
        p = pa.array(k * COUNT_BLOCK + hit, pa.int32()) if k >= 0 else pa.nulls(1, pa.int32())
        yield pa.RecordBatch.from_arrays([p, pa.array(v[hit])], names=["p", "n"])


def _unknown_score(scores: np.ndarray) -> float:
    live = scores[~np.isnan(scores)]
    return (float(live.min()) if len(live) else 0.0) - UNKNOWN_PENALTY


def em_step(lattices: DataFrame, scores: np.ndarray) -> DataFrame:
    """A7 (E step) over the stored lattices: expected counts ``p, n`` by piece number; the row with a null number holds the
    corpus log-likelihood. ``scores`` has a number for every shared piece, nan where a piece was pruned; a task
    sends its counts as rows of ``COUNT_BLOCK`` numbers, which are summed by block."""
    bc = lattices.sparkSession.sparkContext.broadcast(scores)
    counted = lattices.mapInArrow(_em_partitions(bc, _unknown_score(scores)), "block int, counts binary")
    return counted.repartition("block").mapInArrow(_sum_counts, "p int, n double")


COUNT_FLOOR = 1e-3


def m_step_df(counts: DataFrame, min_count: float = COUNT_FLOOR, pieces: DataFrame | None = None) -> DataFrame:
    """A7 (M step) on Spark, for score tables beyond the limit: ``piece, score, n`` with score = log(n / total).

    Without ``pieces``, over the pieces with an expected count of at least ``min_count`` and all single
    characters. With ``pieces`` every piece stays, counts below ``min_count`` raised to it: only pruning
    makes the vocabulary smaller, so its size never falls short. The total is a scalar subquery."""
    if pieces is None:
        kept = counts.where(F.col("piece").isNotNull() & ((F.col("n") >= min_count) | (F.length("piece") == 1)))
    else:
        kept = pieces.select("piece").join(counts.where(F.col("piece").isNotNull()), "piece", "left")
        kept = kept.select("piece", F.greatest(F.coalesce("n", F.lit(0.0)), F.lit(min_count)).alias("n"))
    total = kept.agg(F.sum("n")).scalar()
    return kept.select("piece", F.log(F.greatest(F.col("n"), F.lit(1e-12)) / total).alias("score"), "n")


def split_scores(words: list[str], pieces: Trie, scores: np.ndarray, max_len: int = MAX_PIECE_LEN) -> np.ndarray:
    """The score of every piece's best split into other pieces that have a score; -inf where there is none."""
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    W, B, E, P = pieces.lattice(words, max_len, unknown=False)
    S = scores[P]
    other = ~np.isnan(S) & ~((B == 0) & (E == lengths[W]))
    return best_paths(W[other], B[other], E[other], S[other], lengths)[0]


def expected_counts(lattices: DataFrame, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """One E step: the log-likelihood and the expected counts by piece number (8 bytes a seed)."""
    rows = em_step(lattices, scores).toArrow()
    p, n = rows.column("p").to_pylist(), rows.column("n").to_numpy()
    known = np.array([i is not None for i in p], bool)
    counts = np.zeros(len(scores))
    counts[[i for i in p if i is not None]] = n[known]
    return float(n[~known].sum()), counts


def m_step(scores: np.ndarray, counts: np.ndarray, min_count: float = COUNT_FLOOR) -> tuple[np.ndarray, np.ndarray]:
    """A7 (M step): log(n / total) of the pieces that have a score, counts below ``min_count`` raised to it; and these counts."""
    n = np.where(np.isnan(scores), np.nan, np.maximum(counts, min_count))
    return np.log(np.maximum(n, 1e-12) / np.nansum(n)), n


def _prune_loss_fn(shared: Shared, model_bc, max_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _, names = opened(shared)
        scores, n = model_bc.value
        for batch in batches:
            p = batch.column(0).to_numpy()
            words = names.take(pa.array(p)).to_pylist()
            multi = ~np.isnan(scores[p]) & np.fromiter((len(w) > 1 for w in words), bool, len(words))
            p = p[multi]
            alt = split_scores([w for w, m in zip(words, multi) if m], pieces, scores, max_len)
            with np.errstate(invalid="ignore"):
                loss = np.where(np.isneginf(alt), np.inf, n[p] * (scores[p] - alt))
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(loss)], names=["p", "loss"])

    return run


def prune(spark, shared: Shared, scores: np.ndarray, n: np.ndarray, singles: np.ndarray, target: int, shrink: float = 0.75, max_len: int = MAX_PIECE_LEN) -> np.ndarray:
    """The scores, nan where a piece was dropped: those go whose removal costs least likelihood, single characters never.

    The loss of each piece (expected count x (score - best split into other pieces)) is computed by Spark in Arrow batches over the
    piece numbers, from the shared trie; the pieces to keep are a top-k by loss (ties by number, the pieces' order)."""
    live = int((~np.isnan(scores)).sum())
    room = max(max(target, int(live * shrink)) - int((singles & ~np.isnan(scores)).sum()), 0)
    bc = spark.sparkContext.broadcast((scores, n))
    losses = spark.range(0, shared.size, 1, task_count(spark)).mapInArrow(_prune_loss_fn(shared, bc, max_len), "p long, loss double")
    kept = singles.copy()
    kept[losses.orderBy(F.col("loss").desc(), F.col("p")).limit(room).select("p").toArrow().column("p").to_numpy()] = True
    return np.where(kept, scores, np.nan)


# --------------------------------------------------------------------------
# All-native EM for score tables over the broadcast limit: the lattice is a join
# of substrings with the score table (shuffle), forward-backward and the pruning
# split are ``aggregate`` folds over each word's (piece's) edge array.

BROADCAST_SCORES_LIMIT = 1_000_000
PRUNE_MARGIN = 1.1  # pieces left by pruning, as a multiple of the vocabulary
_NEG_INF = float("-inf")


def _log_add(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _native_lattice(words: DataFrame, pieces: DataFrame, max_len: int) -> DataFrame:
    """``word, n, b, e, piece, score, known``: every substring that is a piece, plus an
    unknown edge (known = false) where a character is no piece."""
    unk = pieces.agg(F.min("score")).scalar() - F.lit(UNKNOWN_PENALTY)
    length = F.length("word")
    starts = words.where(length > 0).select("word", "n", F.explode(F.sequence(F.lit(0), length - 1)).alias("b"))
    subs = starts.select("word", "n", "b", F.explode(F.sequence(F.lit(1), F.least(F.lit(max_len), length - F.col("b")))).alias("k"))
    subs = subs.select("word", "n", "b", (F.col("b") + F.col("k")).alias("e"), F.expr("substring(word, b + 1, k)").alias("piece"))
    hits = subs.join(pieces.select("piece", "score"), "piece").withColumn("known", F.lit(True))
    unknown = subs.where(F.col("e") == F.col("b") + 1).join(pieces.select("piece"), "piece", "left_anti")
    unknown = unknown.withColumn("score", unk).withColumn("known", F.lit(False))
    cols = ["word", "n", "b", "e", "piece", "score", "known"]
    return hits.select(*cols).unionByName(unknown.select(*cols))


def em_step_native(wc: DataFrame, pieces: DataFrame, max_len: int = MAX_PIECE_LEN) -> DataFrame:
    """A7 (E step) without broadcasting the scores: ``piece, n`` and the null-piece
    log-likelihood row, as ``em_step``."""
    edges = _native_lattice(wc.select("word", "n"), pieces, max_len)
    g = edges.groupBy("word").agg(
        F.max("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("e", "b", "score", "piece", "known"))).alias("fwd"),
        F.sort_array(F.collect_list(F.struct("b", "e", "score")), asc=False).alias("bwd"),
    )
    size = F.length("word")
    inf = F.lit(_NEG_INF)
    alpha0 = F.concat(F.array(F.lit(0.0)), F.array_repeat(inf, size))
    beta0 = F.concat(F.array_repeat(inf, size), F.array(F.lit(0.0)))

    def forward(acc, x):
        return F.transform(acc, lambda v, i: F.when(i == x["e"], _log_add(v, F.get(acc, x["b"]) + x["score"])).otherwise(v))

    def backward(acc, x):
        return F.transform(acc, lambda v, i: F.when(i == x["b"], _log_add(v, F.get(acc, x["e"]) + x["score"])).otherwise(v))

    fb = g.select("word", "n", "fwd", F.aggregate("fwd", alpha0, forward).alias("alpha"), F.aggregate("bwd", beta0, backward).alias("beta"))
    fb = fb.withColumn("z", F.get("alpha", F.length("word")))
    post = fb.select("n", "alpha", "beta", "z", F.explode("fwd").alias("x")).where(F.col("x.known"))
    post = post.select(
        F.col("x.piece").alias("piece"),
        (F.col("n") * F.exp(F.get("alpha", F.col("x.b")) + F.col("x.score") + F.get("beta", F.col("x.e")) - F.col("z"))).alias("c"),
    )
    counts = post.groupBy("piece").agg(F.sum("c").alias("n")).where(F.col("n") > 0)
    ll = fb.agg(F.sum(F.col("n") * F.col("z")).alias("n")).select(F.lit(None).cast("string").alias("piece"), "n")
    return counts.unionByName(ll)


def prune_native(scored: DataFrame, target: int, shrink: float = 0.75, max_len: int = MAX_PIECE_LEN) -> DataFrame:
    """A8 without broadcasting the scores: the best split of each piece into other pieces
    is a ``max`` fold over its own lattice (no unknown edges, the whole piece left out)."""
    total = scored.count()
    n_singles = scored.where(F.length("piece") == 1).count()
    room = max(max(target, int(total * shrink)) - n_singles, 0)
    multi = scored.where(F.length("piece") > 1).select(F.col("piece").alias("word"), F.lit(1.0).alias("n"))
    edges = _native_lattice(multi, scored, max_len).where(F.col("known") & ~((F.col("b") == 0) & (F.col("e") == F.length("word"))))
    g = edges.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("e", "b", "score"))).alias("ed"))
    zero = F.concat(F.array(F.lit(0.0)), F.array_repeat(F.lit(_NEG_INF), F.length("word")))

    def relax(acc, x):
        return F.transform(acc, lambda v, i: F.when(i == x["e"], F.greatest(v, F.get(acc, x["b"]) + x["score"])).otherwise(v))

    alt = g.select(F.col("word").alias("piece"), F.get(F.aggregate("ed", zero, relax), F.length("word")).alias("alt"))
    loss = F.when(F.col("alt").isNull() | (F.col("alt") == F.lit(_NEG_INF)), F.lit(float("inf"))).otherwise(
        F.col("n") * (F.col("score") - F.col("alt"))
    )
    losses = scored.where(F.length("piece") > 1).join(alt, "piece", "left").select("piece", "score", loss.alias("loss"))
    kept = losses.orderBy(F.col("loss").desc(), F.col("piece")).limit(room).select("piece", "score")
    return kept.unionByName(scored.where(F.length("piece") == 1).select("piece", "score"))


def train_vocab(
    wc: DataFrame,
    vocab_size: int = 8000,
    seed_size: int = 100_000,
    em_rounds: int = 2,
    shrink: float = 0.75,
    max_len: int = MAX_PIECE_LEN,
    min_freq: int = 2,
    broadcast_limit: int = BROADCAST_SCORES_LIMIT,
    coverage: float = 1.0,
    history: list[float] | None = None,
) -> DataFrame:
    """A4-A8 + L2: unigram vocabulary of exactly ``vocab_size`` rows trained by EM with pruning
    (fewer rows only if the corpus has fewer candidate pieces).

    Seeds are the best ``seed_size`` substrings and every character within ``coverage``. Rounds of EM and
    pruning go on until a tenth more pieces than wanted are left; a last EM then scores those, and all
    characters plus the best pieces make up the vocabulary.

    The distinct-word table is hash-partitioned and checkpointed once into the
    shared checkpoint folder. The seeds become a trie in one file that every executor maps (``trie.share``); the words' lattices
    over it are found once, stored in blocks of words of like length and read in every round. A round sends the scores as one array (8 bytes a
    seed), runs the E step block by block and sums the tasks' expected counts, which come
    back as one array to be normalised (M step); pruning losses are a job over the pieces.
    With more than ``broadcast_limit`` seeds (checked by a bounded count) the
    scores stay a table and every round runs the native forms instead.
    The log-likelihood of each E step is appended to ``history``."""
    words_df = cut_lineage(wc.repartition(task_count(wc.sparkSession), "word"))
    seeds = cut_lineage(top_pieces(covered(seed_pieces(words_df, max_len, min_freq), words_df, coverage), seed_size))
    wanted = math.ceil((vocab_size - len(RESERVED)) * PRUNE_MARGIN)
    seen = [] if history is None else history
    pieces = cut_lineage(initial_scores(seeds))
    if seeds.limit(broadcast_limit + 1).count() > broadcast_limit:
        return _train_native(words_df, pieces, vocab_size, wanted, em_rounds, shrink, max_len, seen)
    spark = wc.sparkSession
    rows = pieces.orderBy("piece").toArrow()
    names, scores = rows.column("piece").to_pylist(), rows.column("score").to_numpy()
    shared = share(spark, names)
    singles = np.fromiter((len(p) == 1 for p in names), bool, len(names))
    lattices = cut_lineage(word_lattices(words_df.coalesce(2 * spark.sparkContext.defaultParallelism), shared, max_len))
    while True:
        for _ in range(em_rounds):
            likelihood, counts = expected_counts(lattices, scores)
            seen.append(likelihood)
            scores, n = m_step(scores, counts)
        live = np.flatnonzero(~np.isnan(scores))
        if len(live) <= wanted:
            return rank_vocab(spark.createDataFrame(pa.table({"piece": pa.array([names[i] for i in live], pa.string()), "score": scores[live]})), vocab_size)
        scores = prune(spark, shared, scores, n, singles, wanted, shrink, max_len)


def _train_native(words_df: DataFrame, pieces: DataFrame, vocab_size: int, wanted: int, em_rounds: int, shrink: float, max_len: int, seen: list[float]) -> DataFrame:
    """The rounds of ``train_vocab`` with the scores as a table throughout."""
    while True:
        for _ in range(em_rounds):
            counts = cut_lineage(em_step_native(words_df, pieces, max_len))
            seen.append(float(counts.where(F.col("piece").isNull()).first()["n"]))
            scored = cut_lineage(m_step_df(counts, pieces=pieces))
            pieces = scored.select("piece", "score")
        if scored.count() <= wanted:
            return rank_vocab(pieces, vocab_size)
        pieces = cut_lineage(prune_native(scored, wanted, shrink, max_len))

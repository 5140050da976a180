"""Encoding text with a unigram vocabulary.

Pieces never cross a word start, so texts are split into words, the table of
distinct words is segmented once (best-scoring split, Viterbi), and the result
is joined back to the word positions of each text. The vocabulary is a bounded
artefact (``vocab_size`` rows) and is broadcast; the word join shuffles on the
word, with AQE splitting a hot word's partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.functions.jamo import runs
from sorigil.functions.text import WHITESPACE_RE, WORD_START, mark_word
from sorigil.operators.lattice import best_paths
from sorigil.operators.trie import Shared, Trie, code_points, opened, share
from sorigil.operators.vocab import MAX_PIECE_LEN, UNK_ID, UNKNOWN_PENALTY, substrings
from sorigil.session import broadcast_if_bounded, task_count

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("pieces", T.ArrayType(T.StringType())),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("score", T.DoubleType()),
    ]
)


def split_batch(words: list[str], pieces: Trie, names: np.ndarray, ids: np.ndarray, scores: np.ndarray, max_len: int, unk_score: float) -> pa.RecordBatch:
    """Best splits of a batch of words (``SEGMENT_SCHEMA``): the lattice by the trie, the best path by a Viterbi over words of
    like length at once. For each end, ties keep the edge with the smallest begin; a character that is no
    piece is an unknown edge (id 1)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    W, B, E, P = pieces.lattice(words, max_len)
    known = P >= 0
    score, word, edge = best_paths(W, B, E, np.where(known, scores[P], unk_score), lengths)
    flat, _ = code_points(words)
    unknown = flat[(np.cumsum(lengths) - lengths)[word] + B[edge]]
    text = [names[p] if p >= 0 else chr(c) for p, c in zip(P[edge].tolist(), unknown.tolist())]
    at = pa.array(np.searchsorted(word, np.arange(len(words) + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(at, v) for v in (pa.array(text, pa.string()), pa.array(np.where(P[edge] >= 0, ids[P[edge]], UNK_ID), pa.int32()))]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *lists, pa.array(score)], ["word", "pieces", "ids", "score"])


RUN_BYTES = 1 << 17  # words whose lattice is made and walked at once, in bytes of UTF-8


def _segment_fn(shared: Shared, scores_bc, max_len: int, unk_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, ids, names = opened(shared)
        names = np.array(names.to_pylist(), dtype=object)
        for batch in batches:
            for words in runs(batch.column(0), RUN_BYTES):
                yield split_batch(words.to_pylist(), pieces, names, ids, scores_bc.value, max_len, unk_score)

    return run


# Largest vocabulary (ordinary pieces) handed to every executor as a trie file; a
# larger one is segmented by the all-native plan, which shuffles instead.
BROADCAST_VOCAB_LIMIT = 1_000_000


def ordinary_pieces(vocab: DataFrame, limit: int) -> pa.Table | None:
    """``piece, id, score`` of the ordinary pieces (ids >= 4), or None when there are more than ``limit`` of them (checked by
    fetching at most ``limit + 1`` rows)."""
    rows = vocab.where(F.col("id") >= 4).select("piece", "id", "score").limit(limit + 1).toArrow()
    return rows if rows.num_rows <= limit else None


def segment_words(
    words_df: DataFrame, vocab: DataFrame, max_len: int = MAX_PIECE_LEN, broadcast_limit: int = BROADCAST_VOCAB_LIMIT
) -> DataFrame:
    """T3 + T5: ``word, pieces, ids, score`` for every distinct word.

    A vocabulary of at most ``broadcast_limit`` pieces becomes a trie file that every executor maps, and the words
    are segmented in Arrow batches; a larger one goes to ``segment_words_native``."""
    spark = words_df.sparkSession
    rows = ordinary_pieces(vocab, broadcast_limit)
    if rows is None:
        return segment_words_native(words_df, vocab, max_len)
    scores = rows.column("score").to_numpy()
    unk = (float(scores.min()) if len(scores) else 0.0) - UNKNOWN_PENALTY
    shared = share(spark, rows.column("piece").to_pylist(), rows.column("id").to_pylist())
    bc = spark.sparkContext.broadcast(scores)
    spread_words = words_df.select("word").repartition(task_count(spark))
    return spread_words.mapInArrow(_segment_fn(shared, bc, max_len, unk), SEGMENT_SCHEMA)


_DP_TYPE = "struct<best:array<double>,back:array<int>,bid:array<int>>"
_PATH_TYPE = "struct<pos:int,pieces:array<string>,ids:array<int>>"


def segment_words_native(words_df: DataFrame, vocab: DataFrame, max_len: int = MAX_PIECE_LEN) -> DataFrame:
    """T3 + T5 without Python and without broadcasting the vocabulary (the same result
    as the Arrow Viterbi).

    Every substring of up to ``max_len`` characters of each distinct word is
    joined to the vocabulary on the piece (a shuffle join); one-character
    substrings with no piece become unknown edges. A word's edges, sorted by
    (end, begin), are folded with ``aggregate`` into best scores and back
    pointers (strictly better replaces, so ties keep the smallest begin), and
    a second fold walks the back pointers. A group is one word's edges."""
    ordinary = vocab.where(F.col("id") >= 4).select("piece", "id", "score")
    unk = ordinary.agg(F.min("score")).scalar() - F.lit(UNKNOWN_PENALTY)
    n = F.length("word")
    starts = words_df.select("word").where(n > 0).select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("b"))
    subs = starts.select("word", "b", F.explode(F.sequence(F.lit(1), F.least(F.lit(max_len), n - F.col("b")))).alias("k")).select(
        "word", "b", (F.col("b") + F.col("k")).cast("int").alias("e"), F.expr("substring(word, b + 1, k)").alias("piece")
    )
    hits = subs.join(ordinary, "piece")
    unknown = subs.where(F.col("e") == F.col("b") + 1).join(ordinary.select("piece"), "piece", "left_anti")
    edges = hits.select("word", "b", "e", "piece", "id", "score").unionByName(
        unknown.select("word", "b", "e", "piece", F.lit(UNK_ID).alias("id"), unk.alias("score"))
    )
    grouped = edges.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("e", "b", "score", "id", "piece"))).alias("ed"))

    def relax(acc, x):
        cand = F.get(acc["best"], x["b"]) + x["score"]
        at_e = lambda new: lambda v, i: F.when(i == x["e"], new).otherwise(v)
        updated = F.struct(
            F.transform(acc["best"], at_e(cand)).alias("best"),
            F.transform(acc["back"], at_e(x["b"].cast("int"))).alias("back"),
            F.transform(acc["bid"], at_e(x["id"].cast("int"))).alias("bid"),
        )
        return F.when(cand > F.get(acc["best"], x["e"]), updated).otherwise(acc).cast(_DP_TYPE)

    size = F.length("word")
    zero = F.struct(
        F.concat(F.array(F.lit(0.0)), F.array_repeat(F.lit(float("-inf")), size)).alias("best"),
        F.array_repeat(F.lit(-1), size + 1).alias("back"),
        F.array_repeat(F.lit(0), size + 1).alias("bid"),
    ).cast(_DP_TYPE)
    dp = grouped.select("word", F.aggregate("ed", zero, relax).alias("dp"))

    def walk(acc, _):
        pos = acc["pos"]
        b = F.get(F.col("dp.back"), pos)
        step = F.struct(
            b.alias("pos"),
            F.concat(F.array(F.col("word").substr(b + 1, pos - b)), acc["pieces"]).alias("pieces"),
            F.concat(F.array(F.get(F.col("dp.bid"), pos)), acc["ids"]).alias("ids"),
        )
        return F.when(pos > 0, step).otherwise(acc).cast(_PATH_TYPE)

    start = F.struct(
        F.length("word").cast("int").alias("pos"), F.array().cast("array<string>").alias("pieces"), F.array().cast("array<int>").alias("ids")
    ).cast(_PATH_TYPE)
    path = dp.select("word", "dp", F.aggregate(F.sequence(F.lit(1), F.length("word")), start, walk).alias("path"))
    return path.select(
        "word", F.col("path.pieces").alias("pieces"), F.col("path.ids").alias("ids"), F.get(F.col("dp.best"), F.length("word")).alias("score")
    )


def lattice_edges(words_df: DataFrame, vocab: DataFrame, max_len: int = MAX_PIECE_LEN) -> DataFrame:
    """Every substring of each distinct word that is a vocabulary piece:
    ``word, b, e, piece, id, score`` (the native lattice, used as a cross-check)."""
    subs = words_df.select("word", F.explode(substrings(F.col("word"), max_len)).alias("s")).select(
        "word", F.col("s.b").alias("b"), F.col("s.e").alias("e"), F.col("s.piece").alias("piece")
    )
    pieces = broadcast_if_bounded(vocab.where(F.col("id") >= 4).select("piece", "id", "score"), BROADCAST_VOCAB_LIMIT)
    return subs.join(pieces, "piece")


def text_words(texts: DataFrame, key: str, text_col: str = "jamo") -> DataFrame:
    """``key, wpos, word``: the ▁-marked words of each text with their positions."""
    ex = texts.select(key, F.posexplode(F.split(text_col, WHITESPACE_RE)).alias("wpos", "w")).where(F.length("w") > 0)
    return ex.select(key, "wpos", mark_word("w").alias("word"))


def encode_texts(texts: DataFrame, key: str, segmented: DataFrame, text_col: str = "jamo") -> DataFrame:
    """T3-T5 on whole texts: ``key, pieces, ids`` in word order.

    Each text's word rows are joined to the segmented distinct words and
    gathered back per text (one group per text, bounded by the text itself).
    ``posexplode_outer`` keeps a text without words as one row with no word, so
    it comes out with empty arrays without a second pass over the result."""
    ex = texts.select(key, F.posexplode_outer(F.split(text_col, WHITESPACE_RE)).alias("wpos", "w"))
    words = ex.select(key, "wpos", F.when(F.length("w") > 0, mark_word("w")).alias("word"))
    tw = words.join(segmented.select("word", "pieces", "ids"), "word", "left")
    item = F.when(F.col("pieces").isNotNull(), F.struct("wpos", "pieces", "ids"))
    g = tw.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_w"))
    return g.select(
        key,
        F.flatten(F.transform("_w", lambda s: s["pieces"])).alias("pieces"),
        F.flatten(F.transform("_w", lambda s: s["ids"])).alias("ids"),
    )


def decode_ids(encoded: DataFrame, key: str, vocab: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Ids back to text: pieces in order, concatenated, ``▁`` → space, leading space dropped.

    ``posexplode_outer`` keeps a row with no ids, which decodes to the empty text."""
    ex = encoded.select(key, F.posexplode_outer(ids_col).alias("i", "id"))
    named = ex.join(broadcast_if_bounded(vocab.select("id", "piece"), BROADCAST_VOCAB_LIMIT), "id", "left")
    item = F.when(F.col("i").isNotNull(), F.struct("i", "piece"))
    g = named.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_p"))
    text = F.ltrim(F.translate(F.array_join(F.transform("_p", lambda s: s["piece"]), ""), WORD_START, " "))
    return g.select(key, text.alias("text"))


def text_token_counts(texts: DataFrame, key: str, segmented: DataFrame, text_col: str = "jamo", convert=None) -> DataFrame:
    """``key, n, u``: tokens and unknown tokens per text, without assembling the token arrays.

    Each text's words are counted first (with map-side combine, so a word repeated in a text is one narrow
    row), every distinct word finds its token counts once, and the products are summed per text. ``convert``
    (a Column function, such as the jamo decomposition) runs on the distinct words only, never on whole texts."""
    per_word = segmented.select(
        "word", F.size("ids").alias("n"), F.size(F.filter("ids", lambda i: i == UNK_ID)).alias("u")
    )
    raw = texts.select(key, F.explode(F.split(text_col, WHITESPACE_RE)).alias("w")).where(F.length("w") > 0)
    per_text = raw.groupBy(key, "w").agg(F.count(F.lit(1)).alias("times"))
    names = raw.select("w").distinct().select("w", mark_word(convert(F.col("w")) if convert else F.col("w")).alias("word"))
    tokens = names.join(per_word, "word").select("w", "n", "u")
    return per_text.join(tokens, "w").groupBy(key).agg(
        F.sum(F.col("n") * F.col("times")).cast("int").alias("n"), F.sum(F.col("u") * F.col("times")).cast("int").alias("u")
    )


def token_stats(encoded: DataFrame, group_col: str, ids_col: str | None = "ids") -> DataFrame:
    """Per group the number of texts, tokens per text (mean, max, median) and the unknown rate.

    ``encoded`` holds either an ``ids`` array per text or, with ``ids_col=None``,
    the counts ``n`` and ``u`` of ``text_token_counts``."""
    if ids_col is None:
        e = encoded.select(group_col, "n", "u")
    else:
        e = encoded.select(
            group_col, F.size(ids_col).alias("n"), F.size(F.filter(ids_col, lambda i: i == UNK_ID)).alias("u")
        )
    return e.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.avg("n").alias("avg_tokens"),
        F.max("n").alias("max_tokens"),
        F.percentile_approx("n", 0.5).alias("median_tokens"),
        (F.sum("u") / F.sum("n")).alias("unk_rate"),
    )

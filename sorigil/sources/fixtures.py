"""Stand-ins for the speech corpus, derived by Spark from the driver tables.

The driver tables hold no Hangul, no audio and no training log, so each input
of the corpus tools is derived by a fixed, documented rule (FIXTURES.md):

* ``hangulize``: a letter with code point p in A-Z, a-z or U+00C0..U+00FF
  becomes the syllable ``44032 + (p * 2741) % 11172``; other characters stay.
* ``documents_as_metadata``: one transcript row per document; ``source`` is the
  data set, ``filename`` is ``doc_%06d.wav``, ``row_idx`` the rank of doc_id in
  its source, ``source_ord`` the numeric suffix of ``source``.
* ``labels_as_listing``: a document's audio file exists when its doc_id is in
  ``labels``.
* ``embeddings_as_clips`` / ``_as_logits`` / ``_as_audio_codes``: the float
  vectors as waveforms, as model scores over a 16-token vocabulary, and as
  4-channel integer audio codes.
* ``events_as_run_log``: one micro-step per event; epoch = UTC day of ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.functions.jamo import SYLLABLE_FIRST
from sorigil.functions.text import resolve_path
from sorigil.session import spread

# Fixed values of the derivation rule (FIXTURES.md).
HANGUL_MULTIPLIER = 2741
HANGUL_SPAN = 11172
LETTER_RANGES = ((ord("A"), ord("Z")), (ord("a"), ord("z")), (0x00C0, 0x00FF))
DATA_ROOT = "/data"
CLIP_RATE_EVEN = 16
CLIP_RATE_ODD = 32
LOGIT_VOCAB = 16
LOGIT_CHANNELS = 4
LOGIT_PAD = 9
CODE_CHANNELS = 4


def _letters() -> list[int]:
    return [p for lo, hi in LETTER_RANGES for p in range(lo, hi + 1)]


def hangul_of(p: int) -> str:
    return chr(SYLLABLE_FIRST + (p * HANGUL_MULTIPLIER) % HANGUL_SPAN)


def hangulize(col) -> Column:
    """Letters to Hangul syllables with one native ``translate`` (code point map)."""
    c = F.col(col) if isinstance(col, str) else col
    letters = _letters()
    return F.translate(c, "".join(chr(p) for p in letters), "".join(hangul_of(p) for p in letters))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_as_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, source, source_ord, filename, text, data_dir, full_path`` with Hangul text (no ranks yet)."""
    docs = spread(table(spark, sf_dir, "documents"))
    out = docs.select(
        "doc_id",
        "source",
        F.regexp_extract("source", "([0-9]+)$", 1).cast("int").alias("source_ord"),
        F.format_string("doc_%06d.wav", "doc_id").alias("filename"),
        hangulize("text").alias("text"),
        F.concat_ws("/", F.lit(DATA_ROOT), "source").alias("data_dir"),
    )
    return out.withColumn("full_path", resolve_path("data_dir", "filename"))


def labels_as_listing(spark: SparkSession, sf_dir: str, root: str = DATA_ROOT) -> DataFrame:
    """The audio files that exist: ``full_path`` of every labelled document.

    Stands in for ``list_audio`` (a ``binaryFile`` listing) over the driver
    tables. The path uses the same rule as the metadata side."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    files = docs.join(labels, "doc_id", "left_semi")
    return files.select(
        resolve_path(F.concat_ws("/", F.lit(root), "source"), F.format_string("doc_%06d.wav", "doc_id")).alias("full_path")
    )


def conversations_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns in Hangul; odd turns carry ``[S2] ``, turns divisible by 4 ``[S1] ``."""
    conv = spread(table(spark, sf_dir, "conversations"))
    h = hangulize("text")
    tagged = (
        F.when(F.col("turn") % 2 == 1, F.concat(F.lit("[S2] "), h))
        .when(F.col("turn") % 4 == 0, F.concat(F.lit("[S1] "), h))
        .otherwise(h)
    )
    return conv.select("conv_id", "turn", "role", tagged.alias("text"))


def embeddings_as_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clip_id, label, audio STRUCT<array ARRAY<DOUBLE>, sampling_rate INT>``."""
    emb = spread(table(spark, sf_dir, "embeddings"))
    rate = F.when(F.col("vec_id") % 2 == 0, F.lit(CLIP_RATE_EVEN)).otherwise(F.lit(CLIP_RATE_ODD))
    return emb.select(
        F.col("vec_id").alias("clip_id"),
        "label",
        F.struct(F.col("embedding").cast("array<double>").alias("array"), rate.alias("sampling_rate")).alias("audio"),
    )


def embeddings_as_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (seq_id, t, channel): 16 scores and the label at that step.

    seq_id = vec_id div 16, t = vec_id mod 16, channel c uses values 16c+1..16c+16
    and label (label + c) mod 16."""
    emb = table(spark, sf_dir, "embeddings")
    per_channel = emb.select(
        "vec_id", "label", "embedding", F.explode(F.sequence(F.lit(0), F.lit(LOGIT_CHANNELS - 1))).alias("channel")
    )
    return per_channel.select(
        (F.col("vec_id") / 16).cast("bigint").alias("seq_id"),
        (F.col("vec_id") % 16).cast("int").alias("t"),
        F.col("channel").cast("int").alias("channel"),
        F.slice(F.col("embedding").cast("array<double>"), F.col("channel") * LOGIT_VOCAB + 1, F.lit(LOGIT_VOCAB)).alias(
            "logits"
        ),
        ((F.col("label") + F.col("channel")) % LOGIT_VOCAB).cast("int").alias("label"),
    )


def embeddings_as_audio_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clip_id, audio_tokens ARRAY<ARRAY<INT>>``: row t holds floor((x+1)*8) of samples 4t..4t+3;
    a clip has ``size/4 - label`` rows, so clip lengths differ (7 to 16 rows at 64 samples)."""
    emb = table(spark, sf_dir, "embeddings")
    codes = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor((x + 1) * 8).cast("int"))
    n_rows = F.greatest(F.floor(F.size("embedding") / CODE_CHANNELS).cast("int") - F.col("label"), F.lit(0))
    rows = F.transform(
        F.sequence(F.lit(0), F.greatest(n_rows - 1, F.lit(0))),
        lambda t: F.slice(codes, t * CODE_CHANNELS + 1, F.lit(CODE_CHANNELS)),
    )
    return emb.select(F.col("vec_id").alias("clip_id"), "label", F.when(n_rows > 0, rows).otherwise(F.array()).alias("audio_tokens"))


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp column, without the session time zone:
    a zone-less timestamp (TIMESTAMP_NTZ) is read as UTC wall time, an instant as itself."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


def events_as_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts_us, epoch, loss``: ts_us = microseconds since 1970 (UTC wall time),
    epoch = day number of ts. Independent of the session time zone."""
    ev = table(spark, sf_dir, "events")
    us = epoch_micros(ev, "ts")
    return ev.select(
        "event_id",
        us.alias("ts_us"),
        F.floor(us / F.lit(86_400_000_000)).cast("int").alias("epoch"),
        F.col("value").alias("loss"),
    )

"""E1 and E3 as lazy Spark plans over real files.

* ``prepare_corpus``: metadata of each data set -> jamo column -> concatenation ->
  ``metadata_jamo`` files per data set and the one-text-per-line jamo corpus.
* ``build_trainset``: jamo metadata -> rows whose audio exists -> positions in
  concatenated order -> optional prefix -> byte tokens of the jamo text ->
  processed table (``text_tokens, audio_tokens, original_indices``) with the
  rejected rows and per-batch progress beside it.
* ``training_batches``: per-epoch shuffled batches, padded to the batch length.

Audio codes come from a table keyed by ``full_path`` (the neural codec is not
part of this library); a row without codes is rejected, as the reference does
when encoding fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorigil.functions.jamo import jamo, utf8_tokens
from sorigil.operators import batching, listing, order
from sorigil.sources import metadata as M


def prepare_corpus(spark: SparkSession, sources: Sequence[tuple[str, str, str]], out_dir: str, selected: Sequence[str] | None = None) -> DataFrame:
    """Write ``<out_dir>/metadata_jamo/source=<name>``, ``<out_dir>/all_jamo`` and the lines that do not fit to
    ``<out_dir>/rejects``; return the jamo metadata (filename, text, jamo, source)."""
    meta = M.select_sources(M.load_sources(spark, sources, with_jamo=False), selected)
    with_jamo = meta.where(F.col("_bad").isNull()).withColumn("jamo", jamo("text"))
    cols = ["filename", "text", "jamo"]
    # one read and one jamo pass; the corpus lines are made from the written rows
    lines = with_jamo.select("source", M.metadata_line(cols).alias("|".join(cols)))
    lines.write.mode("overwrite").partitionBy("source").options(**M.LINES).csv(f"{out_dir}/metadata_jamo")
    M.rejected(meta).write.mode("overwrite").parquet(f"{out_dir}/rejects")
    with_jamo = M.read_metadata(spark, f"{out_dir}/metadata_jamo", with_jamo=True)
    M.write_corpus(with_jamo, f"{out_dir}/all_jamo")
    return with_jamo


def file_number(filename="filename"):
    """Order key inside a data set: the last number in the file name (the reference names
    clips by their enumeration index). Null when there is no number, or one beyond 64 bits."""
    return F.regexp_extract(F.col(filename), "([0-9]+)[^0-9]*$", 1).try_cast("long")


def trainset_positions(meta: DataFrame) -> DataFrame:
    """W1 + W2: rows ordered by (file number, file name) inside each data set, data sets in order.

    Files without a number come first, by name; they are spread over tasks like all others."""
    return order.concat_positions(meta.withColumn("_num", file_number()), "_num", order_cols=["_num", "filename"]).drop("_num")


def build_trainset(
    spark: SparkSession,
    sources: Sequence[tuple[str, str, str]],
    audio_root: str,
    audio_codes: DataFrame,
    out_path: str,
    max_samples: int | None = None,
    batch_size: int = 8,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Return (processed, rejects, progress); the processed table is written once and reused.

    ``audio_root`` is listed once (S2) and joined on ``full_path`` (J1);
    ``audio_codes`` holds ``full_path, audio_tokens``."""
    meta = M.load_sources(spark, sources, with_jamo=True).where(F.col("_bad").isNull())
    kept = order.max_samples(trainset_positions(listing.with_audio(meta, M.list_audio(spark, audio_root))), max_samples)
    encoded = kept.select("pos", "full_path", utf8_tokens("jamo").alias("text_tokens")).join(
        audio_codes.select("full_path", "audio_tokens"), "full_path", "left"
    )
    ok, rejects = listing.keep_valid(encoded)
    valid = (F.col("text_tokens").isNotNull() & F.col("audio_tokens").isNotNull()).alias("valid")
    progress = listing.progress(encoded.select("pos", valid), batch_size)
    made_from = M.fingerprint(meta, audio_codes, max_samples=max_samples)
    processed = M.processed_or_build(
        spark, out_path, lambda: ok.select("text_tokens", "audio_tokens", F.col("pos").alias("original_indices")), made_from
    )
    return processed, rejects, progress


def training_batches(processed: DataFrame, epochs: int, batch_size: int = 8, seed: int = 0, text_length: int = batching.TEXT_LENGTH, audio_length: int = batching.AUDIO_LENGTH, channels: int = batching.CHANNELS) -> DataFrame:
    """L3 + W3 + A2 + R1-R5: padded text and audio per row, grouped by (epoch, batch_id)."""
    b = batching.assign_batches(processed.withColumnRenamed("original_indices", "pos"), batch_size, epochs, seed)
    t = batching.collate_text(b, "text_tokens", text_length, batching.TEXT_PAD).withColumnRenamed("padded", "text_padded").withColumnRenamed("batch_len", "text_len")
    return batching.collate_audio(t, "audio_tokens", audio_length, channels, batching.AUDIO_PAD).withColumnRenamed("padded", "audio_padded")

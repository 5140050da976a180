"""Training batches from the processed table.

Each epoch draws a deterministic random order (``order.shuffled_positions``),
cuts it into batches of B rows, and pads every row of a batch to the batch's
longest sequence capped by the configured limit. The per-batch maximum is a
window over ``batch_id``: a batch has at most B rows, so no window partition
grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorigil.functions import arrays
from sorigil.operators import order

# Defaults of the dialogue model's data configuration (text and audio limits,
# pad values, channel count), exposed as parameters.
TEXT_LENGTH = 1024
AUDIO_LENGTH = 3072
TEXT_PAD = 0
AUDIO_PAD = 1025
CHANNELS = 9


def assign_batches(df: DataFrame, batch_size: int, epochs=1, seed: int = 0, pos: str = "pos") -> DataFrame:
    """L3 + W3: ``epoch, shuffled_pos, batch_id`` per row for each epoch."""
    sh = order.shuffled_positions(df, epochs, seed, pos)
    return sh.withColumn("batch_id", order.batch_id("shuffled_pos", batch_size))


def batch_length(col: str | Column, cap: int):
    """A2: ``least(max(size(col)) over the batch, cap)``; a column of sizes is taken as it is."""
    w = Window.partitionBy("epoch", "batch_id")
    return F.least(F.max(F.size(col) if isinstance(col, str) else col).over(w), F.lit(cap))


def collate_text(df: DataFrame, tokens: str = "text_tokens", max_len: int = TEXT_LENGTH, pad: int = TEXT_PAD) -> DataFrame:
    """R1, R3-R5 on batched rows: padded tokens, padding mask, attention mask and positions.

    No row is padded beyond ``max_len``, so each row goes to its batch with its first ``max_len`` tokens and its size: the
    exchange carries the whole tokens only for a reader that asks for them."""
    sized = df.withColumns({"_n": F.size(tokens), "_head": F.slice(tokens, 1, max(max_len, 0))})
    out = sized.withColumn("_len", batch_length(F.col("_n"), max_len))
    padded = arrays.truncate_pad("_head", F.col("_len"), pad)
    return out.select(
        "*",
        padded.alias("padded"),
    ).select(
        "*",
        arrays.padding_mask("padded", pad).alias("padding_mask"),
        F.array_repeat(F.lit(1), F.col("_n")).alias("attention_mask"),
        arrays.positions(F.col("_len")).alias("positions"),
    ).drop("_n", "_head").withColumnRenamed("_len", "batch_len")


def collate_audio(
    df: DataFrame, tokens: str = "audio_tokens", max_len: int = AUDIO_LENGTH, channels: int = CHANNELS, pad: int = AUDIO_PAD
) -> DataFrame:
    """R2: audio rows cut to the batch length (capped) and filled with pad rows."""
    n = batch_length(tokens, max_len)
    out = df.withColumn("batch_len", n)
    return out.withColumn("padded", arrays.truncate_pad_2d(tokens, F.col("batch_len"), channels, pad))


def repeat_rows(df: DataFrame, slot: str, k: int = 2) -> DataFrame:
    """Every row ``k`` times, copies adjacent: ``copy`` in 0..k-1 and the row's place
    in the enlarged batch ``k * slot + copy`` (``slot`` = place in the original batch)."""
    out = df.select("*", arrays.copies(k))
    return out.withColumn("slot_k", (F.col(slot) * k + F.col("copy")).cast("bigint"))


def is_kth(slot_k: str = "slot_k", k: int = 2):
    """True for places 0, k, 2k, ... of an enlarged batch (the first copy of each row)."""
    return F.col(slot_k) % k == 0


def every_kth(df: DataFrame, k: int = 2, slot_k: str = "slot_k") -> DataFrame:
    """R6 (inverse): the rows at places 0, k, 2k, ... of an enlarged batch."""
    return df.where(is_kth(slot_k, k))

"""The training examples of the speech model as one plan: log-mel features, token ids and attention mask per clip.

A clip's features are many rows, ``(clip_id, block)`` with at most ``block_frames`` frames each as a 2-D array in order, so no group holds a
whole clip; ``n_blocks`` and ``n_frames`` of the clip let a reader put them together. The ids and the mask (one 1 per id) stand in the first block's row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorigil.functions import arrays
from sorigil.operators import encode, spectral

BLOCK_FRAMES = 512


def frame_blocks(frames: DataFrame, block_frames: int = BLOCK_FRAMES, col: str = "features") -> DataFrame:
    """Frame rows regrouped: ``clip_id, block, features`` (2-D, frames in order). A group is one block."""
    block = F.floor(F.col("frame_idx") / block_frames).cast("int")
    grouped = frames.select("clip_id", block.alias("block"), F.struct("frame_idx", F.col(col).alias("v")).alias("f")).groupBy("clip_id", "block").agg(F.array_sort(F.collect_list("f")).alias("fs"))
    return grouped.select("clip_id", "block", F.transform("fs", lambda f: f["v"]).alias("features"))


def frame_counts(clips: DataFrame, n_fft: int, hop: int, array_col: str = "audio.array") -> DataFrame:
    """``clip_id, n_frames`` of centred frames, from the clips' lengths alone."""
    n = F.floor((F.size(array_col) + 2 * (n_fft // 2) - n_fft) / hop).cast("int") + 1
    return clips.select("clip_id", F.when(F.col(array_col).isNull(), F.lit(0)).otherwise(F.greatest(n, F.lit(0))).alias("n_frames"))


def feature_table(
    clips: DataFrame,
    texts: DataFrame,
    vocab: DataFrame,
    n_fft: int = spectral.N_FFT,
    hop: int | None = None,
    n_mels: int | None = spectral.N_MELS,
    block_frames: int = BLOCK_FRAMES,
) -> DataFrame:
    """``clip_id, block, n_blocks, n_frames, features, input_ids, attention_mask``.

    ``clips`` has ``clip_id, audio``; ``texts`` has ``clip_id, jamo`` (a clip without a text has no ids, a null text empty ones; a text without a clip
    has no row). A clip without samples (null) has one row without features; an empty one has the frame of its padding. Each distinct word is segmented once."""
    hop = hop or n_fft // 4
    frames = spectral.log_features(clips, n_fft, hop, n_mels)
    blocks = frame_blocks(frames, block_frames)
    counts = frame_counts(clips, n_fft, hop)
    blocked = counts.select("clip_id", "n_frames", F.greatest(F.ceil(F.col("n_frames") / block_frames).cast("int"), F.lit(1)).alias("n_blocks"))
    rows = blocked.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")).join(blocks, ["clip_id", "block"], "left")
    words = encode.text_words(texts, "clip_id").select("word").distinct()
    ids = encode.encode_texts(texts, "clip_id", encode.segment_words(words, vocab)).select("clip_id", F.lit(0).alias("block"), F.col("ids").alias("input_ids"))
    return rows.join(ids, ["clip_id", "block"], "left").select(
        "clip_id", "block", "n_blocks", "n_frames", "features", "input_ids", arrays.attention_mask("input_ids").alias("attention_mask")
    )

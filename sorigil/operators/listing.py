"""Keeping rows whose audio exists, counting what was dropped, and encoding
progress (J1, J2, A1, P6, W4).

The file listing and the metadata are joined on ``full_path``. Both sides grow
with the corpus, so neither is broadcast by default: the semi and anti joins
shuffle on the path, and AQE turns them into broadcast joins when a side's
runtime size is under the threshold, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorigil.operators.order import batch_id as batch_of
from sorigil.operators.order import running_total


def with_audio(meta: DataFrame, listing: DataFrame, path_col: str = "full_path") -> DataFrame:
    """Rows whose audio file exists (left semi join; listing duplicates do not multiply rows)."""
    return meta.join(listing.select(path_col), path_col, "left_semi")


def missing_audio(meta: DataFrame, listing: DataFrame, path_col: str = "full_path") -> DataFrame:
    """Rows whose audio file does not exist (left anti join)."""
    return meta.join(listing.select(path_col), path_col, "left_anti")


def source_counts(meta: DataFrame, listing: DataFrame, path_col: str = "full_path", source_col: str = "source") -> DataFrame:
    """A1: rows before and after the existence filter per data set, with a grand total
    (``source`` null). One pass: a left join flags each row, then a rollup."""
    flagged = meta.join(listing.select(path_col).distinct().withColumn("_has", F.lit(1)), path_col, "left")
    return flagged.rollup(source_col).agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count("_has").alias("n_after"),
        (F.count(F.lit(1)) - F.count("_has")).alias("n_missing"),
    )


def keep_valid(df: DataFrame, cols=("text_tokens", "audio_tokens")) -> tuple[DataFrame, DataFrame]:
    """Rows whose encoding succeeded (all ``cols`` non-null) and the rejects with a reason.

    The reason is exploded from an array of one, so that the filter on it stays above the encoding instead of running it once more."""
    reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(f"{c} failed")) for c in cols])
    told = df.select("*", F.explode(F.array(reason)).alias("reason"))
    return told.where(F.col("reason") == "").drop("reason"), told.where(F.col("reason") != "")


def progress(encoded: DataFrame, batch_size: int = 8, valid_col: str = "valid", pos: str = "pos") -> DataFrame:
    """Per encoding batch, ``batch_end`` (rows processed so far), the total and the
    running count of valid rows. ``encoded`` holds one row per input position.

    The encoding batch size is ``min(batch_size, 32)``. The per-batch table is
    aggregated first; the running count is two-level (``running_total``)."""
    b = min(batch_size, 32)
    per_batch = encoded.groupBy(batch_of(pos, b).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(valid_col).cast("long")).alias("n_valid")
    )
    total = per_batch.agg(F.sum("n_rows")).scalar()  # scalar subquery over the per-batch table
    out = running_total(per_batch, "batch_id", "n_valid", "valid_so_far")
    return out.select(
        "batch_id",
        F.least((F.col("batch_id") + 1) * b, total).alias("batch_end"),
        total.alias("total"),
        "n_valid",
        F.col("valid_so_far").cast("long").alias("valid_so_far"),
    )

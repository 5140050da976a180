"""Incremental corpus preparation with Structured Streaming.

The same operators as the batch corpus step (read pipe-separated metadata,
decompose Hangul into jamo, write ``filename|text|jamo`` rows), run over
metadata files as they arrive in a folder. Progress and exactly-once output
come from the query's checkpoint location, which the caller names and which must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sorigil.functions.jamo import jamo
from sorigil.sources.metadata import parse_metadata


def metadata_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: new ``filename|text`` files under ``folder`` (header line consumed);
    a row that does not fit the schema is kept in ``_bad``."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_metadata(reader.text(folder).select("value", F.col("_metadata.file_path").alias("source_file")))


def jamo_metadata_stream(stream: DataFrame) -> DataFrame:
    """T1 on each arriving row: ``filename, text, jamo, source_file``."""
    return stream.where(F.col("_bad").isNull()).select("filename", "text", jamo("text").alias("jamo"), "source_file")


def start_jamo_ingest(
    spark: SparkSession,
    in_folder: str,
    out_path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Run the incremental corpus step into a Parquet table (append mode).

    ``checkpoint`` is a folder on shared storage that belongs to this stream: a restart with the same folder
    goes on where the last run ended, so each file is written once."""
    out = jamo_metadata_stream(metadata_stream(spark, in_folder)).writeStream.format("parquet").option("path", out_path)
    out = out.option("checkpointLocation", checkpoint).outputMode("append")
    out = out.trigger(availableNow=True) if available_now else out.trigger(processingTime="30 seconds")
    return out.start()

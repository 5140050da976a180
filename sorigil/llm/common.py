"""Helpers shared by the operators: tables, the shared work folder, whole-table writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sorigil.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never a machine-local one on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, so that a lost
    executor costs at most the running stage, and later branches read the file instead of
    recomputing it."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    with batches_of(spark, BATCH_ROWS):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans made inside hand Python at most ``rows`` rows at once: with whole texts the usual 10,000 make
    buffers of up to a gigabyte outside the heap."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 1000, size: int = 8 << 20) -> Callable:
    """``mapInArrow`` body that hands ``fn`` slices of at most ``rows`` rows and, where rows
    allow it, about ``size`` bytes, so that its working memory does not follow Spark's batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows, size):
                yield fn(part)

    return run


def slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    step = max(1, min(rows, int(batch.num_rows * size / max(batch.nbytes, 1)) or 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)

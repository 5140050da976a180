"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage in iterative jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sorigil") -> SparkSession:
    """A local session with AQE on and the web UI off (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is only read
    here. When it is unset (a local test session) a scratch folder is created;
    on a non-local master an unset value is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc._jsc.sc().getCheckpointDir().get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    path = tempfile.mkdtemp(prefix="sorigil-ckpt-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work at least one task per core.

    When a scan yields fewer partitions than the session's parallelism (a few
    large row groups), rows are dealt round-robin over that many partitions.
    At cluster scale the scan already has far more partitions than cores and
    this is a no-op."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


def task_count(spark: SparkSession) -> int:
    """Partitions for a Python-heavy stage: at least one per core and at least the
    configured shuffle partitions (an explicit count, which AQE does not coalesce)."""
    par = spark.sparkContext.defaultParallelism
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", str(par)))
    return max(par, shuffle)


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint when it holds at most ``max_rows`` rows (checked by
    counting at most ``max_rows + 1`` of them); otherwise unchanged, for a shuffle join.

    For tables whose size Spark cannot estimate before running (a checkpoint, the
    output of a Python stage), so the plan does not shuffle the large side first."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

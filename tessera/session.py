"""Session construction and lineage cutting.

The session is never global: every public function takes DataFrames (and
reaches the session through them).  ``get_spark`` is a convenience for tests,
the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster deployment is expected to override (partition count in
# particular).  AQE re-plans joins at runtime (broadcast conversion with the
# *measured* size, skew splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep at least one post-shuffle task per core on small inputs
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    # a literal term list of a small query batch prunes row groups by min/max
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}

# Whether an execution's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only fall back to a
    folder of our own when it is unset (local tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local runs (tests) only: a folder of our own
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing a Parquet table into the shared checkpoint
    folder and reading it back.

    Survives executor loss (unlike a local checkpoint), freezes
    non-deterministic columns such as ``monotonically_increasing_id``, and is
    columnar and compressed (an RDD checkpoint serialises whole rows).  The
    shuffle files of the write are removed with its end, not when the driver
    happens to collect garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    kept = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # once written, the table stands for its shuffles
    try:
        df.write.parquet(path)
    finally:
        if kept is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, kept)
    return spark.read.parquet(path)


def spread(df: DataFrame, keys: list[str] | None = None, min_partitions: int | None = None) -> DataFrame:
    """Give row-local heavy work (tokenising, encoding) enough tasks.

    A scan of one big file / row group yields a single task; only then is
    the input redistributed, hash-partitioned on ``keys`` (round-robin would
    sort the long text rows first).  On a cluster reading many files the scan
    already has enough splits and this is a no-op (no shuffle)."""
    try:
        sc = df.sparkSession.sparkContext
        want = min_partitions or sc.defaultParallelism
        if df.rdd.getNumPartitions() >= want:
            return df
    except Exception:  # noqa: BLE001 - sessions without the RDD API: leave as is
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)

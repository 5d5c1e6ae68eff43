"""Session settings and the shared checkpoint folder.

The library never hard-codes a machine-local folder for lineage cuts: it reads
``spark.checkpoint.dir`` from the running session.  Only when that is unset *and*
the master is local (tests, laptops) does it fall back to a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job wants regardless of size: AQE for runtime re-planning
# (partition coalescing, skew-join splitting, broadcast conversion).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "ludeme") -> SparkSession:
    """A local session for tests, bench and the small fixtures."""
    shuffle_partitions = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(cores))
        .config("spark.driver.memory", os.environ.get("LUDEME_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One process on one machine: ``local-cluster`` is not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it on the context if needed.

    Order: the context's own dir, then ``spark.checkpoint.dir`` from the session
    conf, then (local master only) a fresh temp folder.  On a cluster with neither
    set we refuse rather than write to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ludeme-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; a cluster job needs a shared folder for "
        "lineage cuts (set spark.checkpoint.dir to a distributed-filesystem path)")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ludeme-{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df, name: str, partition_by: str | None = None):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint folder
    and reading it back (ONE job; ``DataFrame.checkpoint`` computes its input
    twice).  The copy survives executor loss and gives Catalyst exact size
    statistics for later broadcast decisions.  ``partition_by``: a column of few values
    that later reads select by, each a folder of its own."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.write.mode("overwrite")
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)
    return spark.read.parquet(path)

"""Session construction and shared-folder helpers.

Lineage is cut with reliable ``checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting (tests,
laptops) gets a private folder under the system temp dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Token-level work is CPU-bound, not byte-bound: a few MB of text expands into
    # millions of tokens or co-occurrences.  Keep AQE from coalescing such a shuffle
    # into one or two tasks (the 1 MB default floor); at cluster scale partitions are
    # far above this floor anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "parallax", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where none is configured
    and the session is local."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="parallax-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of queries that have ended: it waits for the
    driver to collect its garbage, which a driver that has little to do puts off."""
    spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

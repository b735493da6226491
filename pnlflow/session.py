"""Spark session defaults for the job and its tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# AQE re-plans joins from run-time sizes, coalesces small shuffle partitions and
# splits skewed join partitions; ANSI keeps division by zero an error.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # delete checkpoint files once no plan references them, on any master
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pnlflow") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no server)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("PNLFLOW_DRIVER_MEMORY", "8g")))
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Uses the checkpoint folder already set on the context, else the cluster's
    ``spark.checkpoint.dir``.  Only a local session (tests, benchmark) without
    either gets a fresh scratch folder; on a cluster a machine-local folder
    would not survive the loss of an executor, so the setting is required."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
    path = tempfile.mkdtemp(prefix="pnlflow-ckpt-")
    sc.setCheckpointDir(path)
    return path

"""Session settings the library is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Naive timestamps everywhere; a fixed session zone keeps casts reproducible.
    "spark.sql.session.timeZone": "UTC",
    # A malformed timestamp or an overflowing cast must stop the job, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Recording the Python call site of every column expression doubles the driver's planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth a later shuffle when one key holds a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str = "8", app: str = "grainledger", shuffle_partitions: str | None = None,
                  memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. On a cluster, pass SETTINGS to spark-submit instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", shuffle_partitions or cores)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that the cluster names for checkpoints; a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

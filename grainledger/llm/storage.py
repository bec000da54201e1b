"""Written intermediates in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only in local mode, where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="run-")


#: How many rows Spark hands to a Python task at once.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The same where rows hold whole texts: Spark's own 10,000 of them are tens of megabytes, held several times over by both sides.
TEXTS = 1_000


@contextmanager
def batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """What runs inside hands so many rows at once to Python tasks; as many as before with None."""
    before = spark.conf.get(_BATCH)
    try:
        if rows:
            spark.conf.set(_BATCH, str(rows))
        yield
    finally:
        spark.conf.set(_BATCH, before)


def settle(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write a frame once and read it back: lineage is cut, and a lost executor costs only a file read.

    With `batch`, Python tasks get so many rows at once while it is written: fewer where rows are wide.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with batches(spark, batch):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out

"""Warehouse tables on shared storage: full-replace writes, and reading them back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table. Partitioned tables are rebalanced first: AQE then sizes the files and splits
    a partition value that holds far more rows than the others."""
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
        if read_table(df.sparkSession, path, df).isEmpty():  # no partition, no file: keep the columns at least
            df.limit(0).write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a written table back with the schema it was written with (no inference job)."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def append_rows(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(path)


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing was written. Any other failure to read it is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise

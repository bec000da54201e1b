"""The publish gate and the audit record of a run."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import latest_per_key

RUN_COLUMNS = (
    "run_id STRING, started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, status STRING, "
    "source_row_count BIGINT, canonical_row_count BIGINT, duplicate_count BIGINT, "
    "bad_file_count BIGINT, warning_count BIGINT, message STRING"
)
FAILED, DEGRADED, SUCCESS = "FAILED", "DEGRADED", "SUCCESS"


@dataclass
class RunRecord:
    run_id: str
    started_at: datetime
    finished_at: datetime | None = None
    status: str | None = None
    source_row_count: int | None = None
    canonical_row_count: int | None = None
    duplicate_count: int | None = None
    bad_file_count: int = 0
    warning_count: int = 0
    message: str | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(asdict(self).values())], RUN_COLUMNS)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def gate_frame(inventory: DataFrame, allow_degraded: bool) -> DataFrame:
    """One row: files, unreadable files, and the status they lead to. Their partitions are in `affected_partitions`."""
    bad = F.col("read_status") != "OK"
    tolerated = F.lit(DEGRADED if allow_degraded else FAILED)
    return inventory.agg(
        F.count("*").alias("files"),
        F.count_if(bad).alias("bad_file_count"),
    ).withColumn("status", F.when(F.col("bad_file_count") == 0, F.lit(SUCCESS)).otherwise(tolerated))


def gate(inventory: DataFrame, allow_degraded: bool = False) -> tuple[str, int]:
    """(status, unreadable files). One aggregate row comes to the driver."""
    row = gate_frame(inventory, allow_degraded).first()
    if row.files == 0:
        raise FileNotFoundError("no Parquet file found in any feed folder")
    return row.status, row.bad_file_count


def run_summary(inventory: DataFrame, delivered: DataFrame, canonical: DataFrame, grid: DataFrame,
                allow_degraded: bool = True) -> DataFrame:
    """The countable part of the audit record, as one row.

    Duplicates are delivered minus canonical rows. Any hole in the grid adds a single warning.
    """
    holes = grid.agg(F.count_if("is_missing").alias("n")).scalar()
    return gate_frame(inventory, allow_degraded).select(
        "status",
        delivered.agg(F.count("*").alias("n")).scalar().alias("source_row_count"),
        canonical.agg(F.count("*").alias("n")).scalar().alias("canonical_row_count"),
        "bad_file_count",
        (F.col("bad_file_count") + F.when(holes > 0, 1).otherwise(0)).alias("warning_count"),
    ).withColumn("duplicate_count", F.col("source_row_count") - F.col("canonical_row_count"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest record of an append-only run log."""
    newest = latest_per_key(runs.withColumn("_one", F.lit(1)), ["_one"], ["started_at"])
    return newest.select(*runs.columns)

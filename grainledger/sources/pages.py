"""Files whose footer reads and whose pages do not: probing pages, and a log of the files a warehouse goes without."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import latest_per_key, manifest_recon
from .inventory import ERROR_CHARS, opener

#: Rows decoded at once.
_ROWS = 1 << 16
HELD, RELEASED, GONE = "HELD", "RELEASED", "GONE"
QUARANTINE_COLUMNS = (
    "path STRING, feed STRING, `partition` STRING, bytes BIGINT, event STRING, error STRING, run_id STRING, at TIMESTAMP_NTZ"
)


def _read_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    open_file = opener()
    for batch in batches:
        errors = []
        for uri in batch["path"]:
            at = "footer"
            try:
                with open_file(uri) as handle:
                    file = pq.ParquetFile(handle, page_checksum_verification=True)
                    for group in range(file.num_row_groups):
                        for column in file.schema_arrow.names:
                            at = f"row group {group}, column {column}"
                            rows = sum(len(b) for b in file.iter_batches(_ROWS, row_groups=[group], columns=[column]))
                            if rows != file.metadata.row_group(group).num_rows:
                                raise ValueError(f"{rows} rows read of {file.metadata.row_group(group).num_rows}")
                errors.append(None)
            except Exception as exc:  # whatever stops a read here stops a scan
                errors.append(f"{at}: {exc}"[:ERROR_CHARS])
        yield pd.DataFrame({"path": batch["path"], "error": pd.Series(errors, dtype=object)})


def broken_pages(files: DataFrame) -> DataFrame:
    """(path, error) of the files (column path) with a page that does not decode or fails its checksum.

    Every page is read, a column of a row group at a time, in tasks that share the files evenly. Damage that still
    decodes is seen only if the writer stored checksums.
    """
    tasks = max(8, files.sparkSession.sparkContext.defaultParallelism * 2)
    return files.select("path").repartition(tasks, "path").mapInPandas(_read_pages, "path STRING, error STRING").where("error IS NOT NULL")


def suspects(inventory: DataFrame, manifest: DataFrame, held: DataFrame) -> DataFrame:
    """(path) of the files whose pages are worth reading: of partitions that differ from the manifest, and files held back."""
    differs = manifest_recon(manifest, inventory).where(
        "manifest_rows IS NOT NULL AND (manifest_rows <> observed_rows_ok OR manifest_files <> observed_files)"
    )
    readable = inventory.where("read_status = 'OK'")
    of_partitions = readable.join(differs, ["feed", "partition"], "left_semi").select("path")
    return of_partitions.union(readable.join(held, "path", "left_semi").select("path")).distinct()


def with_pages(inventory: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The inventory after reading all pages of some files (one column, path), or of all readable ones."""
    readable = inventory.where("read_status = 'OK'")
    bad = broken_pages(readable if files is None else readable.join(files, "path", "left_semi"))
    both = inventory.join(bad.select("path", F.col("error").alias("_error")), "path", "left")
    ok = F.col("_error").isNull()
    changed = {
        "actual_rows": F.when(ok, F.col("actual_rows")),
        "read_status": F.when(ok, F.col("read_status")).otherwise("CORRUPT"),
        "error": F.coalesce("_error", "error"),
        "columns": F.when(ok, F.col("columns")),
    }
    return both.select(*(changed.get(c, F.col(c)).alias(c) for c in inventory.columns))


def held_back(log: DataFrame) -> DataFrame:
    """The files that are held back by the last word of the log on each."""
    return latest_per_key(log, ["path"], ["at"]).where(F.col("event") == HELD).select(*log.columns)


def quarantine_events(held: DataFrame, inventory: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """What a run adds to the log: files newly HELD (or held with other bytes), RELEASED because they read, and GONE."""
    before = held.select("path", F.col("feed").alias("_feed"), F.col("partition").alias("_partition"), F.col("bytes").alias("_bytes"), F.lit(True).alias("_held"))
    now = inventory.select("path", "feed", "partition", "bytes", "error", (F.col("read_status") == "OK").alias("_ok"))
    both = now.where("NOT _ok").join(before, "path", "left").unionByName(
        now.where("_ok").join(before, "path"), allowMissingColumns=True
    ).unionByName(before.join(now.select("path"), "path", "left_anti"), allowMissingColumns=True)
    event = (
        F.when(F.col("_ok").isNull(), GONE)
        .when(F.col("_ok"), RELEASED)
        .when(F.col("_held").isNull() | (F.col("bytes") != F.col("_bytes")), HELD)
    )
    return both.select(
        "path",
        F.coalesce("feed", "_feed").alias("feed"),
        F.coalesce("partition", "_partition").alias("partition"),
        F.coalesce("bytes", "_bytes").alias("bytes"),
        event.alias("event"),
        F.when(event == HELD, F.col("error")).alias("error"),
        F.lit(run_id).alias("run_id"),
        F.lit(at).cast("timestamp_ntz").alias("at"),
    ).where("event IS NOT NULL")

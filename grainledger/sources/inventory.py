"""One row per physical file: size, footer row count, readable or not."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyarrow import NativeFile
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INVENTORY_COLUMNS = (
    "path STRING, feed STRING, `partition` STRING, bytes BIGINT, actual_rows BIGINT, read_status STRING, error STRING, "
    "columns ARRAY<STRING>"
)
ERROR_CHARS = 500


def landed(before: str | None) -> dict[str, str]:
    """Read options that leave out files modified at the given time (UTC) or later."""
    return {"modifiedBefore": before, "timeZone": "UTC"} if before else {}


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.format("binaryFile").load(path).select("path").take(1))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def cut_off() -> str:
    """A time, for `modifiedBefore`, that covers all files landed so far. Later ones belong to the next run."""
    return (datetime.now(timezone.utc) + timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")


def list_files(spark: SparkSession, folder: str, before: str | None = None) -> DataFrame | None:
    """(path, bytes) of the Parquet files below a folder; None when the folder does not exist.

    Spark lists large folders on the executors. File contents are pruned from this read.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .options(recursiveFileLookup=True, pathGlobFilter="*.parquet", **landed(before))
            .load(folder)
        )
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))


def opener() -> Callable[[str], NativeFile]:
    """Opens files by the addresses Spark lists; each store is connected to once."""
    from urllib.parse import unquote, urlparse

    from pyarrow import fs

    stores: dict[tuple[str, str], fs.FileSystem] = {}

    def open_file(uri: str) -> NativeFile:
        at = urlparse(uri)
        store = (at.scheme, at.netloc)
        if at.scheme in ("", "file"):
            stores.setdefault(store, fs.LocalFileSystem())
            where = unquote(at.path)
        elif store not in stores:
            stores[store], where = fs.FileSystem.from_uri(uri)
        else:
            where = at.netloc + at.path if at.scheme != "hdfs" else at.path
        return stores[store].open_input_file(where)

    return open_file


def _footer(handle: NativeFile) -> tuple[int, list[str]]:
    """Rows and columns of a file whose footer reads and whose column chunks lie inside the file."""
    import pyarrow.parquet as pq

    footer, size = pq.read_metadata(handle), handle.size()
    for g in range(footer.num_row_groups):
        for c in range(footer.num_columns):
            chunk = footer.row_group(g).column(c)
            start = chunk.dictionary_page_offset or chunk.data_page_offset
            if start < 4 or start + chunk.total_compressed_size > size - 8:
                raise ValueError(f"column {chunk.path_in_schema} of row group {g} lies outside the file")
    names = dict.fromkeys(footer.schema.column(i).path.split(".")[0] for i in range(footer.num_columns))
    return footer.num_rows, list(names)


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    open_file = opener()
    for batch in batches:
        found = []
        for uri in batch["path"]:
            try:
                with open_file(uri) as handle:
                    rows, names = _footer(handle)
                found.append((rows, "OK", None, names))
            except Exception as exc:  # any failure to read the footer makes the file unusable
                found.append((None, "CORRUPT", str(exc)[:ERROR_CHARS], None))
        rows, status, errors, columns = map(list, zip(*found)) if found else ([], [], [], [])
        yield batch.assign(actual_rows=pd.array(rows, dtype="Int64"), read_status=status, error=errors, columns=columns)


def probe_footers(files: DataFrame) -> DataFrame:
    """Add `actual_rows`, `read_status`, `error` and `columns` by reading each file's footer on an executor.

    The rows are tiny but each one costs a file open, so they are spread over a fixed number of
    tasks that adaptive coalescing leaves alone.
    """
    tasks = max(8, files.sparkSession.sparkContext.defaultParallelism * 2)
    return files.repartition(tasks, "path").mapInPandas(_probe, INVENTORY_COLUMNS)


def file_inventory(spark: SparkSession, feeds: Mapping[str, str], before: str | None = None) -> DataFrame:
    """Inventory of the Parquet files of each feed (name → folder). Absent folders are skipped."""
    found: DataFrame | None = None
    for name, folder in feeds.items():
        files = list_files(spark, folder, before)
        if files is None:
            continue
        files = files.select(
            "path",
            F.lit(name).alias("feed"),
            F.element_at(F.split("path", "/"), -2).alias("partition"),
            "bytes",
        )
        found = files if found is None else found.unionByName(files)
    if found is None:
        return spark.createDataFrame([], INVENTORY_COLUMNS)
    return probe_footers(found)


def affected_partitions(inventory: DataFrame) -> DataFrame:
    """The unreadable files, by name. They are left out of the tables but never out of sight."""
    return inventory.where(F.col("read_status") != "OK").drop("columns")


def column_drift(inventory: DataFrame, layouts: Mapping[str, Sequence[str]]) -> DataFrame:
    """(feed, column, finding, files, first_partition, last_partition): where files and declared layouts differ.

    UNDECLARED: readable files hold a column that the layout lacks, for instance because it was renamed: its values are
    not read. ABSENT: no readable file of the feed holds a declared column: it reads as NULL throughout. Names are
    compared as Spark reads them, without regard to case. `layouts` maps feeds to their columns.
    """
    spark = inventory.sparkSession
    names = [(feed, c, c.lower()) for feed, columns in layouts.items() for c in columns]
    declared = spark.createDataFrame(names, "feed STRING, _declared STRING, _key STRING")  # the layouts' own size
    files = inventory.where((F.col("read_status") == "OK") & F.col("feed").isin(*layouts))
    held = files.select("feed", "partition", F.explode("columns").alias("_held")).groupBy(
        F.col("feed").alias("_feed"), F.lower("_held").alias("_name")
    ).agg(
        F.min("_held").alias("_held"), F.count("*").alias("files"),
        F.min("partition").alias("first_partition"), F.max("partition").alias("last_partition"),
    )
    seen = files.select("feed").distinct()
    on = (F.col("feed") == F.col("_feed")) & (F.col("_key") == F.col("_name"))
    both = declared.join(seen, "feed").join(held, on, "full").where("_declared IS NULL OR _held IS NULL")
    return both.select(
        F.coalesce("feed", "_feed").alias("feed"),
        F.coalesce("_held", "_declared").alias("column"),
        F.when(F.col("_declared").isNull(), "UNDECLARED").otherwise("ABSENT").alias("finding"),
        F.coalesce("files", F.lit(0)).cast("bigint").alias("files"),
        "first_partition",
        "last_partition",
    )

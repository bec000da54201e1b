"""Build every table from a landing zone, and open a built warehouse for questions.

A run writes its tables below its own folder and becomes visible only when its audit record is
appended to the run log. A failed gate therefore publishes the inventory and the record, and no
table of an earlier run is mistaken for its result. Each table is written to shared storage before
anything reads it, which ends lineage there: a lost executor repeats one stage, not the whole run,
and Spark plans the joins of the next table from real file sizes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.feeds import FEEDS, REFERENCES, read_manifest, read_reference, scan_feed
from ..sources.inventory import affected_partitions, column_drift, cut_off, file_inventory
from ..sources.pages import QUARANTINE_COLUMNS, held_back, quarantine_events, suspects, with_pages
from ..sources.tables import append_rows, read_table, try_read, write_table
from . import marts, staging
from .runs import DEGRADED, FAILED, RunRecord, gate, latest_run, utc_now

# Raw table names by feed.
RAW_TABLES = {
    "raw_pos": "pos_transactions",
    "raw_telemetry": "reefer_telemetry",
    "raw_wms": "wms_scan_events",
    "raw_outlet": "outlet_master",
    "raw_product": "product_master",
    "raw_orders": "sales_order_header",
}

# table → (builder, names of the tables it reads). Listed in dependency order.
TABLES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "stg_pos": (staging.stg_pos, ("raw_pos",)),
    "dq_firmware_clock": (staging.dq_firmware_clock, ("raw_telemetry",)),
    "stg_telemetry": (staging.stg_telemetry, ("raw_telemetry", "dq_firmware_clock")),
    "stg_wms": (staging.stg_wms, ("raw_wms",)),
    "dim_outlet_scd2": (staging.dim_outlet_scd2, ("raw_outlet",)),
    "dim_product": (staging.dim_product, ("raw_product",)),
    "dq_uom_vs_case_pack": (staging.dq_uom_vs_case_pack, ("dim_product", "uom_conversion")),
    "stg_orders": (staging.stg_orders, ("raw_orders",)),
    "dim_date": (marts.dim_date, ("fiscal_calendar",)),
    "fct_pos_line": (marts.fct_pos_line, ("stg_pos", "dim_outlet_scd2", "dim_product", "uom_conversion")),
    "fct_sales_daily": (marts.fct_sales_daily, ("fct_pos_line", "dim_date")),
    "fct_finance_recon": (marts.fct_finance_recon, ("raw_pos", "stg_pos", "legacy_finance_weekly_report")),
    "fct_cold_chain_trip": (marts.fct_cold_chain_trip, ("stg_telemetry",)),
    "fct_wms_cycle": (marts.fct_wms_cycle, ("stg_wms",)),
    "fct_wms_cycle_warehouse": (marts.fct_wms_cycle_warehouse, ("fct_wms_cycle",)),
    "fct_outlet_channel_change": (marts.fct_outlet_channel_change, ("dim_outlet_scd2",)),
    "dq_partition_recon": (marts.dq_partition_recon, ("ingest_manifest", "file_inventory")),
    "dq_affected_partitions": (affected_partitions, ("file_inventory",)),
    "dq_gateway_date": (marts.dq_gateway_date, ("raw_telemetry",)),
    "dq_missing_gateway_days": (marts.dq_missing_gateway_days, ("dq_gateway_date",)),
    "dq_daily_telemetry_volume": (marts.dq_daily_telemetry_volume, ("raw_telemetry",)),
    "fct_dispatch_on_request": (marts.fct_dispatch_on_request, ("stg_orders", "stg_wms")),
    "fct_order_source": (marts.fct_order_source, ("stg_orders",)),
    "dq_order_source_profile": (staging.dq_order_source_profile, ("fct_order_source",)),
}

# The questions about a quarter, a month or a week read this table: laid out by day, they read only
# those days. Staging tables are read whole, so they are not worth another shuffle.
PARTITION_BY = {"fct_pos_line": "business_date"}

RUN_LOG = "pipeline_run"
#: Log of the files that were held back and released, over all runs.
QUARANTINE = "quarantine"
_UNREADABLE = re.compile(r"FAILED_READ_FILE\.(NO_HINT|CANNOT_READ_FILE_FOOTER).*?\.parquet", re.DOTALL)

#: Undeclared columns that a run's message names; dq_column_drift has them all.
NAMED = 5


def compose(source: Callable[[str], DataFrame], *names: str,
            settle: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Compose the named tables. Nothing runs unless `settle` makes it.

    `source` supplies a raw feed, reference or inventory by name; only what the named tables read
    is asked for. `settle` may replace a table that others read, for instance by a written copy.
    """
    made: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in made:
            if name in TABLES:
                builder, reads = TABLES[name]
                made[name] = builder(*[read(r) for r in reads])
            else:
                made[name] = source(name)
        return made[name]

    def read(name: str) -> DataFrame:
        if name not in settled:
            settled[name] = settle(name, get(name)) if settle and name in TABLES else get(name)
        return settled[name]

    settled: dict[str, DataFrame] = {}
    return {n: get(n) for n in names}


def build_warehouse(spark: SparkSession, landing: str, out: str, allow_degraded: bool = False,
                    all_pages: bool = False) -> RunRecord:
    """Inventory, gate, then every table. Returns the audit record that was appended.

    Footers of all files are read, and the pages of files that are suspect: held back before, or in a partition that
    differs from the manifest. With `all_pages` every page is. If a scan still meets a page that does not read, the
    build starts over with `all_pages`: the gate then knows every such file, instead of the build failing on one.
    """
    try:
        return _build(spark, landing, out, allow_degraded, all_pages)
    except Exception as exc:
        if all_pages or not _UNREADABLE.search(str(exc)):
            raise
        return _build(spark, landing, out, allow_degraded, True)


def _build(spark: SparkSession, landing: str, out: str, allow_degraded: bool, all_pages: bool) -> RunRecord:
    run = RunRecord(run_id=str(uuid.uuid4()), started_at=utc_now())
    home = f"{out.rstrip('/')}/{run.run_id}"
    made: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame) -> None:
        write_table(df, f"{home}/{name}", PARTITION_BY.get(name))
        made[name] = read_table(spark, f"{home}/{name}", df)

    def finish() -> RunRecord:
        run.finished_at = utc_now()
        append_rows(run.frame(spark), f"{out.rstrip('/')}/{RUN_LOG}")
        return run

    base = landing.rstrip("/")
    before = cut_off()
    feeds = {f.name: f"{base}/{f.path}" for f in FEEDS.values()}
    save("ingest_manifest", read_manifest(spark, landing))
    save("_footers", file_inventory(spark, feeds, before))
    log = try_read(spark, f"{out.rstrip('/')}/{QUARANTINE}")
    held = held_back(spark.createDataFrame([], QUARANTINE_COLUMNS) if log is None else log)
    some = None if all_pages else suspects(made["_footers"], made["ingest_manifest"], held)
    save("file_inventory", with_pages(made["_footers"], some))
    save("_quarantine", quarantine_events(held, made["file_inventory"], run.run_id, run.started_at))
    if made["_quarantine"].take(1):
        append_rows(made["_quarantine"], f"{out.rstrip('/')}/{QUARANTINE}")
    run.status, run.bad_file_count = gate(made["file_inventory"], allow_degraded)
    if run.status == FAILED:
        run.warning_count = run.bad_file_count
        run.message = (
            f"{run.bad_file_count} unreadable file(s); nothing was published. "
            "See file_inventory, or allow degraded input to go on without them."
        )
        return finish()

    save("dq_column_drift", column_drift(made["file_inventory"], {f.name: f.schema.names for f in FEEDS.values()}))
    for name in REFERENCES:
        save(name, read_reference(spark, landing, name))
    for table, feed in RAW_TABLES.items():
        made[table] = scan_feed(spark, landing, FEEDS[feed], made["file_inventory"], before)
    check_scans({feed: made[table] for table, feed in RAW_TABLES.items()}, made["file_inventory"])
    lines = Observation()  # counted while the table is written
    for name, (builder, reads) in TABLES.items():
        df = builder(*[made[r] for r in reads])
        save(name, df.observe(lines, F.count(F.lit(1)).alias("rows")) if name == "fct_pos_line" else df)

    delivered = (F.col("feed") == RAW_TABLES["raw_pos"]) & (F.col("read_status") == "OK")
    run.source_row_count = made["file_inventory"].where(delivered).agg(F.sum("actual_rows")).first()[0]
    run.canonical_row_count = 0 if made["fct_pos_line"].isEmpty() else lines.get["rows"]  # nothing observed, no figure
    run.duplicate_count = run.source_row_count - run.canonical_row_count
    holes = bool(made["dq_missing_gateway_days"].take(1))
    undeclared = made["dq_column_drift"].where("finding = 'UNDECLARED'")
    named = undeclared.orderBy("feed", "column").limit(NAMED + 1).collect()
    run.warning_count = run.bad_file_count + int(holes) + (undeclared.count() if named else 0)
    said = []
    if run.bad_file_count:
        said.append(f"built without {run.bad_file_count} unreadable file(s); see dq_affected_partitions")
    if named:  # their values are in no table: a renamed column would otherwise read as NULL unnoticed
        run.status = DEGRADED
        columns = ", ".join(f"{r.feed}.{r.column}" for r in named[:NAMED]) + ("" if len(named) <= NAMED else ", ...")
        said.append(f"undeclared column(s) not read: {columns}; see dq_column_drift")
    run.message = "; ".join(said) or None
    return finish()


def check_scans(scans: Mapping[str, DataFrame], inventory: DataFrame) -> None:
    """Every scan must hold the rows that the gate has counted, from footers on both sides: one job for all feeds."""
    counted = [df.agg(F.count("*").alias("found")).select(F.lit(feed).alias("feed"), "found") for feed, df in scans.items()]
    expected = inventory.where("read_status = 'OK'").groupBy("feed").agg(F.sum("actual_rows").alias("expected"))
    both = reduce(DataFrame.unionAll, counted).join(expected, "feed", "left")
    wrong = both.where(~F.col("found").eqNullSafe(F.col("expected"))).collect()  # a row for each feed at most
    if wrong:
        said = "; ".join(f"{r.feed}: the inventory counted {r.expected} rows and the scan found {r.found}" for r in wrong)
        raise RuntimeError(said)


def open_warehouse(spark: SparkSession, out: str) -> DataFrame:
    """Register the latest run's tables as temporary views; returns its audit record."""
    base = out.rstrip("/")
    log = try_read(spark, f"{base}/{RUN_LOG}")
    if log is None:
        raise FileNotFoundError(f"no warehouse at {out}: build it first")
    latest = latest_run(log)
    latest.createOrReplaceTempView(RUN_LOG)
    log = try_read(spark, f"{base}/{QUARANTINE}")
    (spark.createDataFrame([], QUARANTINE_COLUMNS) if log is None else log).createOrReplaceTempView(QUARANTINE)
    run_id, published = latest.select("run_id").first().run_id, is_published(latest)
    for name in ("file_inventory", "ingest_manifest", "dq_column_drift", *REFERENCES, *TABLES):
        table = try_read(spark, f"{base}/{run_id}/{name}")
        if table is not None:
            table.createOrReplaceTempView(name)
        elif published and name != "dq_column_drift" or name in ("file_inventory", "ingest_manifest"):  # older runs lack it
            raise FileNotFoundError(f"run {run_id} is in the log, but its table {name} is missing")
        else:
            spark.catalog.dropTempView(name)
    return latest


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def is_published(latest: DataFrame) -> bool:
    return bool(latest.where(F.col("status") != FAILED).take(1))

"""Feed layouts, and scans that never touch an unreadable file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .inventory import landed, path_exists


@dataclass(frozen=True)
class Feed:
    """A partitioned Parquet feed: where it lands and every column any of its files may have.

    Declaring the columns makes schema drift free: a file without a declared column yields NULLs,
    and no footers are merged at planning time. `partition` is the directory column.
    """

    name: str
    path: str
    partition: str
    columns: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(f"{self.columns}, {self.partition} DATE")


_CDC = "__op STRING, __op_ts STRING, __seq BIGINT"

# Names, folders and column layouts of the landing zone.
FEEDS = {
    f.name: f
    for f in (
        Feed(
            "pos_transactions",
            "raw/pos_transactions",
            "ingest_date",
            "txn_id STRING, txn_line_no SMALLINT, basket_id STRING, outlet_code STRING, channel STRING, "
            "sku_code STRING, event_ts STRING, qty INT, quantity_units INT, uom STRING, unit_price DOUBLE, "
            "discount_amount DOUBLE, tax_amount DOUBLE, payment_mode STRING, till_id SMALLINT, "
            "cashier_id STRING, promo_code STRING, loyalty_id STRING, source_file STRING",
        ),
        Feed(
            "reefer_telemetry",
            "raw/reefer_telemetry",
            "dt",
            "device_id STRING, telemetry_vendor STRING, firmware_version STRING, "
            "vehicle_registration STRING, route_code STRING, warehouse_code STRING, gateway_id STRING, "
            "reading_ts STRING, temp_value DOUBLE, temp_unit STRING, humidity_pct DOUBLE, "
            "door_open_flag TINYINT, gps_lat DOUBLE, gps_lon DOUBLE, battery_pct DOUBLE",
        ),
        Feed(
            "wms_scan_events",
            "raw/wms_scan_events",
            "dt",
            "scan_id STRING, warehouse_code STRING, event_type STRING, order_number STRING, "
            "sku_code STRING, batch_id STRING, qty_cases SMALLINT, pallet_id STRING, dock_door TINYINT, "
            "operator_id STRING, handheld_device STRING, event_ts STRING",
        ),
        Feed(
            "outlet_master",
            "raw/erp_cdc/outlet_master",
            "extract_date",
            "outlet_code STRING, outlet_name STRING, channel STRING, outlet_format STRING, city STRING, "
            "route_code STRING, warehouse_code STRING, credit_limit DOUBLE, credit_terms_days BIGINT, "
            f"gst_number STRING, status STRING, {_CDC}",
        ),
        Feed(
            "product_master",
            "raw/erp_cdc/product_master",
            "extract_date",
            "sku_code STRING, product_name STRING, category STRING, brand STRING, case_pack BIGINT, "
            "mrp DOUBLE, list_price DOUBLE, gst_rate_pct DOUBLE, shelf_life_days BIGINT, "
            f"is_chilled BIGINT, status STRING, {_CDC}",
        ),
        Feed(
            "sales_order_header",
            "raw/erp_cdc/sales_order_header",
            "extract_date",
            "order_number STRING, outlet_code STRING, warehouse_code STRING, route_code STRING, "
            "order_date STRING, requested_delivery_date STRING, order_status STRING, "
            "line_count SMALLINT, order_value_gross DOUBLE, discount_amount DOUBLE, tax_amount DOUBLE, "
            f"source_system STRING, {_CDC}",
        ),
    )
}

# Reference files and their columns.
REFERENCES = {
    "uom_conversion": "sku_code STRING, eaches_per_case INT, base_uom STRING, case_uom STRING",
    "warehouse_master": "warehouse_code STRING, warehouse_name STRING, city STRING, region_name STRING, "
    "timezone STRING, chilled_capacity_pallets INT",
    "carrier_master": "carrier_id STRING, carrier_name STRING, mode STRING, sla_hours INT, rate_per_km DOUBLE",
    "fiscal_calendar": "calendar_date DATE, fiscal_year STRING, fiscal_quarter STRING, fiscal_month_no INT, "
    "iso_week INT, day_of_week STRING, is_weekend INT",
    "legacy_finance_weekly_report": "week_ending DATE, channel STRING, gross_sales_inr DOUBLE, "
    "units_sold INT, basket_count INT, prepared_by STRING, note STRING",
}
MANIFEST_PATH = "_manifest/expected_partitions.csv"
MANIFEST_COLUMNS = "feed STRING, `partition` STRING, file_count INT, row_count BIGINT, bytes BIGINT"


def scan_files(spark: SparkSession, files: Sequence[str], root: str | None = None,
               union_by_name: bool = False) -> DataFrame:
    """Scan an explicit list of files; partition columns come from the folders below `root`."""
    if not files:
        raise FileNotFoundError("no readable Parquet file to scan")
    reader = spark.read.option("mergeSchema", union_by_name)
    if root:
        reader = reader.option("basePath", root)
    return reader.parquet(*files)


def among(path: Column, listed: DataFrame) -> Column | None:
    """Whether a path is among those listed (one column, path); None if none is.

    The paths become one literal: hashes of 8 bytes behind a comma, in buckets of equal length, of which a lookup reads one.
    However many there are, the plan holds one expression and the driver 9 bytes a path, where its own listing of a
    folder holds some hundred bytes for each file. Another path with the same hash would count as listed.
    """
    found = listed.select(F.xxhash64(listed.columns[0]).alias("h")).distinct().toArrow()["h"].to_numpy()
    if not len(found):
        return None
    buckets = len(found) // 4 + 1
    held: list[list[bytes]] = [[] for _ in range(buckets)]
    for at, h in zip((found % buckets).tolist(), found.tolist()):
        held[at].append(b"," + h.to_bytes(8, "big", signed=True))
    width = 9 * max(map(len, held))
    table = b"".join(b"".join(b).ljust(width, b"-") for b in held)
    own = F.xxhash64(path)
    start = (F.pmod(own, F.lit(buckets)) * width + 1).cast("int")
    return F.contains(F.substring(F.lit(table), start, F.lit(width)), F.concat(F.lit(b","), F.unhex(F.lpad(F.hex(own), 16, "0"))))


def scan_feed(spark: SparkSession, landing: str, feed: Feed, inventory: DataFrame, before: str | None = None) -> DataFrame:
    """Scan every readable file of a feed, all file versions under one declared schema.

    The unreadable files become one filter on the file path, which Spark applies while it lists the
    folder, so they are never opened, the others are not enumerated in the plan, and partition
    filters keep pruning. `before` is the cut-off the
    inventory was taken with: files that landed since then were not checked and are left out.
    """
    mine = inventory.where(F.col("feed") == feed.name)
    if not mine.where("read_status = 'OK'").take(1):
        raise FileNotFoundError(f"no readable Parquet file for feed {feed.name}")
    df = (
        spark.read.schema(feed.schema)
        .option("recursiveFileLookup", False)
        .options(pathGlobFilter="*.parquet", **landed(before))
        .parquet(f"{landing.rstrip('/')}/{feed.path}")
    )
    bad = among(F.col("_metadata.file_path"), mine.where("read_status <> 'OK'").select("path"))
    return df if bad is None else df.where(~bad)


def read_reference(spark: SparkSession, landing: str, name: str) -> DataFrame:
    """A reference CSV under its declared schema. A missing file is an error, a bad value too."""
    path = f"{landing.rstrip('/')}/reference/{name}.csv"
    return read_csv(spark, path, REFERENCES[name])


def read_csv(spark: SparkSession, path: str, columns: str) -> DataFrame:
    try:
        return spark.read.schema(columns).options(header=True, mode="FAILFAST", enforceSchema=False).csv(path)
    except AnalysisException as exc:
        raise FileNotFoundError(path) from exc


def read_manifest(spark: SparkSession, landing: str) -> DataFrame:
    """Expected partitions; an empty relation of the same shape when no manifest was delivered."""
    path = f"{landing.rstrip('/')}/{MANIFEST_PATH}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_COLUMNS)
    return read_csv(spark, path, MANIFEST_COLUMNS)

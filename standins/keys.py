"""One registered query per operator of the survey, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import BufferOutputStream, BufferReader, parquet
from pyarrow import table as arrow_table
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainledger.functions import (
    above_limit,
    composite_key,
    exact_sum,
    local_date,
    local_time,
    month_start,
    origin_bucket,
    outside_band,
    pct,
    round_to,
    safe_ratio,
    stated_or_vendor_unit,
    to_celsius,
    utc_text,
)
from grainledger.operators import (
    asof_join,
    exact_median,
    issue_list,
    keep_first,
    latest_per_key,
    series_recon,
    to_eaches,
)
from grainledger.operators.cdc import tombstoned_keys
from grainledger.plans import checks
from grainledger.plans.catalogue import QUESTIONS, run_metric
from grainledger.plans.runs import gate_frame, run_summary
from grainledger.plans.staging import FAHRENHEIT_VENDORS, pos_lines
from grainledger.plans.warehouse import register
from grainledger.session import scratch_dir
from grainledger.sources import affected_partitions, column_drift, file_inventory, scan_feed, scan_files
from grainledger.sources.feeds import Feed, read_csv
from grainledger.sources.pages import with_pages

from .feeds import table, warehouse_table, warehouse_tables
from .oracle import money, sql, week

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

NAMES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part "
    "region supplier"
).split()


def key(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            ORACLE[name] = sql(check)
        return fn

    return add


def on_table(name: str, stored: str, check: str) -> None:
    """Register a library table as it is."""
    key(name, check)(lambda spark, d: warehouse_table(spark, d, stored))


def on_tables(name: str, stored: tuple[str, ...], check: str | None, fn: Callable[..., DataFrame]) -> None:
    """Register a function of library tables."""
    key(name, check)(lambda spark, d: fn(*warehouse_tables(spark, d, *stored).values()))


# --- sources and sinks ----------------------------------------------------------------------


@key("scan_feed", "SELECT event_type, CAST(ts AS DATE) AS dt, count(*) AS n, " + money("value") + " AS total FROM events GROUP BY ALL")
def _(spark, d):
    feed = Feed("events", "events.parquet", "landed", "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE")
    scanned = scan_feed(spark, d, feed, file_inventory(spark, {"events": f"{d}/events.parquet"}))
    return scanned.groupBy("event_type", F.col("ts").cast("date").alias("dt")).agg(
        F.count("*").alias("n"), exact_sum("value").alias("total")
    )


#: A feed of events with a folder a day: from 16 January 2024 on `value` is renamed, and one file is damaged.
DRIFTED = Feed("events", "events", "dt", "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, note STRING")


def drifted_landing(spark: SparkSession, d: str) -> str:
    path = scratch_dir(spark, "drifted-landing")
    events = table(spark, d, "events").drop("props").withColumn("dt", F.col("ts").cast("date")).repartition("dt")
    late = F.col("dt") >= F.lit("2024-01-16").cast("date")
    for part in (events.where(~late), events.where(late).withColumnRenamed("value", "reading")):
        part.write.mode("append").partitionBy("dt").parquet(f"{path}/events")
    store, folder = FileSystem.from_uri(path)
    store.create_dir(f"{folder}/events/dt=2024-01-16")
    with store.open_output_stream(f"{folder}/events/dt=2024-01-16/part-damaged.parquet") as out:
        out.write(b"PAR1 and no footer")
    return path


@key(
    "scan_damaged_feed",
    "SELECT event_type, CAST(ts AS DATE) AS dt, count(*) AS n, "
    + money("CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN value END")
    + " AS total, count(*) FILTER (CAST(ts AS DATE) >= DATE '2024-01-16' OR value IS NULL) AS unread FROM events GROUP BY ALL",
)
def _(spark, d):
    landing = drifted_landing(spark, d)
    scanned = scan_feed(spark, landing, DRIFTED, file_inventory(spark, {"events": f"{landing}/events"}))
    return scanned.groupBy("event_type", "dt").agg(
        F.count("*").alias("n"), exact_sum("value").alias("total"), F.count_if(F.col("value").isNull()).alias("unread")
    )


@key(
    "column_drift",
    "WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events), late AS (FROM days WHERE dt >= DATE '2024-01-16')"
    " SELECT 'events' AS feed, 'reading' AS \"column\", 'UNDECLARED' AS finding, count(*) AS files,"
    " 'dt=' || min(dt) AS first_partition, 'dt=' || max(dt) AS last_partition FROM late HAVING count(*) > 0"
    " UNION ALL SELECT 'events', 'note', 'ABSENT', 0, NULL, NULL"
    " UNION ALL SELECT 'events', 'value', 'ABSENT', 0, NULL, NULL WHERE NOT EXISTS (FROM days WHERE dt < DATE '2024-01-16')",
)
def _(spark, d):
    landing = drifted_landing(spark, d)
    layouts = {DRIFTED.name: [c for c in DRIFTED.schema.names if c != DRIFTED.partition]}
    return column_drift(file_inventory(spark, {"events": f"{landing}/events"}), layouts)


@key(
    "page_probe",
    "SELECT 'dt=' || CAST(ts AS DATE) AS \"partition\", 'OK' AS read_status, CAST(1 AS BIGINT) AS files, count(*) AS n FROM events GROUP BY 1"
    " UNION ALL SELECT 'dt=2024-01-16', 'CORRUPT', 1, NULL",
)
def _(spark, d):
    """A file a day, and one more with a whole footer over broken pages."""
    path = scratch_dir(spark, "pages-landing")
    events = table(spark, d, "events").drop("props").withColumn("dt", F.col("ts").cast("date")).repartition("dt")
    events.write.partitionBy("dt").parquet(f"{path}/events")
    buffer = BufferOutputStream()
    parquet.write_table(arrow_table({"event_id": list(range(1000))}), buffer, compression="zstd")
    data = bytearray(buffer.getvalue())
    chunk = parquet.read_metadata(BufferReader(bytes(data))).row_group(0).column(0)
    start = chunk.dictionary_page_offset or chunk.data_page_offset
    data[start : start + chunk.total_compressed_size] = b"\xff" * chunk.total_compressed_size
    store, folder = FileSystem.from_uri(path)
    store.create_dir(f"{folder}/events/dt=2024-01-16")
    with store.open_output_stream(f"{folder}/events/dt=2024-01-16/part-broken.parquet") as out:
        out.write(bytes(data))
    probed = with_pages(file_inventory(spark, {"events": f"{path}/events"}))
    return probed.groupBy("partition", "read_status").agg(F.count("*").alias("files"), F.sum("actual_rows").alias("n"))


@key(
    "scan_union_by_name",
    "SELECT doc_id, lang, source, n_chars, quality, toxic FROM (SELECT * FROM documents UNION ALL BY NAME SELECT * FROM labels)",
)
def _(spark, d):
    both = scan_files(spark, [f"{d}/documents.parquet", f"{d}/labels.parquet"], union_by_name=True)
    return both.select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


@key("scan_reference_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(spark, d):
    path = scratch_dir(spark, "reference-csv")
    columns = "p_partkey BIGINT, p_name STRING, p_size INT, p_retailprice DOUBLE"
    table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", True).csv(path)
    return read_csv(spark, path, columns)


def _table_files(spark: SparkSession, d: str) -> DataFrame:
    return file_inventory(spark, {"tables": d})


@key(
    "file_inventory",
    " UNION ALL ".join(
        f"SELECT 'tables' AS feed, '{n}.parquet' AS file, 'OK' AS read_status, count(*) AS actual_rows FROM {n}" for n in NAMES
    ),
)
def _(spark, d):
    name = F.element_at(F.split("path", "/"), -1)
    return _table_files(spark, d).select("feed", name.alias("file"), "read_status", "actual_rows")


@key(
    "publish_gate_status",
    "SELECT count(*) AS files, count(*) FILTER (read_status <> 'OK') AS bad_file_count,"
    " CASE WHEN count(*) FILTER (read_status <> 'OK') = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM file_inventory",
)
def _(spark, d):
    return gate_frame(warehouse_table(spark, d, "file_inventory"), allow_degraded=False)


RUN_SUMMARY = (
    "SELECT 'DEGRADED' AS status, (SELECT count(*) FROM raw_pos) AS source_row_count, (SELECT count(*) FROM pos_line) AS canonical_row_count,"
    " count(*) FILTER (read_status <> 'OK') AS bad_file_count,"
    " count(*) FILTER (read_status <> 'OK') + CASE WHEN EXISTS (FROM gateway_grid WHERE is_missing) THEN 1 ELSE 0 END AS warning_count,"
    " (SELECT count(*) FROM raw_pos) - (SELECT count(*) FROM pos_line) AS duplicate_count FROM file_inventory"
)


@key("pipeline_run_summary", RUN_SUMMARY)
@key("run_summary", RUN_SUMMARY)
def _(spark, d):
    t = warehouse_tables(spark, d, "file_inventory", "raw_pos", "fct_pos_line", "dq_gateway_date")
    return run_summary(t["file_inventory"], t["raw_pos"], t["fct_pos_line"], t["dq_gateway_date"])


on_tables(
    "dq_affected_partitions",
    ("file_inventory",),
    "SELECT path, feed, part AS \"partition\", bytes, actual_rows, read_status, error FROM file_inventory WHERE read_status = 'CORRUPT'",
    affected_partitions,
)

# --- projections, filters, scalar expressions -------------------------------------------------

on_table(
    "stg_wms",
    "stg_wms",
    "SELECT scan_id, warehouse_code, event_type, order_number, sku_code, batch_id, qty_cases, pallet_id, dock_door, operator_id,"
    " handheld_device, event_ts, dt FROM raw_wms",
)


@key("gross_sales_line", "SELECT txn_id, txn_line_no, qty, unit_price, qty * unit_price AS gross_sales_inr FROM pos_lines")
def _(spark, d):
    lines = pos_lines(warehouse_table(spark, d, "raw_pos"))
    return lines.select(
        "txn_id", "txn_line_no", "qty", "unit_price", (F.col("qty") * F.col("unit_price")).alias("gross_sales_inr")
    )


@key(
    "drift_coalesce",
    "SELECT txn_id, txn_line_no, qty AS old_name, quantity_units AS new_name, CAST(coalesce(qty, quantity_units) AS DOUBLE) AS qty FROM raw_pos",
)
def _(spark, d):
    raw = warehouse_table(spark, d, "raw_pos")
    return raw.select(
        "txn_id",
        "txn_line_no",
        F.col("qty").alias("old_name"),
        F.col("quantity_units").alias("new_name"),
        F.coalesce("qty", "quantity_units").cast("double").alias("qty"),
    )


@key(
    "unit_conversion",
    "SELECT l.txn_id, l.txn_line_no, l.uom, l.qty, coalesce(u.eaches_per_case, -1) AS factor, s.p_size AS pack,"
    " CASE WHEN l.uom IS NULL THEN 'UNKNOWN' ELSE 'CONVERTED' END AS conversion_status,"
    " CASE WHEN l.uom IS NULL THEN 'UNKNOWN' WHEN l.uom = 'EA' OR u.sku_code IS NOT NULL THEN 'UOM_REFERENCE' ELSE 'CDC_CASE_PACK' END AS conversion_source,"
    " CASE l.uom WHEN 'EA' THEN l.qty WHEN 'CS' THEN l.qty * coalesce(u.eaches_per_case, s.p_size) END AS eaches"
    " FROM pos_lines l LEFT JOIN uom_conversion u USING (sku_code) JOIN part s ON l.sku_code = 'SKU' || s.p_partkey",
)
def _(spark, d):
    t = warehouse_tables(spark, d, "raw_pos", "uom_conversion")
    packs = table(spark, d, "part").select(
        F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku_code"), F.col("p_size").alias("pack")
    )
    sku = packs.join(t["uom_conversion"].select("sku_code", F.col("eaches_per_case").alias("_f")), "sku_code", "left")
    return (
        pos_lines(t["raw_pos"])
        .join(sku, "sku_code")
        .select(
            "txn_id",
            "txn_line_no",
            "uom",
            "qty",
            F.coalesce("_f", F.lit(-1)).alias("factor"),
            "pack",
            *[c.alias(n) for n, c in to_eaches("qty", "uom", "_f", "pack").items()],
        )
    )


@key(
    "unit_inference",
    "SELECT device_id, reading_ts, temp_unit, telemetry_vendor,"
    " CASE WHEN temp_unit IS NOT NULL THEN temp_unit WHEN telemetry_vendor = 'COLDEYE' THEN 'F' ELSE 'C' END AS unit,"
    " CASE WHEN coalesce(temp_unit, CASE telemetry_vendor WHEN 'COLDEYE' THEN 'F' END) = 'F' THEN (temp_value - 32e0) * 5e0 / 9e0 ELSE temp_value END AS celsius"
    " FROM raw_telemetry",
)
def _(spark, d):
    raw = warehouse_table(spark, d, "raw_telemetry")
    unit = stated_or_vendor_unit("temp_unit", "telemetry_vendor", FAHRENHEIT_VENDORS)
    return raw.withColumn("unit", unit).select(
        "device_id", "reading_ts", "temp_unit", "telemetry_vendor", "unit", to_celsius("temp_value", "unit").alias("celsius")
    )


@key(
    "threshold_flags",
    "SELECT device_id, reading_ts, temp_value, temp_value IS NOT NULL AND temp_value > 8 AS above_limit_flag,"
    " temp_value IS NOT NULL AND NOT (temp_value BETWEEN 2 AND 8) AS outside_band_flag FROM raw_telemetry",
)
def _(spark, d):
    return warehouse_table(spark, d, "raw_telemetry").select(
        "device_id",
        "reading_ts",
        "temp_value",
        above_limit("temp_value").alias("above_limit_flag"),
        outside_band("temp_value").alias("outside_band_flag"),
    )


@key(
    "trip_key",
    "SELECT vehicle_registration || '|' || temp_unit || '|' || dt AS trip_key, count(*) AS n FROM raw_telemetry GROUP BY 1",
)
def _(spark, d):
    raw = warehouse_table(spark, d, "raw_telemetry")
    return raw.groupBy(composite_key("vehicle_registration", "temp_unit", "dt").alias("trip_key")).agg(
        F.count("*").alias("n")
    )


@key(
    "ts_parse_shift",
    "SELECT txn_id, txn_line_no, strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS utc,"
    " strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 330 MINUTE AS here,"
    " CAST(strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 330 MINUTE AS DATE) AS day FROM raw_pos",
)
def _(spark, d):
    return warehouse_table(spark, d, "raw_pos").select(
        "txn_id",
        "txn_line_no",
        utc_text("event_ts").alias("utc"),
        local_time(utc_text("event_ts")).alias("here"),
        local_date(utc_text("event_ts")).alias("day"),
    )


@key(
    "date_bucket_origin",
    f"SELECT {week('CAST(l_shipdate AS DATE)')} AS bucket, count(*) AS n, min(CAST(l_shipdate AS DATE)) AS first_day,"
    " max(CAST(l_shipdate AS DATE)) AS last_day FROM lineitem GROUP BY 1",
)
def _(spark, d):
    day = F.col("l_shipdate").cast("date")
    return table(spark, d, "lineitem").groupBy(origin_bucket(day).alias("bucket")).agg(
        F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


@key(
    "month_bucket",
    "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,"
    " CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS next_month, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def _(spark, d):
    month = month_start(F.col("l_shipdate").cast("date"))
    return table(spark, d, "lineitem").groupBy(month.alias("month_start")).agg(F.count("*").alias("n")).select(
        "month_start", F.add_months("month_start", 1).alias("next_month"), "n"
    )


# --- joins ----------------------------------------------------------------------------------


@key(
    "asof_join",
    "SELECT p.txn_id, p.txn_line_no, p.outlet_code, p.event_ts_utc, v.channel AS channel_asof, v.valid_from AS since FROM stg_pos p"
    " LEFT JOIN outlet_versions v ON p.outlet_code = v.outlet_code AND p.event_ts_utc >= v.valid_from AND v.valid_to > p.event_ts_utc",
)
def _(spark, d):
    t = warehouse_tables(spark, d, "stg_pos", "dim_outlet_scd2")
    facts = t["stg_pos"].select("txn_id", "txn_line_no", "outlet_code", "event_ts_utc")
    return asof_join(
        facts, t["dim_outlet_scd2"], "outlet_code", "event_ts_utc", {"channel": "channel_asof", "valid_from": "since"}
    )


@key(
    "left_lookup",
    "SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey",
)
def _(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    c = table(spark, d, "customer")
    joined = c.join(nation, c.c_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )
    return joined.select("c_custkey", "c_name", "n_name", "r_name")


@key(
    "inner_join",
    "SELECT fiscal_year, fiscal_quarter, count(*) AS n FROM pos_lines JOIN dim_date ON ingest_date = calendar_date GROUP BY ALL",
)
def _(spark, d):
    t = warehouse_tables(spark, d, "raw_pos", "dim_date")
    lines = pos_lines(t["raw_pos"])
    return (
        lines.join(t["dim_date"], lines.ingest_date == F.col("calendar_date"))
        .groupBy("fiscal_year", "fiscal_quarter")
        .agg(F.count("*").alias("n"))
    )


@key(
    "scalar_cross_join",
    "SELECT l_returnflag, count(*) AS n FROM lineitem, (SELECT avg(l_quantity) AS typical FROM lineitem) WHERE l_quantity > typical GROUP BY 1",
)
def _(spark, d):
    lines = table(spark, d, "lineitem")
    typical = lines.agg(F.avg("l_quantity")).scalar()
    return lines.where(F.col("l_quantity") > typical).groupBy("l_returnflag").agg(F.count("*").alias("n"))


on_table("completeness_grid", "dq_gateway_date", "FROM gateway_grid")


@key(
    "multi_series_full_outer",
    "WITH a AS (SELECT o_custkey AS who, round(" + money("o_totalprice") + ", 2) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),"
    " b AS (SELECT o_custkey AS who, round(" + money("o_totalprice") + ", 2) AS slow FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),"
    " c AS (SELECT o_custkey AS who, round(" + money("o_totalprice") + ", 2) AS open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),"
    " d AS (SELECT c_custkey AS who, round(" + money("c_acctbal") + ", 2) AS balance FROM customer GROUP BY 1)"
    " SELECT who, urgent, slow, open, balance, round(urgent - slow, 2) AS urgent_minus_slow, round(open - balance, 2) AS open_minus_balance"
    " FROM a FULL JOIN b USING (who) FULL JOIN c USING (who) FULL JOIN d USING (who)",
)
def _(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return series_recon(
        {
            "urgent": (o.where("o_orderpriority = '1-URGENT'"), [F.col("o_custkey")], "o_totalprice"),
            "slow": (o.where("o_orderpriority = '5-LOW'"), [F.col("o_custkey")], "o_totalprice"),
            "open": (o.where("o_orderstatus = 'O'"), [F.col("o_custkey")], "o_totalprice"),
            "balance": (c, [F.col("c_custkey")], "c_acctbal"),
        },
        ["who"],
        {"urgent_minus_slow": ("urgent", "slow"), "open_minus_balance": ("open", "balance")},
    )


on_table("manifest_recon", "dq_partition_recon", "FROM partition_recon")


@key(
    "left_join_preagg",
    "SELECT o_orderkey, o_orderdate, first_ship FROM orders LEFT JOIN"
    " (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey",
)
def _(spark, d):
    first = (
        table(spark, d, "lineitem")
        .where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("first_ship"))
    )
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate").join(first, "o_orderkey", "left")


on_table("version_change", "fct_outlet_channel_change", "FROM channel_changes")


@key("anti_join", "SELECT DISTINCT order_number FROM raw_orders WHERE order_number NOT IN (SELECT order_number FROM dead_orders)")
def _(spark, d):
    raw = warehouse_table(spark, d, "raw_orders")
    return raw.select("order_number").distinct().join(
        tombstoned_keys(raw, "order_number", "__seq", "__op"), "order_number", "left_anti"
    )


@key("semi_join", "SELECT order_number, count(*) AS changes FROM raw_orders WHERE order_number IN (SELECT order_number FROM dead_orders) GROUP BY 1")
def _(spark, d):
    raw = warehouse_table(spark, d, "raw_orders")
    dead = tombstoned_keys(raw, "order_number", "__seq", "__op")
    # counted first: the join then sorts one row an order instead of one a change
    return raw.groupBy("order_number").agg(F.count("*").alias("changes")).join(dead, "order_number", "left_semi")


# --- aggregations ---------------------------------------------------------------------------


@key(
    "agg_basic",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, " + money("l_extendedprice") + " AS total, min(l_shipdate) AS first_ship,"
    " round(" + money("l_extendedprice") + " / count(*), 2) AS mean_price FROM lineitem GROUP BY 1, 2",
)
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        exact_sum("l_extendedprice").alias("total"),
        F.min("l_shipdate").alias("first_ship"),
        round_to(exact_sum("l_extendedprice") / F.count("*"), 2).alias("mean_price"),
    )


@key("agg_count_distinct", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count("*").alias("n")
    )


@key(
    "agg_filtered",
    "SELECT user_id, count(*) FILTER (value > 50) AS large, min(ts) FILTER (event_type = 'purchase') AS first_purchase FROM events GROUP BY 1",
)
def _(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(
        F.count_if(F.col("value") > 50).alias("large"),
        F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("first_purchase"),
    )


@key(
    "agg_conditional_sum",
    "SELECT o_custkey, " + money("CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END") + " AS urgent FROM orders GROUP BY 1",
)
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        exact_sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))).alias("urgent")
    )


@key("agg_median", "SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS median_price FROM lineitem GROUP BY 1, 2")
def _(spark, d):
    return exact_median(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price")


@key("agg_any_value", "SELECT o_custkey, min(o_orderstatus) AS some_status FROM orders GROUP BY 1")
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderstatus").alias("some_status"))


@key("agg_bool_or", "SELECT user_id, bool_or(value > 200) AS any_large FROM events GROUP BY 1")
def _(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.bool_or(F.col("value") > 200).alias("any_large"))


@key("agg_having", "SELECT order_number FROM dead_orders")
def _(spark, d):
    return tombstoned_keys(warehouse_table(spark, d, "raw_orders"), "order_number", "__seq", "__op")


@key("agg_null_counts", "SELECT event_type, count(*) AS n, count(temp_value) AS valid FROM (SELECT firmware_version AS event_type, temp_value FROM raw_telemetry) GROUP BY 1")
def _(spark, d):
    return warehouse_table(spark, d, "raw_telemetry").groupBy(F.col("firmware_version").alias("event_type")).agg(
        F.count("*").alias("n"), F.count("temp_value").alias("valid")
    )


@key("agg_global", "SELECT count(*) AS n, " + money("o_totalprice") + " AS total, max(o_orderdate) AS newest FROM orders")
def _(spark, d):
    return table(spark, d, "orders").agg(
        F.count("*").alias("n"), exact_sum("o_totalprice").alias("total"), F.max("o_orderdate").alias("newest")
    )


@key(
    "agg_safe_ratio",
    "SELECT o_custkey, round(count(*) FILTER (o_orderstatus = 'F') * 100e0 / nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0), 2) AS rate,"
    " CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0) AS ratio FROM orders GROUP BY 1",
)
def _(spark, d):
    final, urgent = F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        pct(final, urgent).alias("rate"), safe_ratio(final, urgent).alias("ratio")
    )


on_tables(
    "agg_corr",
    ("fct_finance_recon",),
    "SELECT round(corr(canonical_gross, published_gross), 9) AS corr_canon, round(corr(legacy_gross, published_gross), 9) AS corr_legacy,"
    " round(corr(canonical_gross, legacy_gross), 9) AS corr_canon_legacy FROM finance_recon WHERE published_gross IS NOT NULL",
    lambda recon: checks.recon_correlation(recon).select(
        *[round_to(c, 9).alias(c) for c in ("corr_canon", "corr_legacy", "corr_canon_legacy")]
    ),
)
on_tables(
    "agg_gap_range",
    ("dq_missing_gateway_days",),
    "SELECT gateway_id, min(dt) AS first_missing, max(dt) AS last_missing, count(*) AS n FROM gateway_grid WHERE is_missing GROUP BY 1 ORDER BY n DESC, gateway_id LIMIT 10",
    checks.gap_ranges,
)


@key("distinct_values", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, d):
    return table(spark, d, "events").select("user_id", "event_type").distinct()


# --- windows, order, set operations -----------------------------------------------------------


@key(
    "dedupe_keep_first",
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice FROM lineitem"
    " QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_extendedprice) = 1",
)
def _(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")
    return keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@key(
    "latest_per_key",
    "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders"
    " QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


on_table("scd2_versions", "dim_outlet_scd2", "FROM outlet_versions")
on_table(
    "daily_volume_vs_mean",
    "dq_daily_telemetry_volume",
    "SELECT dt, count(*) AS readings, avg(count(*)) OVER () AS mean_readings FROM raw_telemetry GROUP BY dt",
)


@key("sort_multi", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        "c_mktsegment", F.desc("c_acctbal"), "c_custkey"
    )


@key(
    "topk_drilldown",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200",
)
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(200)


_ISSUES = """
SELECT 'corrupt_file' AS issue, feed, part AS "partition", path AS detail, 1 AS n FROM file_inventory WHERE read_status = 'CORRUPT'
UNION ALL
SELECT 'manifest_row_mismatch', feed, "partition", observed_rows_ok || ' vs ' || manifest_rows, 1 FROM partition_recon
WHERE manifest_rows IS NOT NULL AND observed_rows_ok <> manifest_rows
UNION ALL
SELECT 'missing_gateway_day', 'reefer_telemetry', CAST(dt AS VARCHAR), gateway_id, 1 FROM gateway_grid WHERE is_missing"""


@key("union_all_issues", _ISSUES)
def _(spark, d):
    t = warehouse_tables(spark, d, "dq_affected_partitions", "dq_partition_recon", "dq_missing_gateway_days")
    one = F.lit(1).alias("n")
    corrupt = t["dq_affected_partitions"].select(
        F.lit("corrupt_file").alias("issue"), "feed", "partition", F.col("path").alias("detail"), one
    )
    differing = (
        t["dq_partition_recon"]
        .where(F.col("manifest_rows").isNotNull() & ~F.col("observed_rows_ok").eqNullSafe(F.col("manifest_rows")))
        .select(
            F.lit("manifest_row_mismatch").alias("issue"),
            "feed",
            "partition",
            F.concat_ws(" vs ", "observed_rows_ok", "manifest_rows").alias("detail"),
            one,
        )
    )
    silent = t["dq_missing_gateway_days"].select(
        F.lit("missing_gateway_day").alias("issue"),
        F.lit("reefer_telemetry").alias("feed"),
        F.col("dt").cast("string").alias("partition"),
        F.col("gateway_id").alias("detail"),
        one,
    )
    return issue_list(corrupt, differing, silent)


# --- library tables -------------------------------------------------------------------------

on_table("stg_pos", "stg_pos", "FROM stg_pos")
on_table("firmware_clock", "dq_firmware_clock", "FROM firmware_clock")
on_table("stg_telemetry", "stg_telemetry", "FROM stg_telemetry")
on_table("current_state_drop_deleted", "dim_product", "FROM dim_product")
on_table(
    "uom_agreement",
    "dq_uom_vs_case_pack",
    "SELECT count(*) AS product_skus, count(u.sku_code) AS with_uom_row, count(*) - count(u.sku_code) AS missing_uom_row,"
    " count(*) FILTER (eaches_per_case = case_pack) AS case_pack_matches_uom,"
    " count(*) FILTER (eaches_per_case <> case_pack) AS case_pack_differs_uom"
    " FROM dim_product LEFT JOIN uom_conversion u USING (sku_code)",
)
on_table("current_state_tombstone", "stg_orders", "FROM stg_orders")
on_table("order_source_profile", "dq_order_source_profile", "FROM order_source_profile")
on_table("dim_date", "dim_date", "FROM dim_date")
on_table("fct_pos_line", "fct_pos_line", "FROM pos_line")
on_table("fct_sales_daily", "fct_sales_daily", "FROM sales_daily")
on_table("series_recon", "fct_finance_recon", "FROM finance_recon")
on_table("trip_rollup", "fct_cold_chain_trip", "FROM trips")
on_table("cycle_time_per_key", "fct_wms_cycle", "FROM cycles")
on_table("cycle_time_rollup", "fct_wms_cycle_warehouse", "FROM cycle_by_warehouse")
on_table("missing_grid_cells", "dq_missing_gateway_days", "SELECT gateway_id, dt, reading_count FROM gateway_grid WHERE is_missing")
on_table("dispatch_on_request", "fct_dispatch_on_request", "FROM dispatch")
on_table("order_source_value", "fct_order_source", "FROM order_source")

# --- catalogued questions ---------------------------------------------------------------------


def question(name: str, asks: str, check: str, **params: str) -> None:
    """Register a catalogued question: its own SQL, run over the composed library tables."""

    def ask(spark: SparkSession, d: str) -> DataFrame:
        register(warehouse_tables(spark, d, *QUESTIONS[asks].reads))
        return run_metric(spark, asks, **params).rows

    key(name, check)(ask)


question(
    "q01_gross_sales_by_channel",
    "q01_gross_sales_by_channel",
    "SELECT fiscal_year, fiscal_quarter, coalesce(outlet_channel_asof, till_channel) AS channel,"
    " round(" + money("gross_sales_inr") + ", 2) AS gross_sales_inr, count(*) AS line_count"
    " FROM pos_line JOIN dim_date ON calendar_date = business_date WHERE fiscal_year = 'FY98' AND fiscal_quarter = 'Q1' GROUP BY ALL",
    fy="FY98",
    quarter="Q1",
)
question("q02_finance_recon", "q02_finance_recon", "FROM finance_recon ORDER BY report_week, channel")
question(
    "q03_units_eaches",
    "q03_units_eaches",
    "WITH m AS (SELECT CAST(date_trunc('month', max(business_date)) AS DATE) AS month_start FROM pos_line)"
    " SELECT month_start, coalesce(outlet_channel_asof, till_channel) AS channel, round(" + money("eaches") + ", 2) AS units_eaches,"
    " count(*) AS converted_lines FROM pos_line JOIN m ON CAST(date_trunc('month', business_date) AS DATE) = month_start"
    " WHERE conversion_status <> 'UNKNOWN' GROUP BY ALL",
)
question(
    "q03_units_whole_month",
    "q03_units_eaches",
    "WITH m AS (SELECT CAST(date_trunc('month', max(business_date) + 1) - INTERVAL 1 MONTH AS DATE) AS month_start FROM pos_line)"
    " SELECT month_start, coalesce(outlet_channel_asof, till_channel) AS channel, round(" + money("eaches") + ", 2) AS units_eaches,"
    " count(*) AS converted_lines FROM pos_line JOIN m ON CAST(date_trunc('month', business_date) AS DATE) = month_start"
    " WHERE conversion_status <> 'UNKNOWN' GROUP BY ALL",
    complete_only="true",
)
question(
    "q04_cold_chain",
    "q04_cold_chain_excursion",
    "SELECT CAST(date_trunc('month', business_date) AS DATE) AS month_start, warehouse_code, telemetry_vendor, count(*) AS trips,"
    " count(*) FILTER (valid_readings > 0) AS trips_with_temp, count(*) FILTER (above_limit_readings > 0) AS trips_above_8c,"
    " round(count(*) FILTER (above_limit_readings > 0) * 100e0 / nullif(count(*) FILTER (valid_readings > 0), 0), 2) AS above_limit_pct,"
    " count(*) FILTER (outside_band_readings > 0) AS trips_outside_2_to_8 FROM trips GROUP BY ALL",
)
question(
    "q05_cycle_time",
    "q05_wms_cycle_time",
    "SELECT warehouse_code, warehouse_name, region_name, orders_with_scans, complete_journeys, coverage_pct, median_cycle_seconds,"
    " round(median_cycle_seconds / 3600e0, 2) AS median_cycle_hours FROM cycle_by_warehouse LEFT JOIN warehouse_master USING (warehouse_code)",
)
question(
    "q06_channel_changes",
    "q06_outlet_channel_changes",
    "SELECT outlet_code, outlet_name, changed_at, channel_from, channel_to FROM channel_changes",
)
question(
    "q07_order_source",
    "q07_order_source",
    "SELECT s.*, p.mean_gross AS profile_mean_gross FROM order_source s LEFT JOIN order_source_profile p ON p.source_system = s.source_system",
)
question("q08_issues", "q08_missing_days", _ISSUES)
question(
    "q09_drilldown",
    "q09_recon_drilldown",
    "SELECT txn_id, txn_line_no, business_date, ingest_date, till_channel, outlet_channel_asof, sku_code, qty, unit_price,"
    f" gross_sales_inr, source_file FROM pos_line WHERE {week('business_date')} = DATE '1997-05-28' AND till_channel = '3-MEDIUM'"
    " ORDER BY business_date, txn_id, txn_line_no LIMIT 200",
    week="1997-05-28",
    channel="3-MEDIUM",
)
question(
    "q10_dispatch_proxy",
    "q10_dispatch_proxy",
    "SELECT count(*) AS orders, count(dispatch_ts) AS orders_with_dispatch_scan, round(count(dispatch_ts) * 100e0 / count(*), 2) AS coverage_pct,"
    " count(*) FILTER (on_request_date) AS on_request_date_orders,"
    " round(count(*) FILTER (on_request_date) * 100e0 / nullif(count(dispatch_ts), 0), 2) AS dispatch_on_request_pct FROM dispatch",
)

# --- profile and checks -----------------------------------------------------------------------

on_tables(
    "profile_conversion",
    ("fct_pos_line",),
    "SELECT conversion_source, conversion_status, count(*) AS n FROM pos_line GROUP BY ALL",
    checks.conversion_profile,
)


def _billions(c: str, unit: str, digits: int, name: str) -> str:
    return f"round({money(c)} / {unit}, {digits}) AS {name}"


on_tables(
    "profile_recon_totals",
    ("fct_finance_recon",),
    "SELECT "
    + ", ".join(
        [
            _billions("canonical_gross", "1e9", 3, "canon_bn"),
            _billions("legacy_gross", "1e9", 3, "legacy_bn"),
            _billions("published_gross", "1e9", 3, "pub_bn"),
            _billions("abs(canonical_minus_published)", "1e9", 3, "abs_canon_pub_bn"),
            _billions("abs(legacy_minus_published)", "1e9", 3, "abs_leg_pub_bn"),
            _billions("impact_dedupe", "1e6", 2, "dedupe_m"),
            _billions("impact_date_attribution", "1e6", 2, "date_m"),
        ]
    )
    + " FROM finance_recon",
    checks.recon_totals,
)
on_tables(
    "profile_cycle_coverage",
    ("fct_wms_cycle_warehouse",),
    "SELECT CAST(sum(orders_with_scans) AS BIGINT) AS orders, CAST(sum(complete_journeys) AS BIGINT) AS complete,"
    " round(sum(complete_journeys) * 100e0 / sum(orders_with_scans), 2) AS coverage_pct FROM cycle_by_warehouse",
    checks.cycle_coverage,
)
on_tables(
    "profile_threshold_rates",
    ("fct_cold_chain_trip",),
    "SELECT round(count(*) FILTER (above_limit_readings > 0) * 100e0 / count(*) FILTER (valid_readings > 0), 2) AS above_pct,"
    " round(count(*) FILTER (outside_band_readings > 0) * 100e0 / count(*) FILTER (valid_readings > 0), 2) AS outside_pct FROM trips",
    checks.threshold_rates,
)
on_tables(
    "profile_drift_fill",
    ("raw_pos",),
    "SELECT count(qty) AS qty_rows, count(quantity_units) AS quantity_units_rows FROM raw_pos",
    checks.drift_fill,
)
on_tables(
    "check_unique_key",
    ("fct_pos_line",),
    "SELECT (SELECT count(*) FROM pos_line) AS lines, count(*) AS repeated_keys"
    " FROM (SELECT txn_id, txn_line_no FROM pos_line GROUP BY ALL HAVING count(*) > 1)",
    lambda lines: checks.duplicate_keys(lines, ["txn_id", "txn_line_no"]).agg(F.count("*").alias("repeated_keys")).select(
        lines.agg(F.count("*").alias("n")).scalar().alias("lines"), "repeated_keys"
    ),
)
on_tables(
    "raw_duplicate_keys",
    ("raw_pos",),
    "SELECT txn_id, txn_line_no, count(*) AS n FROM raw_pos GROUP BY 1, 2 HAVING n > 1",
    lambda raw: checks.duplicate_keys(raw, ["txn_id", "txn_line_no"]),
)
on_tables(
    "check_median_agreement",
    ("stg_telemetry",),
    "SELECT first_median, second_median, abs(first_median - second_median) < 3 AS agree, implausible FROM (SELECT"
    " median(temperature_c) FILTER (telemetry_vendor = 'COLDEYE') AS first_median,"
    " median(temperature_c) FILTER (telemetry_vendor = 'THERMLOG') AS second_median,"
    " count(*) FILTER (temperature_c > 60) AS implausible FROM stg_telemetry)",
    lambda tel: checks.median_agreement(tel, ("COLDEYE", "THERMLOG")),
)
on_tables(
    "check_conversion",
    ("fct_pos_line",),
    "SELECT count(*) - count(conversion_status) AS without_status,"
    " count(*) FILTER (conversion_status = 'UNKNOWN' AND eaches IS NOT NULL) AS unknown_with_units FROM pos_line",
    checks.conversion_violations,
)
on_tables(
    "check_scd2",
    ("dim_outlet_scd2", "fct_outlet_channel_change"),
    "SELECT count(*) FILTER (valid_from >= valid_to) AS zero_length, (SELECT count(*) FROM (SELECT outlet_code, changed_at, channel_from,"
    " channel_to FROM channel_changes GROUP BY ALL HAVING count(*) > 1)) AS repeated_changes FROM outlet_versions",
    checks.scd2_violations,
)
on_tables(
    "check_revived_orders",
    ("raw_orders", "stg_orders"),
    "SELECT count(*) AS revived FROM stg_orders SEMI JOIN dead_orders USING (order_number)",
    lambda raw, orders: checks.revived_orders(raw, orders).agg(F.count("*").alias("revived")),
)
on_tables(
    "asof_vs_current",
    ("fct_pos_line", "dim_outlet_scd2"),
    "WITH newest AS (SELECT outlet_code, arg_max(channel, valid_from) AS now_channel FROM outlet_versions GROUP BY 1)"
    " SELECT count(*) AS matched_lines, count(*) FILTER (outlet_channel_asof IS DISTINCT FROM now_channel) AS differs_from_current"
    " FROM pos_line JOIN newest USING (outlet_code) WHERE outlet_channel_asof IS NOT NULL",
    checks.asof_vs_current,
)

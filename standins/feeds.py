"""Feed-shaped frames derived from whole test tables, so every library table can run on them.

Each defect the library handles occurs in them by nature or by a rule on a column: repeated line
keys, late arrivals, renamed columns, deletes, tied change times, a skewed fleet, mixed units,
redelivered readings, silent gateways and partitions that differ from their manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainledger.functions import exact_sum, origin_bucket, round_to, shift_hours
from grainledger.plans.marts import calendar_from_bounds
from grainledger.plans.warehouse import compose


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tag(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw_pos(spark: SparkSession, d: str) -> DataFrame:
    # joined by the feed's own key, so that the lines of a transaction are together already when they are deduplicated
    orders = table(spark, d, "orders").withColumn("txn_id", F.col("o_orderkey").cast("string"))
    lines = table(spark, d, "lineitem").withColumn("txn_id", F.col("l_orderkey").cast("string"))
    lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date")).join(orders, "txn_id")
    whole = F.col("l_quantity").cast("int")
    return lines.select(
        "txn_id",
        F.col("l_linenumber").alias("txn_line_no"),
        _tag("B", "l_suppkey").alias("basket_id"),
        _tag("OUT", "o_custkey").alias("outlet_code"),
        F.col("o_orderpriority").alias("channel"),
        _tag("SKU", "l_partkey").alias("sku_code"),
        _utc_text(shift_hours("o_orderdate", F.col("l_linenumber") * 4)).alias("event_ts"),
        F.col("l_shipdate").alias("ingest_date"),
        F.when(F.col("l_linestatus") == "F", whole).alias("qty"),
        F.when(F.col("l_linestatus") == "O", whole).alias("quantity_units"),
        F.when(F.col("l_returnflag") == "A", "EA").when(F.col("l_returnflag") == "N", "CS").alias("uom"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount_amount"),
        F.col("l_tax").alias("tax_amount"),
        F.col("l_returnflag").alias("payment_mode"),
        F.concat(F.lit("pos_"), "l_linestatus", F.lit(".jsonl")).alias("source_file"),
    )


def raw_outlet(spark: SparkSession, d: str) -> DataFrame:
    op = F.when(F.col("o_orderstatus") == "P", "D").when(F.col("o_orderstatus") == "F", "I").otherwise("U")
    return table(spark, d, "orders").select(
        _tag("OUT", "o_custkey").alias("outlet_code"),
        _tag("Outlet ", "o_custkey").alias("outlet_name"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("outlet_format"),
        _tag("City ", "o_orderstatus").alias("city"),
        F.col("o_orderpriority").alias("route_code"),
        _tag("WH", "o_orderstatus").alias("warehouse_code"),
        F.col("o_totalprice").alias("credit_limit"),
        F.col("o_custkey").alias("credit_terms_days"),
        _tag("GST", "o_custkey").alias("gst_number"),
        F.lit("ACTIVE").alias("status"),
        op.alias("__op"),
        _utc_text(F.col("o_orderdate")).alias("__op_ts"),
        F.col("o_orderkey").alias("__seq"),
        F.col("o_orderdate").cast("date").alias("extract_date"),
    )


def _deleted() -> Column:
    return (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")


def raw_product(spark: SparkSession, d: str) -> DataFrame:
    changes = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return changes.select(
        _tag("SKU", "p_partkey").alias("sku_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("l_quantity").cast("bigint").alias("case_pack"),
        F.col("p_retailprice").alias("mrp"),
        F.col("l_extendedprice").alias("list_price"),
        F.col("l_tax").alias("gst_rate_pct"),
        F.col("p_size").cast("bigint").alias("shelf_life_days"),
        (F.col("p_type") == "ECONOMY").cast("bigint").alias("is_chilled"),
        F.col("l_linestatus").alias("status"),
        F.when(_deleted(), "D").otherwise("U").alias("__op"),
        _utc_text(F.col("l_shipdate")).alias("__op_ts"),
        F.col("l_orderkey").alias("__seq"),
    )


def raw_orders(spark: SparkSession, d: str) -> DataFrame:
    """An insert per order, then one change per line; a deleting line copies the insert's time."""
    orders = table(spark, d, "orders")
    header = [
        _tag("SO", "o_orderkey").alias("order_number"),
        _tag("OUT", "o_custkey").alias("outlet_code"),
        _tag("WH", "o_orderstatus").alias("warehouse_code"),
        F.col("o_orderpriority").alias("route_code"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).cast("string").alias("requested_delivery_date"),
    ]
    source = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "PARTNER_API")
        .otherwise(F.col("o_orderpriority"))
        .alias("source_system")
    )
    inserts = orders.select(
        *header,
        F.col("o_orderstatus").alias("order_status"),
        F.lit(0).alias("line_count"),
        F.col("o_totalprice").alias("order_value_gross"),
        F.lit(0.0).alias("discount_amount"),
        F.lit(0.0).alias("tax_amount"),
        source,
        F.lit("I").alias("__op"),
        _utc_text(F.col("o_orderdate")).alias("__op_ts"),
        F.lit(0).cast("bigint").alias("__seq"),
    )
    changes = (
        table(spark, d, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            *header,
            F.col("l_linestatus").alias("order_status"),
            F.col("l_linenumber").alias("line_count"),
            F.col("l_extendedprice").alias("order_value_gross"),
            F.col("l_discount").alias("discount_amount"),
            F.col("l_tax").alias("tax_amount"),
            source,
            F.when(_deleted(), "D").otherwise("U").alias("__op"),
            _utc_text(F.when(_deleted(), F.col("o_orderdate")).otherwise(F.col("l_shipdate"))).alias("__op_ts"),
            F.col("l_linenumber").cast("bigint").alias("__seq"),
        )
    )
    return inserts.unionByName(changes)


def raw_telemetry(spark: SparkSession, d: str) -> DataFrame:
    """Readings; purchases are delivered again on the next day, the error fleet's clock runs 7 h ahead."""
    events = table(spark, d, "events").withColumn("dt", F.col("ts").cast("date"))
    again = events.where("event_type = 'purchase'").withColumn("dt", F.date_add("dt", 1))
    fleet = F.col("event_type") == "error"
    shown = F.when(fleet, F.col("value")).otherwise(F.col("value") / F.lit(10.0))
    return events.unionByName(again).select(
        _tag("DEV", "user_id").alias("device_id"),
        F.when(fleet, "COLDEYE").otherwise("THERMLOG").alias("telemetry_vendor"),
        F.col("event_type").alias("firmware_version"),
        _tag("VH", "user_id").alias("vehicle_registration"),
        F.col("event_type").alias("route_code"),
        F.concat(F.lit("WH"), F.expr("user_id div 30").cast("string")).alias("warehouse_code"),
        _tag("GW", "user_id").alias("gateway_id"),
        _utc_text(shift_hours("ts", F.when(fleet, 7).otherwise(0))).alias("reading_ts"),
        F.when(F.col("value") >= 2, shown).alias("temp_value"),
        F.when((F.col("event_type") == "signup") | (F.col("value") > 100), F.lit(None).cast("string"))
        .when(fleet, "F")
        .otherwise("C")
        .alias("temp_unit"),
        "dt",
    )


def raw_wms(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    stage = F.element_at(
        F.array(*[F.lit(s) for s in ("RECEIVE", "PUTAWAY", "PICK", "PACK", "STAGE", "DISPATCH")]),
        F.least(F.col("l_linenumber"), F.lit(6)),
    )
    return lines.select(
        F.concat(F.lit("SC"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("scan_id"),
        _tag("WH", "s_nationkey").alias("warehouse_code"),
        stage.alias("event_type"),
        _tag("SO", "l_orderkey").alias("order_number"),
        _tag("SKU", "l_partkey").alias("sku_code"),
        _tag("BT", "l_returnflag").alias("batch_id"),
        F.col("l_quantity").cast("smallint").alias("qty_cases"),
        _tag("PL", "l_suppkey").alias("pallet_id"),
        F.col("l_linenumber").cast("tinyint").alias("dock_door"),
        _tag("OP", "l_linestatus").alias("operator_id"),
        _tag("HH", "l_returnflag").alias("handheld_device"),
        F.date_format(shift_hours("l_shipdate", F.col("l_linenumber")), "yyyy-MM-dd HH:mm:ss").alias("event_ts"),
        F.col("l_shipdate").cast("date").alias("dt"),
    )


def uom_conversion(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "part")
        .where("p_type <> 'PROMO'")
        .select(
            _tag("SKU", "p_partkey").alias("sku_code"),
            F.col("p_size").alias("eaches_per_case"),
            F.lit("EA").alias("base_uom"),
            F.lit("CS").alias("case_uom"),
        )
    )


def warehouse_master(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.select(
        _tag("WH", "n_nationkey").alias("warehouse_code"),
        F.col("n_name").alias("warehouse_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region_name"),
        F.lit("Asia/Kolkata").alias("timezone"),
        F.col("n_nationkey").alias("chilled_capacity_pallets"),
    )


def fiscal_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Every day from the first order to two days past the last shipment."""
    placed = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    shipped = table(spark, d, "lineitem").select(F.date_add(F.col("l_shipdate").cast("date"), 2).alias("day"))
    bounds = placed.unionByName(shipped).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return calendar_from_bounds(bounds, "first", "last")


def legacy_finance_weekly_report(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "orders")
        .groupBy(origin_bucket(F.col("o_orderdate").cast("date")).alias("week_ending"), F.col("o_orderpriority").alias("channel"))
        .agg(
            round_to(exact_sum("o_totalprice"), 2).alias("gross_sales_inr"),
            F.count("*").cast("int").alias("units_sold"),
        )
    )


def ingest_manifest(spark: SparkSession, d: str) -> DataFrame:
    def expected(feed: str, name: str, day: str, files: Column) -> DataFrame:
        part = F.concat(F.lit("dt="), F.col(day).cast("date").cast("string"))
        return (
            table(spark, d, name)
            .groupBy(part.alias("partition"))
            .agg(files.cast("int").alias("file_count"), F.count("*").alias("row_count"))
            .select(F.lit(feed).alias("feed"), "partition", "file_count", "row_count")
        )

    return (
        expected("reefer_telemetry", "events", "ts", F.count_distinct("event_type"))
        .unionByName(expected("wms_scan_events", "lineitem", "l_shipdate", F.count_distinct("l_linestatus")))
        .unionByName(expected("sales_order_header", "orders", "o_orderdate", F.lit(1)))
    )


def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """One 'file' per telemetry day and firmware, and per warehouse day and line status."""

    def files(feed: str, df: DataFrame, part: str, rows: Column, broken: Column) -> DataFrame:
        folder = F.concat(F.lit("dt="), F.col("dt").cast("string"))
        name = F.concat(F.lit(f"raw/{feed}/"), folder, F.lit("/part-"), F.col(part), F.lit(".parquet"))
        return (
            df.groupBy("dt", part)
            .agg(rows.alias("_rows"), F.coalesce(broken, F.lit(False)).alias("_broken"), F.count("*").alias("_all"))
            .select(
                name.alias("path"),
                F.lit(feed).alias("feed"),
                folder.alias("partition"),
                (F.col("_all") * 100).alias("bytes"),
                F.when(~F.col("_broken"), F.col("_rows")).alias("actual_rows"),
                F.when(F.col("_broken"), "CORRUPT").otherwise("OK").alias("read_status"),
                F.when(F.col("_broken"), "footer is unreadable").alias("error"),
            )
        )

    telemetry = files(
        "reefer_telemetry", raw_telemetry(spark, d), "firmware_version", F.count("*"), F.max("temp_value") > 150
    )
    scans = files(
        "wms_scan_events", raw_wms(spark, d), "operator_id", F.count_if(F.col("batch_id") != "BTR"), F.lit(False)
    )
    return telemetry.unionByName(scans)


INPUTS = {
    f.__name__: f
    for f in (
        raw_pos,
        raw_outlet,
        raw_product,
        raw_orders,
        raw_telemetry,
        raw_wms,
        uom_conversion,
        warehouse_master,
        fiscal_calendar,
        legacy_finance_weekly_report,
        ingest_manifest,
        file_inventory,
    )
}


def warehouse_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Library tables (or feeds) composed over the stand-in feeds; only what they read is touched."""
    return compose(lambda name: INPUTS[name](spark, sf_dir), *names)


def warehouse_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse_tables(spark, sf_dir, name)[name]

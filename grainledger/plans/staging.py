"""Raw feeds → canonical staging tables. Every function is lazy DataFrame → DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    above_limit,
    composite_key,
    local_date,
    local_time,
    outside_band,
    parse_ts,
    round_to,
    shift_hours,
    stated_or_vendor_unit,
    to_celsius,
    utc_text,
)
from ..functions.columns import LOCAL_LAYOUT
from ..operators import clock_offset, current_state, keep_first, scd2, unit_agreement

# Fixed value: vendors whose devices report Fahrenheit.
FAHRENHEIT_VENDORS = ("COLDEYE",)


def pos_lines(raw_pos: DataFrame) -> DataFrame:
    """Typed point-of-sale lines with drifted columns unified; duplicates still in."""
    return raw_pos.select(
        "txn_id",
        "txn_line_no",
        "basket_id",
        "outlet_code",
        F.col("channel").alias("till_channel"),
        "sku_code",
        utc_text("event_ts").alias("event_ts_utc"),
        F.col("ingest_date").cast("date").alias("ingest_date"),
        F.coalesce("qty", "quantity_units").cast("double").alias("qty"),
        F.col("uom").cast("string").alias("uom"),
        *[F.col(c).cast("double").alias(c) for c in ("unit_price", "discount_amount", "tax_amount")],
        *[F.col(c).cast("string").alias(c) for c in ("payment_mode", "source_file")],
    )


def derived_of_line() -> dict[str, Column]:
    """Columns of a line that follow from its others: local time and business date of the sale, and gross value."""
    return {
        "event_ts_ist": local_time("event_ts_utc"),
        "business_date": local_date("event_ts_utc"),
        "gross_sales_inr": F.col("qty") * F.col("unit_price"),
    }


def stg_pos(raw_pos: DataFrame) -> DataFrame:
    """One row per transaction line: the first delivery, with local business date and gross value.

    Derived columns come after the dedupe, so they are computed once per kept line and are not
    carried through its shuffle.
    """
    lines = keep_first(pos_lines(raw_pos), ["txn_id", "txn_line_no"], ["ingest_date", "event_ts_utc"])
    return lines.select("*", *[value.alias(name) for name, value in derived_of_line().items()])


def dq_firmware_clock(raw_telemetry: DataFrame) -> DataFrame:
    """Estimated clock offset per firmware, against the partition day."""
    stamped = raw_telemetry.select(
        F.col("firmware_version").cast("string").alias("firmware_version"),
        utc_text("reading_ts").alias("reading_ts"),
        "dt",
    )
    return clock_offset(stamped, "firmware_version", "reading_ts", "dt").select(
        "firmware_version", "med_h", "n", "baseline_h", "raw_offset_hours", "observed_offset_hours"
    )


def stg_telemetry(raw_telemetry: DataFrame, firmware_clock: DataFrame) -> DataFrame:
    """Readings in °C on a corrected clock, flagged, one row per distinct reading."""
    text = lambda c: F.col(c).cast("string").alias(c)
    readings = raw_telemetry.select(
        "device_id",
        text("telemetry_vendor"),
        text("firmware_version"),
        "vehicle_registration",
        "route_code",
        "warehouse_code",
        text("gateway_id"),
        utc_text("reading_ts").alias("reading_ts_raw"),
        F.col("dt").cast("date").alias("partition_date"),
        stated_or_vendor_unit("temp_unit", "telemetry_vendor", FAHRENHEIT_VENDORS).alias("temp_unit_inferred"),
        F.col("temp_value").cast("double").alias("_value"),
    ).withColumn("temperature_c", to_celsius("_value", "temp_unit_inferred"))

    # Duplicates agree on the raw clock and the temperature, so they can go before the clock is
    # corrected: the correction then runs on kept rows only.
    identity = ["device_id", "reading_ts_raw", "_t4", "gateway_id", "route_code", "vehicle_registration"]
    kept = keep_first(
        readings.drop("_value").withColumn("_t4", round_to("temperature_c", 4)), identity, ["partition_date"]
    ).drop("_t4")

    offsets = firmware_clock.select("firmware_version", F.col("observed_offset_hours").alias("_offset"))
    return (
        kept.join(offsets, "firmware_version", "left")
        .withColumn("clock_offset_hours", F.coalesce("_offset", F.lit(0)))
        .withColumn("reading_ts_corrected", shift_hours("reading_ts_raw", -F.col("clock_offset_hours")))
        .withColumn("business_date", F.col("reading_ts_corrected").cast("date"))
        .select(
            "device_id",
            "telemetry_vendor",
            "firmware_version",
            "vehicle_registration",
            "route_code",
            "warehouse_code",
            "gateway_id",
            "reading_ts_raw",
            "partition_date",
            "clock_offset_hours",
            "temp_unit_inferred",
            "reading_ts_corrected",
            "business_date",
            "temperature_c",
            above_limit("temperature_c").alias("above_limit_flag"),
            outside_band("temperature_c").alias("outside_band_flag"),
            composite_key("vehicle_registration", "route_code", "business_date").alias("trip_key"),
        )
    )


def stg_wms(raw_wms: DataFrame) -> DataFrame:
    """Warehouse scans with a parsed site-local time. The feed loses rows, it does not repeat them."""
    typed = {"event_ts": parse_ts("event_ts", LOCAL_LAYOUT), "dt": F.col("dt").cast("date")}
    return raw_wms.withColumns(typed).select(
        "scan_id",
        "warehouse_code",
        "event_type",
        "order_number",
        "sku_code",
        "batch_id",
        "qty_cases",
        "pallet_id",
        "dock_door",
        "operator_id",
        "handheld_device",
        "event_ts",
        "dt",
    )


def dim_outlet_scd2(raw_outlet: DataFrame) -> DataFrame:
    """Outlet history as half-open validity intervals."""
    changes = raw_outlet.withColumn("op_ts", utc_text("__op_ts"))
    return scd2(changes, "outlet_code", "op_ts", "__seq", "__op").select(
        "outlet_code",
        "outlet_name",
        "channel",
        "outlet_format",
        "city",
        "route_code",
        "warehouse_code",
        "credit_limit",
        "credit_terms_days",
        "gst_number",
        "status",
        "__op",
        "__seq",
        "extract_date",
        "valid_from",
        "valid_to",
    )


def dim_product(raw_product: DataFrame) -> DataFrame:
    """Current product master; a product whose newest change is a delete is gone."""
    changes = raw_product.withColumn("op_ts", utc_text("__op_ts")).select(
        "sku_code",
        "product_name",
        "category",
        "brand",
        "case_pack",
        "mrp",
        "list_price",
        "gst_rate_pct",
        "shelf_life_days",
        "is_chilled",
        "status",
        "__op",
        "__seq",
        "op_ts",
    )
    return current_state(changes, "sku_code", "op_ts", "__seq", "__op").drop("__op", "__seq", "op_ts")


def dq_uom_vs_case_pack(product: DataFrame, uom_conversion: DataFrame) -> DataFrame:
    return unit_agreement(product, uom_conversion, "sku_code", "case_pack", "eaches_per_case")


def order_changes(raw_orders: DataFrame) -> DataFrame:
    """Typed order-header changes."""
    return raw_orders.select(
        "order_number",
        "outlet_code",
        "warehouse_code",
        "route_code",
        *[F.col(c).cast("date").alias(c) for c in ("order_date", "requested_delivery_date")],
        "order_status",
        "line_count",
        *[F.col(c).cast("double").alias(c) for c in ("order_value_gross", "discount_amount", "tax_amount")],
        F.col("source_system").cast("string").alias("source_system"),
        "__op",
        "__seq",
        utc_text("__op_ts").alias("op_ts"),
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Current order headers. Deletes copy the insert's time, so the capture sequence decides them."""
    return current_state(
        order_changes(raw_orders), "order_number", "op_ts", "__seq", "__op", delete_rule="max_seq"
    ).drop("__op", "__seq")


def dq_order_source_profile(by_source: DataFrame) -> DataFrame:
    """Count, mean and median per source, as `fct_order_source` has them."""
    return by_source.select("source_system", "orders", "mean_gross", "median_gross")

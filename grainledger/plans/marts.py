"""Staging tables → marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fiscal_attributes, origin_bucket, round_to
from ..functions.columns import MONEY
from ..operators import (
    asof_join,
    coverage_grid,
    cycle_summary,
    event_vs_target,
    first_event_cycle,
    key_rollup,
    manifest_recon,
    series_recon,
    to_eaches,
    value_by_source,
    version_changes,
    volume_vs_mean,
)
from ..operators.sizing import lookup_side
from .staging import derived_of_line, pos_lines

# A source suspected of adding freight to order values, and by how much.
FREIGHT_SOURCE, FREIGHT_FACTOR = "PARTNER_API", 1.085

#: A line's columns as they are shuffled: texts before numbers, and first the texts of few lengths. So neighbouring rows
#: have more bytes in common at the same places, and compress better.
SHUFFLED = (
    *("uom", "payment_mode", "source_file", "outlet_warehouse", "outlet_city", "sku_code", "outlet_code", "outlet_name"),
    *("txn_id", "basket_id", "till_channel", "outlet_channel_asof"),
    *("event_ts_utc", "txn_line_no", "qty", "discount_amount", "tax_amount", "ingest_date", "unit_price"),
)


def calendar_from_bounds(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """A fiscal calendar covering `[first, last]` of a one-row frame, one row per day."""
    days = bounds.select(F.explode(F.sequence(first, last)).alias("calendar_date"))
    return days.withColumns(fiscal_attributes("calendar_date"))


def dim_date(fiscal_calendar: DataFrame) -> DataFrame:
    """Fiscal attributes per day plus the report week the day belongs to."""
    return fiscal_calendar.select(
        F.col("calendar_date").cast("date").alias("calendar_date"),
        "fiscal_year",
        "fiscal_quarter",
        "fiscal_month_no",
        "iso_week",
        "day_of_week",
        F.col("is_weekend").cast("int").alias("is_weekend"),
        origin_bucket("calendar_date").alias("report_week"),
    )


def single_factors(uom_conversion: DataFrame) -> DataFrame:
    """(sku_code, eaches_per_case), one row per code. A repeated code is an error: it would multiply sales."""
    counted = uom_conversion.where("sku_code IS NOT NULL").groupBy("sku_code").agg(
        F.count("*").alias("n"), F.min("eaches_per_case").alias("eaches_per_case")
    )
    repeated = F.raise_error(F.concat(F.lit("uom_conversion repeats sku_code "), "sku_code")).cast("int")
    return counted.select("sku_code", F.when(F.col("n") > 1, repeated).otherwise(F.col("eaches_per_case")).alias("eaches_per_case"))


def set_apart(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """`df` for a shuffle: a column that `derived` can give again is left out, but for values that differ from it."""
    odd = [F.when(~F.col(c).eqNullSafe(value), F.struct(F.col(c).alias("is"))).alias(f"_odd_{c}") for c, value in derived.items()]
    return df.select(*[c for c in df.columns if c not in derived], *odd)


def put_back(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """What `set_apart` left out, as it was."""
    odd = {c: F.col(f"_odd_{c}") for c in derived}
    whole = {c: F.when(odd[c].isNull(), value).otherwise(odd[c]["is"]) for c, value in derived.items()}
    return df.withColumns(whole).drop(*[f"_odd_{c}" for c in derived])


def ordered(lines: DataFrame) -> DataFrame:
    """The same columns, those of SHUFFLED last and in its order."""
    known = [c for c in SHUFFLED if c in lines.columns]
    return lines.select(*[c for c in lines.columns if c not in known], *known)


def fct_pos_line(pos: DataFrame, outlets: DataFrame, products: DataFrame, uom_conversion: DataFrame) -> DataFrame:
    """Canonical lines with the outlet as of the sale, product attributes and eaches.

    Both product lookups have one row per sku_code, which Spark sees: where no column of a lookup is asked for, its
    join and all behind it fall away. Where both are, the lines are dealt by the product key once for the two.
    A line is shuffled without what follows from its other columns, and in an order that compresses well.
    """
    derived = derived_of_line()
    master = products.select("sku_code", "product_name", "category", "case_pack")
    factors = single_factors(uom_conversion)
    with_outlet = asof_join(
        ordered(set_apart(pos, derived)),
        outlets,
        "outlet_code",
        "event_ts_utc",
        {
            "channel": "outlet_channel_asof",
            "outlet_name": "outlet_name",
            "city": "outlet_city",
            "warehouse_code": "outlet_warehouse",
        },
    )
    looked_up = (
        ordered(with_outlet)
        .join(lookup_side(master, products, copies=2), "sku_code", "left")
        .join(lookup_side(factors, uom_conversion, copies=2), "sku_code", "left")
    )
    return (
        put_back(looked_up, derived)
        .withColumns(to_eaches("qty", "uom", "eaches_per_case", "case_pack"))
        .select(
            "txn_id",
            "txn_line_no",
            "basket_id",
            "outlet_code",
            "till_channel",
            "outlet_channel_asof",
            "outlet_name",
            "outlet_city",
            "outlet_warehouse",
            "sku_code",
            "product_name",
            "category",
            "event_ts_utc",
            "event_ts_ist",
            "business_date",
            "ingest_date",
            "qty",
            "uom",
            "unit_price",
            "discount_amount",
            "tax_amount",
            "gross_sales_inr",
            "payment_mode",
            "source_file",
            "case_pack",
            "eaches_per_case",
            "conversion_status",
            "conversion_source",
            "eaches",
        )
    )


def fct_sales_daily(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily sales by till channel and as-of channel.

    Lines are summed by day and channels first; the calendar joins the daily rows, not the lines. A line is counted
    in two rows, one with its figures and one with its basket: figures shrink to a row a day before they are
    shuffled, and only baskets travel to be told apart.
    """
    cell = ["business_date", "till_channel", "outlet_channel_asof"]
    sums = ["gross_sales_inr", "discount_amount", "eaches"]
    figures = {
        "_line": (F.lit(1), "int"),
        "_unknown": (F.col("conversion_status") == "UNKNOWN", "boolean"),
        **{c: (F.col(c).cast(MONEY), MONEY) for c in sums},
    }
    none = F.lit(None)
    no_basket = none.cast(lines.schema["basket_id"].dataType).alias("basket_id")
    first = F.struct(no_basket, *[c.alias(n) for n, (c, _) in figures.items()])
    second = F.struct("basket_id", *[none.cast(t).alias(n) for n, (_, t) in figures.items()])
    halves = lines.select(*cell, F.explode(F.array(first, second)).alias("_half")).select(*cell, "_half.*")
    apart = halves.where("_line IS NOT NULL OR basket_id IS NOT NULL").groupBy(*cell, "basket_id").agg(
        F.count("_line").alias("_lines"),
        F.count_if("_unknown").alias("_unknowns"),
        *[F.sum(c).alias(c) for c in sums],
    )
    total = lambda c: round_to(F.sum(c).cast("double"), 2)
    daily = apart.groupBy(*cell).agg(
        F.sum("_lines").alias("line_count"),
        F.count("basket_id").alias("basket_count"),
        total("gross_sales_inr").alias("gross_sales_inr"),
        total("discount_amount").alias("discount_inr"),
        total("eaches").alias("units_eaches"),
        F.sum("_unknowns").alias("units_unknown_lines"),
    )
    return daily.join(dates, daily.business_date == dates.calendar_date, "left").select(
        "business_date",
        "fiscal_year",
        "fiscal_quarter",
        "fiscal_month_no",
        "report_week",
        "till_channel",
        "outlet_channel_asof",
        "line_count",
        "basket_count",
        "gross_sales_inr",
        "discount_inr",
        "units_eaches",
        "units_unknown_lines",
    )


RECON_GAPS = {
    "canonical_minus_legacy": ("canonical_gross", "legacy_gross"),
    "legacy_minus_published": ("legacy_gross", "published_gross"),
    "canonical_minus_published": ("canonical_gross", "published_gross"),
    "impact_dedupe": ("legacy_gross", "ingest_deduped_gross"),
    "impact_date_attribution": ("ingest_deduped_gross", "canonical_gross"),
}


def fct_finance_recon(raw_pos: DataFrame, pos: DataFrame, published: DataFrame) -> DataFrame:
    """Weekly sales by till channel in three versions, and why they differ.

    canonical: business week of deduplicated lines; legacy: arrival week with duplicates;
    published: the finance report. The step from legacy to canonical splits into the duplicates
    (arrival week, before and after dedupe) and the dates (arrival against business week).
    """
    delivered = pos_lines(raw_pos).select(
        "ingest_date", "till_channel", (F.col("qty") * F.col("unit_price")).alias("gross_sales_inr")
    )

    def cell(day: str, channel: str) -> list[Column]:
        return [origin_bucket(day), F.col(channel)]

    recon = series_recon(
        {
            "canonical_gross": (pos, cell("business_date", "till_channel"), "gross_sales_inr"),
            "legacy_gross": (delivered, cell("ingest_date", "till_channel"), "gross_sales_inr"),
            "ingest_deduped_gross": (pos, cell("ingest_date", "till_channel"), "gross_sales_inr"),
            "published_gross": (
                published,
                [F.col("week_ending").cast("date"), F.col("channel")],
                "gross_sales_inr",
            ),
        },
        ["report_week", "channel"],
        RECON_GAPS,
    )
    return recon.select(
        "report_week", "channel", "canonical_gross", "legacy_gross", "published_gross", *RECON_GAPS
    )


def fct_cold_chain_trip(telemetry: DataFrame) -> DataFrame:
    """Readings per vehicle, route and corrected day."""
    return key_rollup(
        telemetry,
        ["trip_key", "vehicle_registration", "route_code", "business_date"],
        "temperature_c",
        {
            "above_limit_flag": ("above_limit_readings", "has_above_limit_excursion"),
            "outside_band_flag": ("outside_band_readings", "has_outside_band_excursion"),
        },
        carry=["warehouse_code", "telemetry_vendor"],
    )


def fct_wms_cycle(wms: DataFrame) -> DataFrame:
    """First receipt to first dispatch per order."""
    return first_event_cycle(
        wms, "order_number", "event_type", "event_ts", "RECEIVE", "DISPATCH", carry=["warehouse_code"]
    )


def fct_wms_cycle_warehouse(cycles: DataFrame) -> DataFrame:
    return cycle_summary(cycles, "warehouse_code")


def fct_outlet_channel_change(outlets: DataFrame) -> DataFrame:
    return version_changes(outlets, "outlet_code", "channel", carry=["outlet_name"])


def dq_partition_recon(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    return manifest_recon(manifest, inventory)


def dq_gateway_date(raw_telemetry: DataFrame) -> DataFrame:
    """Every gateway seen × every day seen, counted on delivered readings."""
    seen = raw_telemetry.select(F.col("gateway_id").cast("string").alias("gateway_id"), F.col("dt").cast("date").alias("dt"))
    return coverage_grid(seen, "gateway_id", "dt")


def dq_missing_gateway_days(grid: DataFrame) -> DataFrame:
    return grid.where("is_missing").select("gateway_id", "dt", "reading_count")


def dq_daily_telemetry_volume(raw_telemetry: DataFrame) -> DataFrame:
    return volume_vs_mean(raw_telemetry.select(F.col("dt").cast("date").alias("dt")), "dt")


def fct_dispatch_on_request(orders: DataFrame, wms: DataFrame) -> DataFrame:
    """Whether an order's first dispatch scan fell on or before the requested date."""
    return event_vs_target(
        orders,
        wms,
        "order_number",
        "event_type",
        "event_ts",
        "DISPATCH",
        "requested_delivery_date",
        ["requested_delivery_date", "order_status", "source_system", "warehouse_code"],
    )


def fct_order_source(orders: DataFrame) -> DataFrame:
    return value_by_source(orders, "source_system", "order_value_gross", {FREIGHT_SOURCE: FREIGHT_FACTOR})

"""Invariants and profile figures of a built warehouse, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum, pct, round_to
from ..operators import exact_median, latest_per_key
from ..operators.cdc import tombstoned_keys


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def median_agreement(telemetry: DataFrame, vendors: tuple[str, str], tolerance: float = 3.0,
                     ceiling: float = 60.0) -> DataFrame:
    """Do two vendors agree on the typical temperature, and is anything implausibly hot?

    One row: both medians, whether they lie within `tolerance`, and the count above `ceiling`.
    """
    med = exact_median(telemetry.where(F.col("telemetry_vendor").isin(*vendors)), ["telemetry_vendor"],
                       "temperature_c", "m")
    a, b = vendors
    pair = med.agg(
        F.max(F.when(F.col("telemetry_vendor") == a, F.col("m"))).alias("first_median"),
        F.max(F.when(F.col("telemetry_vendor") == b, F.col("m"))).alias("second_median"),
    )
    hot = telemetry.agg(F.count_if(F.col("temperature_c") > ceiling).alias("n")).scalar()
    return pair.withColumn(
        "agree", F.abs(F.col("first_median") - F.col("second_median")) < tolerance
    ).withColumn("implausible", hot)


def conversion_violations(lines: DataFrame) -> DataFrame:
    """Lines without a status, and unknown lines that still carry units."""
    return lines.agg(
        F.count_if(F.col("conversion_status").isNull()).alias("without_status"),
        F.count_if((F.col("conversion_status") == "UNKNOWN") & F.col("eaches").isNotNull()).alias(
            "unknown_with_units"
        ),
    )


def revived_orders(raw_orders: DataFrame, orders: DataFrame) -> DataFrame:
    """Tombstoned orders that are nevertheless in the current state (expected: none)."""
    dead = tombstoned_keys(raw_orders, "order_number", "__seq", "__op")
    return orders.join(dead, "order_number", "left_semi")


def scd2_violations(outlets: DataFrame, changes: DataFrame) -> DataFrame:
    """Empty intervals and repeated changes, counted."""
    repeated = duplicate_keys(changes, ["outlet_code", "changed_at", "channel_from", "channel_to"])
    return outlets.agg(F.count_if(F.col("valid_from") >= F.col("valid_to")).alias("zero_length")).withColumn(
        "repeated_changes", repeated.agg(F.count("*").alias("n")).scalar()
    )


def current_versions(outlets: DataFrame) -> DataFrame:
    """The newest version of each outlet."""
    return latest_per_key(outlets.select("outlet_code", "valid_from", "channel"), ["outlet_code"], ["valid_from"])


def asof_vs_current(lines: DataFrame, outlets: DataFrame) -> DataFrame:
    """How many matched lines carry a channel other than the outlet's newest one."""
    now = current_versions(outlets).select("outlet_code", F.col("channel").alias("_now"))
    matched = lines.where(F.col("outlet_channel_asof").isNotNull()).join(now, "outlet_code")
    return matched.agg(
        F.count("*").alias("matched_lines"),
        F.count_if(~F.col("outlet_channel_asof").eqNullSafe(F.col("_now"))).alias("differs_from_current"),
    )


def conversion_profile(lines: DataFrame) -> DataFrame:
    return lines.groupBy("conversion_source", "conversion_status").agg(F.count("*").alias("n"))


def recon_totals(recon: DataFrame) -> DataFrame:
    """Totals of each series in billions, absolute gaps in billions, impacts in millions."""

    def total(c: str, unit: float, digits: int):
        return round_to(exact_sum(c) / F.lit(unit), digits)

    sized = recon.withColumn("_gap_c", F.abs("canonical_minus_published")).withColumn(
        "_gap_l", F.abs("legacy_minus_published")
    )
    return sized.agg(
        total("canonical_gross", 1e9, 3).alias("canon_bn"),
        total("legacy_gross", 1e9, 3).alias("legacy_bn"),
        total("published_gross", 1e9, 3).alias("pub_bn"),
        total("_gap_c", 1e9, 3).alias("abs_canon_pub_bn"),
        total("_gap_l", 1e9, 3).alias("abs_leg_pub_bn"),
        total("impact_dedupe", 1e6, 2).alias("dedupe_m"),
        total("impact_date_attribution", 1e6, 2).alias("date_m"),
    )


def recon_correlation(recon: DataFrame) -> DataFrame:
    """Pearson correlation of the series, over cells the published report has."""
    return recon.where(F.col("published_gross").isNotNull()).agg(
        F.corr("canonical_gross", "published_gross").alias("corr_canon"),
        F.corr("legacy_gross", "published_gross").alias("corr_legacy"),
        F.corr("canonical_gross", "legacy_gross").alias("corr_canon_legacy"),
    )


def gap_ranges(missing_days: DataFrame, top: int = 10) -> DataFrame:
    """The units with the most missing days, with first and last missing day."""
    return (
        missing_days.groupBy("gateway_id")
        .agg(F.min("dt").alias("first_missing"), F.max("dt").alias("last_missing"), F.count("*").alias("n"))
        .orderBy(F.desc("n"), "gateway_id")
        .limit(top)
    )


def cycle_coverage(by_warehouse: DataFrame) -> DataFrame:
    return by_warehouse.agg(
        F.sum("orders_with_scans").alias("orders"),
        F.sum("complete_journeys").alias("complete"),
        pct(F.sum("complete_journeys"), F.sum("orders_with_scans")).alias("coverage_pct"),
    )


def threshold_rates(trips: DataFrame) -> DataFrame:
    valid = F.count_if(F.col("valid_readings") > 0)
    return trips.agg(
        pct(F.count_if("has_above_limit_excursion"), valid).alias("above_pct"),
        pct(F.count_if("has_outside_band_excursion"), valid).alias("outside_pct"),
    )


def drift_fill(raw_pos: DataFrame) -> DataFrame:
    """How many rows fill the old and the new spelling of a renamed column."""
    return raw_pos.agg(F.count("qty").alias("qty_rows"), F.count("quantity_units").alias("quantity_units_rows"))

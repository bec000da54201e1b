"""Rollups of event streams to a key: first events, cycle times, targets, values by source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pct, round_to
from .medians import value_summary, with_exact_median


def key_rollup(df: DataFrame, keys: Sequence[str], value: str, flags: Mapping[str, tuple[str, str]],
               carry: Sequence[str] = ()) -> DataFrame:
    """Readings per key: total, non-missing, and per flag column its (count name, any name).

    `carry` columns are taken once per key (the smallest value, so that reruns agree).
    """
    aggs = [F.min(c).alias(c) for c in carry]
    aggs += [F.count("*").alias("reading_count"), F.count(value).alias("valid_readings")]
    aggs += [F.count_if(F.col(f)).alias(n) for f, (n, _) in flags.items()]
    aggs += [F.bool_or(F.col(f)).alias(a) for f, (_, a) in flags.items()]
    return df.groupBy(*keys).agg(*aggs)


def first_event_cycle(df: DataFrame, key: str, event: str, ts: str, start: str, end: str,
                      carry: Sequence[str] = ()) -> DataFrame:
    """First `start` and first `end` event per key, and the seconds between when in order."""
    first = lambda kind: F.min(F.when(F.col(event) == kind, F.col(ts)))
    per_key = df.groupBy(key).agg(
        *[F.min(c).alias(c) for c in carry],
        first(start).alias(f"{start.lower()}_ts"),
        first(end).alias(f"{end.lower()}_ts"),
        F.count("*").alias("scan_count"),
        F.count_distinct(event).alias("stage_count"),
    )
    a, b = F.col(f"{start.lower()}_ts"), F.col(f"{end.lower()}_ts")
    in_order = F.coalesce(b >= a, F.lit(False))
    return per_key.withColumn("cycle_seconds", F.when(in_order, F.timestamp_diff("SECOND", a, b))).withColumn(
        "complete_journey", in_order
    )


def cycle_summary(cycles: DataFrame, group: str) -> DataFrame:
    """Coverage and median duration of complete cycles per group."""
    summary = cycles.groupBy(group).agg(
        F.count("*").alias("orders_with_scans"),
        F.count_if("complete_journey").alias("complete_journeys"),
        pct(F.count_if("complete_journey"), F.count("*")).alias("coverage_pct"),
    )
    return with_exact_median(summary, cycles.where("complete_journey"), [group], "cycle_seconds",
                             "median_cycle_seconds")


def event_vs_target(orders: DataFrame, events: DataFrame, key: str, event: str, ts: str, kind: str,
                    target: str, keep: Sequence[str]) -> DataFrame:
    """Whether the first `kind` event of each order fell on or before its target date."""
    first = events.where(F.col(event) == kind).groupBy(key).agg(F.min(ts).alias("dispatch_ts"))
    day = F.col("dispatch_ts").cast("date")
    return orders.select(key, *keep).join(first, key, "left").select(
        key,
        *keep,
        "dispatch_ts",
        day.alias("dispatch_date"),
        F.col("dispatch_ts").isNotNull().alias("has_dispatch_scan"),
        (day <= F.col(target)).alias("on_request_date"),
    )


def source_profile(df: DataFrame, source: str, value: str) -> DataFrame:
    """Count, mean and median of a value per source."""
    return value_summary(df, [source], value, "median_gross").select(
        source, F.col("_rows").alias("orders"), round_to("_mean", 2).alias("mean_gross"),
        round_to("median_gross", 2).alias("median_gross"),
    )


def value_by_source(df: DataFrame, source: str, value: str, adjust: Mapping[str, float]) -> DataFrame:
    """Total, adjusted total, mean and median per source.

    `adjust` divides the totals of the named sources, for instance to take out a suspected uplift.
    """
    divisor = F.lit(1.0)
    for name, by in adjust.items():
        divisor = F.when(F.col(source) == name, F.lit(float(by))).otherwise(divisor)
    return value_summary(df, [source], value, "median_gross").select(
        source,
        F.col("_rows").alias("orders"),
        round_to("_total", 2).alias("order_value_gross"),
        round_to(F.col("_total") / divisor, 2).alias("order_value_ex_suspected_freight"),
        round_to("_mean", 2).alias("mean_gross"),
        round_to("median_gross", 2).alias("median_gross"),
    )

"""Exact medians without holding a group's values in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY
from .cells import CELLS, cell_bounds, cell_of, same_keys


def median_small_domain(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Median and count per group of a column with few distinct values (hours, days, codes).

    Values are counted first, so what reaches a group is its distinct values, not its rows.
    """
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(
        F.percentile(value, 0.5, F.col("_n")).alias(out), F.sum("_n").alias("n")
    )


def counted(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys…, value, _n): how often each value occurs in a group, missing ones too."""
    return df.groupBy(*keys, value).agg(F.count("*").alias("_n"))


def median_of_counts(counts: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group, (keys…, out), of counted values. Missing values are ignored; NaN is the largest value.

    The distinct values of a large group are dealt to cells of about equally many (see `cell_bounds`), the counts are
    summed into cells, and only the one or two cells that hold the middle ranks are ranked value by value: some
    1/CELLS of a group's distinct values, whatever their distribution, or the few of a group that has no more.
    """
    group = list(keys) or ["_all"]
    src = counts if keys else counts.withColumn("_all", F.lit(1))
    # Reading the count keeps it in the plan, so every use reads the same shuffled counts.
    src = src.where(F.col(value).isNotNull() & (F.col("_n") > 0)).select(*group, F.col(value).cast("double").alias("_v"), "_n")
    mine = [f"_b_{k}" for k in group]
    bounds = cell_bounds(src, group, "_v", CELLS)
    dealt = src.join(bounds, same_keys(group, mine), "left").select(*group, "_v", "_n", cell_of(F.col("_v")).alias("_cell"))
    whole = Window.partitionBy(*group)
    upward = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = [f"_c_{k}" for k in group]
    cells = (
        dealt.groupBy(*group, "_cell")
        .agg(F.sum("_n").alias("_cn"))
        .withColumn("_upto", F.sum("_cn").over(upward))
        .withColumn("_total", F.sum("_cn").over(whole))
        .withColumn("_lo", F.expr("(_total + 1) div 2"))
        .withColumn("_hi", F.expr("(_total + 2) div 2"))
        .where("_upto >= _lo AND _upto - _cn < _hi")
        .select(
            *[F.col(k).alias(h) for k, h in zip(group, hit)],
            F.col("_cell").alias("_hit"),
            (F.col("_upto") - F.col("_cn")).alias("_before"),
            "_lo",
            "_hi",
        )
    )
    # Null-safe on every column: no inferred filter, so both sides read the same shuffled counts.
    on = F.col("_cell").eqNullSafe(F.col("_hit")) & same_keys(group, hit)
    in_cell = Window.partitionBy(*group, "_cell").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = dealt.join(cells, on).withColumn("_rank", F.col("_before") + F.sum("_n").over(in_cell))
    middle = ranked.groupBy(*group).agg(
        F.min(F.when(F.col("_rank") >= F.col("_lo"), F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_rank") >= F.col("_hi"), F.col("_v"))).alias("_b"),
    )
    between = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.lit(0.5))
    return middle.select(*keys, between.alias(out))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group: (keys…, out). Missing values are ignored.

    Spark's own `median` keeps a group's distinct values in one task's memory. Here the values are counted with
    map-side combining, and no task ever ranks a large group's values (see `median_of_counts`).
    """
    return median_of_counts(counted(df, keys, value), keys, value, out)


def with_median(summary: DataFrame, med: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`summary` (one row per group) with the columns of `med`, whose groups may be fewer."""
    mine = [f"_m_{k}" for k in keys]
    for k, m in zip(keys, mine):
        med = med.withColumnRenamed(k, m)
    return summary.join(med, same_keys(keys, mine), "left").drop(*mine)


def with_exact_median(summary: DataFrame, df: DataFrame, keys: Sequence[str], value: str,
                      out: str) -> DataFrame:
    """`summary` (one row per group) with the group's exact median of `value` added."""
    return with_median(summary, exact_median(df, keys, value, out), keys)


def value_summary(df: DataFrame, keys: Sequence[str], value: str, median: str) -> DataFrame:
    """Per group: `_rows`, `_total` and `_mean` (exact sums as doubles) and the exact median, from one count of values.

    The table is read and shuffled once: all figures come from how often each value occurs.
    """
    counts = counted(df, keys, value)
    money = F.col(value).cast(MONEY)
    present = F.sum(F.when(F.col(value).isNotNull(), F.col("_n")))
    summary = counts.where(F.col("_n") > 0).groupBy(*keys).agg(
        F.sum("_n").alias("_rows"), F.sum(money * F.col("_n")).cast("double").alias("_total"), present.alias("_present")
    )
    summary = summary.withColumn("_mean", F.col("_total") / F.col("_present")).drop("_present")
    return with_median(summary, median_of_counts(counts, keys, value, median), keys)

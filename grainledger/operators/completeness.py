"""What should have arrived against what did."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_recon(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Expected against observed files and rows per (feed, partition), from both sides."""
    ok = F.col("read_status") == "OK"
    observed = inventory.groupBy("feed", "partition").agg(
        F.count("*").alias("_files"),
        F.coalesce(F.sum(F.when(ok, F.col("actual_rows"))), F.lit(0)).alias("_rows"),
        F.count_if(~ok).alias("_bad"),
    )
    expected = manifest.select(
        "feed", "partition", F.col("file_count").alias("manifest_files"), F.col("row_count").alias("manifest_rows")
    )
    return expected.join(observed, ["feed", "partition"], "full").select(
        "feed",
        "partition",
        "manifest_files",
        "manifest_rows",
        F.coalesce("_files", F.lit(0)).cast("bigint").alias("observed_files"),
        F.coalesce("_rows", F.lit(0)).cast("bigint").alias("observed_rows_ok"),
        F.coalesce("_bad", F.lit(0)).cast("bigint").alias("corrupt_files"),
    )


def _day_words(days: DataFrame, unit: str, day: str) -> DataFrame:
    """(unit, _word, _bits): a unit's days as bits, 64 days to a word; a unit without any day has one empty word."""
    n = F.unix_date(day)
    at = days.select(unit, F.floor(n / 64).cast("int").alias("_word"), F.pmod(n, F.lit(64)).alias("_at"))
    bit = F.coalesce(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_at")), F.lit(0).cast("bigint"))
    return at.groupBy(unit, "_word").agg(F.bit_or(bit).alias("_bits"))


def missing_cells(df: DataFrame, unit: str, day: str, expected_units: DataFrame | None = None,
                  expected_days: DataFrame | None = None) -> DataFrame:
    """(unit, day) of every unit and every day of the calendar on which the unit did not report.

    Days are bits of 64-day words: rows are combined into words before they are shuffled, a unit holds one long for
    64 days, and what it lacks is the calendar's words without its own. The calendar (the days on which any unit
    reported, and the expected ones) travels as one short array, so units and days are never joined.
    """
    arrived = df.where(F.col(day).isNotNull()).select(unit, F.col(day).cast("date").alias(day))
    known = arrived
    if expected_days is not None:
        extra = expected_days.select(F.lit(None).cast(df.schema[unit].dataType).alias(unit), F.col(expected_days.columns[0]).cast("date").alias(day))
        known = known.unionByName(extra.where(F.col(day).isNotNull()))
    calendar = _day_words(known, unit, day).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    calendar = calendar.agg(F.collect_list(F.struct("_word", "_bits"))).scalar()

    units = arrived
    if expected_units is not None:
        silent = expected_units.select(F.col(expected_units.columns[0]).alias(unit), F.lit(None).cast("date").alias(day))
        units = units.unionByName(silent)
    held = _day_words(units, unit, day).groupBy(unit).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("_word").isNotNull(), F.struct("_word", "_bits")))).alias("_held")
    ).withColumn("_calendar", calendar)
    lacking = F.transform(
        "_calendar",
        lambda c: F.struct(
            c["_word"].alias("word"),
            c["_bits"].bitwiseAND(F.bitwise_not(F.coalesce(F.try_element_at("_held", c["_word"]), F.lit(0).cast("bigint")))).alias("bits"),
        ),
    )
    words = held.select(unit, F.explode(F.filter(lacking, lambda w: w["bits"] != 0)).alias("w"))
    one = lambda i: F.call_function("shiftrightunsigned", F.col("w.bits"), i).bitwiseAND(F.lit(1)) == 1
    bits = words.select(unit, "w.word", F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), one)).alias("at"))
    return bits.select(unit, F.date_from_unix_date(F.col("word") * 64 + F.col("at")).alias(day))


def coverage_grid(df: DataFrame, unit: str, day: str, expected_units: DataFrame | None = None,
                  expected_days: DataFrame | None = None) -> DataFrame:
    """Every unit × every day with its row count and a missing flag.

    The observed cells are counted, the others are `missing_cells`. Pass expected lists to see units that never
    reported and days on which nothing arrived. Rows without a unit code cannot be attributed, so the missing code
    is listed as missing on all days.
    """
    seen = df.where(F.col(day).isNotNull()).groupBy(unit, day).agg(F.count("*").alias("reading_count"))
    # The holes are taken from the counted cells, and read the count: so both halves share one shuffle.
    cells = seen.where(F.col("reading_count") > 0).select(unit, day)
    holes = missing_cells(cells, unit, day, expected_units, expected_days).select(
        unit, day, F.lit(0).cast("bigint").alias("reading_count"), F.lit(True).alias("is_missing")
    )
    nameless = F.col(unit).isNull()
    observed = seen.select(
        unit,
        day,
        F.when(nameless, F.lit(0).cast("bigint")).otherwise(F.col("reading_count")).alias("reading_count"),
        nameless.alias("is_missing"),
    )
    return observed.unionByName(holes)


def volume_vs_mean(df: DataFrame, day: str) -> DataFrame:
    """Rows per day next to the mean over all days."""
    daily = df.groupBy(day).agg(F.count("*").alias("readings"))
    return daily.withColumn("mean_readings", daily.agg(F.avg("readings")).scalar())


def issue_list(*issues: DataFrame) -> DataFrame:
    """Findings of different checks in one shape: issue, feed, partition, detail, n."""
    shape = ("issue", "feed", "partition", "detail", "n")
    return reduce(DataFrame.unionByName, [d.select(*shape) for d in issues])

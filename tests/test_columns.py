import datetime as dt

import pytest
from pyspark.sql import functions as F

from grainledger.functions import (
    above_limit,
    composite_key,
    fiscal_attributes,
    hours_since,
    local_date,
    month_start,
    origin_bucket,
    outside_band,
    pct,
    round_to,
    safe_ratio,
    shift_hours,
    stated_or_vendor_unit,
    to_celsius,
    utc_text,
)


def values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_local_business_date_turns_at_1830_utc(frame):
    df = frame("t STRING", ("2025-03-01T18:29:59Z",), ("2025-03-01T18:30:00Z",))
    assert values(df, local_date(utc_text("t"))) == [dt.date(2025, 3, 1), dt.date(2025, 3, 2)]


def test_utc_text_with_and_without_z(frame):
    df = frame("t STRING", ("2025-03-01T18:29:59Z",), ("2025-03-01T18:29:59",), (None,))
    at = dt.datetime(2025, 3, 1, 18, 29, 59)
    assert values(df, utc_text("t")) == [at, at, None]


@pytest.mark.parametrize("bad", ["2025-03-01 18:29:59", "2025-02-30T00:00:00Z", "yesterday", "2025-03-01T18:29:59+05:30"])
def test_malformed_time_stops_the_job(frame, bad):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        values(frame("t STRING", (bad,)), utc_text("t"))


def test_origin_bucket_floors_downwards(frame):
    df = frame("d DATE", ("2025-01-01",), ("2025-01-07",), ("2025-01-08",), ("2024-12-31",), ("2024-12-25",))
    assert values(df, origin_bucket("d")) == [
        dt.date(2025, 1, 1),
        dt.date(2025, 1, 1),
        dt.date(2025, 1, 8),
        dt.date(2024, 12, 25),
        dt.date(2024, 12, 25),
    ]


def test_hours_count_down_before_midnight(frame):
    df = frame("d DATE, t TS", ("2025-01-02", "2025-01-01 23:30:00"), ("2025-01-02", "2025-01-02 07:59:59"))
    assert values(df, hours_since("d", "t")) == [-1, 7]


def test_shift_by_a_column(frame):
    df = frame("t TS, h INT", ("2025-01-01 03:00:00", 7))
    assert values(df, shift_hours("t", -F.col("h"))) == [dt.datetime(2024, 12, 31, 20)]


def test_month_start(frame):
    assert values(frame("d DATE", ("2025-02-28",)), month_start("d")) == [dt.date(2025, 2, 1)]


def test_fiscal_year_is_named_after_the_year_it_ends_in(frame):
    df = frame("d DATE", ("2026-03-31",), ("2026-04-01",), ("2026-12-31",), ("2100-01-05",)).select(
        *[c.alias(n) for n, c in fiscal_attributes("d").items()]
    )
    got = [(r.fiscal_year, r.fiscal_quarter, r.fiscal_month_no) for r in df.collect()]
    assert got == [("FY26", "Q4", 12), ("FY27", "Q1", 1), ("FY27", "Q3", 9), ("FY00", "Q4", 10)]


def test_weekend_flag_and_names(frame):
    df = frame("d DATE", ("2025-01-03",), ("2025-01-04",), ("2025-01-05",)).select(
        *[c.alias(n) for n, c in fiscal_attributes("d").items()]
    )
    assert [(r.day_of_week, r.is_weekend, r.iso_week) for r in df.collect()] == [
        ("Friday", 0, 1), ("Saturday", 1, 1), ("Sunday", 1, 1)
    ]


def test_rounding_uses_the_stored_value(frame):
    df = frame("x DOUBLE", (1.005,), (2.5,), (-2.345,), (0.125,), (None,))
    assert values(df, round_to("x", 2)) == [1.0, 2.5, -2.35, 0.13, None]


def test_ratio_with_zero_denominator_is_null(frame):
    df = frame("a INT, b INT", (1, 0), (1, 8), (1, None))
    assert values(df, safe_ratio(F.col("a"), F.col("b"))) == [None, 0.125, None]
    assert values(df, pct(F.col("a"), F.col("b"))) == [None, 12.5, None]


def test_units_and_flags(frame):
    df = frame(
        "v DOUBLE, u STRING, vendor STRING",
        (46.4, "F", "THERMLOG"),
        (8.0, "C", "COLDEYE"),
        (8.01, None, "THERMLOG"),
        (50.0, None, "COLDEYE"),
        (None, "C", "THERMLOG"),
        (1.0, "K", None),
    ).withColumn("unit", stated_or_vendor_unit("u", "vendor", ["COLDEYE"]))
    out = df.withColumn("c", to_celsius("v", "unit")).select(
        "unit", "c", above_limit("c").alias("above"), outside_band("c").alias("outside")
    )
    rows = [tuple(r) for r in out.collect()]
    assert [r[0] for r in rows] == ["F", "C", "C", "F", "C", "C"]
    assert [r[1] for r in rows][1:] == [8.0, 8.01, 10.0, None, 1.0]
    assert abs(rows[0][1] - 8.0) < 1e-9
    assert [r[2] for r in rows][1:] == [False, True, True, False, False]
    assert [r[3] for r in rows][1:] == [False, True, True, False, True]


def test_key_is_missing_when_a_part_is(frame):
    df = frame("a STRING, b STRING, d DATE", ("v", "r", "2025-01-01"), ("v", None, "2025-01-01"))
    assert values(df, composite_key("a", "b", "d")) == ["v|r|2025-01-01", None]

"""Column expressions shared by every operator. All are built-in expressions: no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Timestamp layouts of the feeds.
UTC_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss['Z']"
LOCAL_LAYOUT = "yyyy-MM-dd HH:mm:ss"
# Business rules the published figures depend on.
WEEK_ORIGIN = "2025-01-01"
WEEK_DAYS = 7
LOCAL_OFFSET = (5, 30)
COLD_BAND = (2.0, 8.0)

MONEY = DecimalType(18, 4)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -----------------------------------------------------------------------------------


def parse_ts(c: Column | str, layout: str) -> Column:
    """Strict text → naive timestamp. Malformed text raises under ANSI mode."""
    return F.to_timestamp_ntz(_col(c).cast("string"), F.lit(layout))


def utc_text(c: Column | str) -> Column:
    """`2025-01-01T00:00:00Z` (the Z may be absent) → naive timestamp holding UTC."""
    return parse_ts(c, UTC_LAYOUT)


def shift_hours(ts: Column | str, hours: Column | int, minutes: int = 0) -> Column:
    """Move a timestamp by a constant or per-row number of hours (and minutes)."""
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return _col(ts) + F.make_dt_interval(F.lit(0), h.cast("int"), F.lit(minutes))


def local_time(ts_utc: Column | str, offset: tuple[int, int] = LOCAL_OFFSET) -> Column:
    """UTC → wall clock of a zone with a fixed offset (no daylight saving lookup)."""
    return shift_hours(ts_utc, offset[0], offset[1])


def local_date(ts_utc: Column | str, offset: tuple[int, int] = LOCAL_OFFSET) -> Column:
    return local_time(ts_utc, offset).cast("date")


def hours_since(start_date: Column | str, ts: Column | str) -> Column:
    """Whole hours from midnight of `start_date` to `ts`, floored (−30 min is −1)."""
    day = _col(start_date).cast("date").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", day, _col(ts)) / F.lit(3600))


def origin_bucket(d: Column | str, origin: str = WEEK_ORIGIN, days: int = WEEK_DAYS) -> Column:
    """First day of the fixed-width bucket that holds `d`; earlier dates floor downwards."""
    day = _col(d).cast("date")
    into = F.pmod(F.datediff(day, F.to_date(F.lit(origin))), F.lit(days))
    return F.date_sub(day, into)


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "MM")


def fiscal_attributes(d: Column | str, first_month: int = 4) -> dict[str, Column]:
    """Calendar attributes of a date for a fiscal year named after the year it ends in."""
    day = _col(d)
    month_no = F.pmod(F.month(day) - F.lit(first_month), F.lit(12)) + 1
    ends_in = F.year(F.add_months(day, 12 - (first_month - 1) % 12)) if first_month > 1 else F.year(day)
    return {
        "fiscal_year": F.concat(F.lit("FY"), F.lpad((ends_in % 100).cast("string"), 2, "0")),
        "fiscal_quarter": F.concat(F.lit("Q"), F.ceil(month_no / 3).cast("string")),
        "fiscal_month_no": month_no.cast("int"),
        "iso_week": F.weekofyear(day),
        "day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


# --- numbers --------------------------------------------------------------------------------


def round_to(c: Column | str, digits: int) -> Column:
    """Round a double by scaling it first, so a stored 1.005 (really 1.00499…) gives 1.0."""
    scale = F.lit(float(10**digits))
    return F.round(_col(c) * scale, 0) / scale


def exact_sum(c: Column | str) -> Column:
    """Order-independent sum of a money or unit column, returned as a double."""
    return F.sum(_col(c).cast(MONEY)).cast("double")


def exact_mean(c: Column | str) -> Column:
    return exact_sum(c) / F.count(_col(c))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as a double; NULL when the denominator is zero or missing."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return round_to(safe_ratio(num.cast("double") * F.lit(100.0), den), digits)


# --- readings -------------------------------------------------------------------------------


def stated_or_vendor_unit(unit: Column | str, vendor: Column | str,
                          fahrenheit_vendors: Sequence[str]) -> Column:
    """The stated C/F unit when there is one, else what the vendor is known to send."""
    stated = F.when(_col(unit).isin("C", "F"), _col(unit))
    known = F.when(_col(vendor).isin(*fahrenheit_vendors), F.lit("F")).otherwise(F.lit("C"))
    return F.coalesce(stated, known)


def to_celsius(value: Column | str, unit: Column | str) -> Column:
    v = _col(value)
    return F.when(_col(unit) == "F", (v - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)).otherwise(v)


def above_limit(value: Column | str, high: float = COLD_BAND[1]) -> Column:
    """Strictly above the limit; a missing reading is not an excursion."""
    return F.coalesce(_col(value) > F.lit(high), F.lit(False))


def outside_band(value: Column | str, band: tuple[float, float] = COLD_BAND) -> Column:
    return F.coalesce(~_col(value).between(F.lit(band[0]), F.lit(band[1])), F.lit(False))


def composite_key(*parts: Column | str, sep: str = "|") -> Column:
    """Parts joined by `sep`; any missing part makes the whole key missing."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)

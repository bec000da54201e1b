from .columns import (  # noqa: F401
    above_limit,
    composite_key,
    exact_mean,
    exact_sum,
    fiscal_attributes,
    hours_since,
    local_date,
    local_time,
    month_start,
    origin_bucket,
    outside_band,
    parse_ts,
    pct,
    round_to,
    safe_ratio,
    shift_hours,
    to_celsius,
    stated_or_vendor_unit,
    utc_text,
)

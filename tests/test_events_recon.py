import datetime as dt

from pyspark.sql import functions as F

from grainledger.operators import (
    coverage_grid,
    cycle_summary,
    event_vs_target,
    first_event_cycle,
    issue_list,
    key_rollup,
    manifest_recon,
    series_recon,
    value_by_source,
    volume_vs_mean,
)
from grainledger.operators.events import source_profile
from grainledger.plans import marts, staging


def d(i):
    return dt.date(2025, 1, i)


def test_key_rollup_counts_flags_and_missing_values(frame):
    df = frame(
        "k STRING, w STRING, v DOUBLE, hot BOOLEAN, out BOOLEAN",
        ("a", "W2", 9.0, True, True), ("a", "W1", None, False, False), ("a", None, 1.0, False, True), (None, "W1", 3.0, False, False),
    )
    got = key_rollup(df, ["k"], "v", {"hot": ("n_hot", "any_hot"), "out": ("n_out", "any_out")}, carry=["w"])
    rows = {r.k: tuple(r)[1:] for r in got.collect()}
    assert rows == {"a": ("W1", 3, 2, 1, 2, True, True), None: ("W1", 1, 1, 0, 0, False, False)}


def test_cycle_uses_first_events_in_order(frame):
    t = "2025-01-01 {:02d}:00:00".format
    df = frame(
        "o STRING, w STRING, e STRING, t TS",
        ("ok", "W", "RECEIVE", t(1)), ("ok", "W", "RECEIVE", t(2)), ("ok", "W", "DISPATCH", t(5)), ("ok", "W", "DISPATCH", t(9)),
        ("reversed", "W", "DISPATCH", t(1)), ("reversed", "W", "RECEIVE", t(2)),
        ("half", "W", "RECEIVE", t(1)), ("half", "W", "PICK", t(2)),
        ("same", "V", "RECEIVE", t(3)), ("same", "V", "DISPATCH", t(3)),
    )
    cycles = first_event_cycle(df, "o", "e", "t", "RECEIVE", "DISPATCH", carry=["w"])
    got = {r.o: (r.cycle_seconds, r.complete_journey, r.scan_count, r.stage_count) for r in cycles.collect()}
    assert got == {
        "ok": (4 * 3600, True, 4, 2), "reversed": (None, False, 2, 2), "half": (None, False, 2, 2), "same": (0, True, 2, 2),
    }
    summary = {r.w: tuple(r)[1:] for r in cycle_summary(cycles, "w").collect()}
    assert summary == {"W": (3, 1, 33.33, 14400.0), "V": (1, 1, 100.0, 0.0)}


def test_dispatch_against_the_requested_day(frame):
    orders = frame("o STRING, due DATE", ("none", "2025-01-02"), ("on", "2025-01-02"), ("late", "2025-01-02"))
    scans = frame(
        "o STRING, e STRING, t TS",
        ("on", "DISPATCH", "2025-01-02 23:59:59"), ("on", "DISPATCH", "2025-01-09 00:00:00"), ("late", "DISPATCH", "2025-01-03 00:00:00"),
        ("none", "RECEIVE", "2025-01-01 00:00:00"),
    )
    got = event_vs_target(orders, scans, "o", "e", "t", "DISPATCH", "due", ["due"])
    assert {r.o: (r.has_dispatch_scan, r.on_request_date, r.dispatch_date) for r in got.collect()} == {
        "none": (False, None, None), "on": (True, True, d(2)), "late": (True, False, d(3)),
    }


def test_value_by_source(frame):
    df = frame("s STRING, v DOUBLE", ("P", 108.5), ("P", 217.0), ("E", 10.0), ("E", 20.0), ("E", 60.0))
    assert {r[0]: tuple(r)[1:] for r in value_by_source(df, "s", "v", {"P": 1.085}).collect()} == {
        "P": (2, 325.5, 300.0, 162.75, 162.75), "E": (3, 90.0, 90.0, 30.0, 20.0),
    }
    assert {r[0]: tuple(r)[1:] for r in source_profile(df, "s", "v").collect()} == {"P": (2, 162.75, 162.75), "E": (3, 30.0, 20.0)}


def test_series_recon_keeps_one_sided_cells(frame):
    a = frame("k STRING, v DOUBLE", ("x", 1.1), ("x", 2.2), ("only-a", 5.0))
    b = frame("g STRING, n DOUBLE", ("x", 1.0), ("only-b", 7.0))
    got = series_recon({"a": (a, [F.col("k")], "v"), "b": (b, [F.col("g")], "n")}, ["k"], {"gap": ("a", "b")})
    assert {r.k: tuple(r)[1:] for r in got.collect()} == {"x": (3.3, 1.0, 2.3), "only-a": (5.0, None, None), "only-b": (None, 7.0, None)}


def pos_row(txn, event, ingest, price, channel="GT", qty=1):
    return (txn, 1, "B", "O", channel, "S", event, ingest, qty, None, "EA", price, 0.0, 0.0, "CASH", "f")


def raw_pos(frame, *rows):
    return frame(
        "txn_id STRING, txn_line_no INT, basket_id STRING, outlet_code STRING, channel STRING, sku_code STRING, event_ts STRING, "
        "ingest_date DATE, qty INT, quantity_units INT, uom STRING, unit_price DOUBLE, discount_amount DOUBLE, tax_amount DOUBLE, "
        "payment_mode STRING, source_file STRING",
        *rows,
    )


def test_finance_recon_splits_the_gap_by_cause(frame):
    raw = raw_pos(
        frame,
        pos_row("t1", "2025-01-07T10:00:00Z", "2025-01-07", 10.0),
        pos_row("late", "2025-01-07T10:00:00Z", "2025-01-08", 5.0),
        pos_row("dup", "2025-01-08T10:00:00Z", "2025-01-08", 7.0),
        pos_row("dup", "2025-01-08T10:00:00Z", "2025-01-09", 7.0),
        pos_row("edge", "2025-01-07T18:30:00Z", "2025-01-08", 1.0),
    )
    published = frame("week_ending DATE, channel STRING, gross_sales_inr DOUBLE", ("2025-01-01", "GT", 12.5), ("2025-01-01", "MT", 3.0))
    got = {(r.report_week, r.channel): r for r in marts.fct_finance_recon(raw, staging.stg_pos(raw), published).collect()}
    assert set(got) == {(d(1), "GT"), (d(8), "GT"), (d(1), "MT")}
    first, second, other = got[d(1), "GT"], got[d(8), "GT"], got[d(1), "MT"]
    assert (first.canonical_gross, first.legacy_gross, first.published_gross) == (15.0, 10.0, 12.5)
    assert (second.canonical_gross, second.legacy_gross, second.published_gross) == (8.0, 20.0, None)
    assert (second.impact_dedupe, second.impact_date_attribution) == (7.0, 5.0)
    assert (other.canonical_gross, other.canonical_minus_published, other.impact_dedupe) == (None, None, None)
    for r in (first, second):
        assert round(r.legacy_gross - r.canonical_gross, 2) == round(r.impact_dedupe + r.impact_date_attribution, 2)


def test_manifest_recon_shows_both_sides(frame):
    manifest = frame(
        "feed STRING, partition STRING, file_count INT, row_count BIGINT, bytes BIGINT",
        ("f", "dt=1", 1, 10, 1), ("f", "dt=2", 2, 20, 1), ("f", "dt=3", 1, 5, 1),
    )
    inventory = frame(
        "path STRING, feed STRING, partition STRING, bytes BIGINT, actual_rows BIGINT, read_status STRING, error STRING",
        ("a", "f", "dt=1", 1, 10, "OK", None), ("b", "f", "dt=2", 1, 10, "OK", None), ("c", "f", "dt=2", 1, None, "CORRUPT", "x"),
        ("e", "f", "dt=9", 1, 4, "OK", None),
    )
    got = {r.partition: tuple(r)[2:] for r in manifest_recon(manifest, inventory).collect()}
    assert got == {"dt=1": (1, 10, 1, 10, 0), "dt=2": (2, 20, 2, 10, 1), "dt=3": (1, 5, 0, 0, 0), "dt=9": (None, None, 1, 4, 0)}


def test_coverage_grid_and_expected_lists(frame):
    df = frame("g STRING, dt DATE", ("a", "2025-01-01"), ("a", "2025-01-01"), ("a", "2025-01-02"), ("b", "2025-01-03"), (None, "2025-01-03"))
    got = {(r.g, r.dt): (r.reading_count, r.is_missing) for r in coverage_grid(df, "g", "dt").collect()}
    assert len(got) == 9
    assert got["a", d(1)] == (2, False) and got["a", d(3)] == (0, True) and got["b", d(3)] == (1, False)
    assert all(got[None, d(i)] == (0, True) for i in (1, 2, 3))
    silent = frame("g STRING", ("z",), ("a",))
    days = frame("x DATE", ("2025-01-04",))
    wide = {(r.g, r.dt): r.is_missing for r in coverage_grid(df.where("g IS NOT NULL"), "g", "dt", silent, days).collect()}
    assert len(wide) == 12 and wide["z", d(1)] and wide["a", d(4)] and not wide["b", d(3)]


def test_volume_vs_mean(frame):
    df = frame("dt DATE", ("2025-01-01",), ("2025-01-01",), ("2025-01-02",))
    assert sorted(tuple(r) for r in volume_vs_mean(df, "dt").collect()) == [(d(1), 2, 1.5), (d(2), 1, 1.5)]


def test_issue_list_ignores_column_order(frame):
    a = frame("n INT, issue STRING, feed STRING, partition STRING, detail STRING", (1, "i", "f", "p", "x"))
    b = frame("issue STRING, feed STRING, partition STRING, detail STRING, n INT", ("j", "f", "p", "y", 1))
    assert {r.issue for r in issue_list(a, b).collect()} == {"i", "j"}


def reading(device, ts, dt_, value, unit="C", vendor="THERMLOG", fw="3.0", route="R1"):
    return (device, vendor, fw, "V" + device, route, "W", "G", ts, value, unit, dt_)


def test_telemetry_correction_dedupe_and_trips(frame):
    schema = (
        "device_id STRING, telemetry_vendor STRING, firmware_version STRING, vehicle_registration STRING, route_code STRING, "
        "warehouse_code STRING, gateway_id STRING, reading_ts STRING, temp_value DOUBLE, temp_unit STRING, dt DATE"
    )
    rows = [reading("x", f"2025-01-05T{h:02d}:00:00Z", "2025-01-05", 5.0) for h in (11, 12, 13)]
    rows += [reading("y", "2025-01-05T12:00:00Z", "2025-01-05", 5.0, fw="3.1")]
    rows += [reading("skew", f"2025-01-05T{h:02d}:00:00Z", "2025-01-05", 46.4, None, "COLDEYE", "2.1") for h in (16, 17, 19)]
    rows += [reading("skew", "2025-01-06T03:00:00Z", "2025-01-05", 50.0, None, "COLDEYE", "2.1")] * 2
    rows += [reading("n", "2025-01-05T12:00:00Z", "2025-01-06", None, fw=None), reading("n", "2025-01-05T12:00:00Z", "2025-01-05", None, fw=None)]
    raw = frame(schema, *rows)
    clock = staging.dq_firmware_clock(raw)
    offsets = {r.firmware_version: r.observed_offset_hours for r in clock.collect()}
    assert offsets["2.1"] == 7 and offsets["3.0"] == 0
    tel = staging.stg_telemetry(raw, clock)
    got = tel.collect()
    assert len(got) == 9
    skewed = [r for r in got if r.device_id == "skew" and r.reading_ts_raw.day == 6]
    assert len(skewed) == 1 and skewed[0].business_date == d(5) and skewed[0].temperature_c == 10.0 and skewed[0].above_limit_flag
    lost = [r for r in got if r.device_id == "n"]
    assert len(lost) == 1 and lost[0].partition_date == d(5) and lost[0].clock_offset_hours == 0 and not lost[0].outside_band_flag
    trips = {r.trip_key: r for r in marts.fct_cold_chain_trip(tel).collect()}
    t = trips["Vskew|R1|2025-01-05"]
    assert (t.reading_count, t.valid_readings, t.has_above_limit_excursion) == (4, 4, True)
    assert trips["Vn|R1|2025-01-05"].valid_readings == 0

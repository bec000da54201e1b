"""A small landing zone with planted defects, written the way the feeds are written."""

from __future__ import annotations

import csv
import os

import pyarrow as pa
import pyarrow.parquet as pq

DAYS = ("2025-09-29", "2025-09-30", "2025-10-01", "2025-10-02")


def write_part(root: str, feed: str, part: str, name: str, columns: dict) -> str:
    folder = os.path.join(root, feed, part)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{name}.parquet")
    pq.write_table(pa.table(columns), path, compression="zstd")
    return path


def write_csv(root: str, rel: str, rows: list[dict]) -> None:
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as handle:
        out = csv.DictWriter(handle, fieldnames=list(rows[0]))
        out.writeheader()
        out.writerows(rows)


def truncate(path: str) -> None:
    with open(path, "rb") as handle:
        data = handle.read()
    with open(path, "wb") as handle:
        handle.write(data[:-8])  # without the footer length and the closing mark


def break_page(path: str, group: int, column: int) -> None:
    """Overwrite the pages of one column of a row group; the footer stays whole."""
    chunk = pq.read_metadata(path).row_group(group).column(column)
    start = chunk.dictionary_page_offset or chunk.data_page_offset
    with open(path, "r+b") as handle:
        handle.seek(start)
        handle.write(b"\xff" * chunk.total_compressed_size)


def _pos(day: str, lines: list[tuple]) -> dict:
    """lines: (txn, line, outlet, channel, sku, event_ts, qty, uom, price)"""
    new = day >= "2025-10-01"
    n = len(lines)
    out = {
        "txn_id": [r[0] for r in lines],
        "txn_line_no": pa.array([r[1] for r in lines], pa.int16()),
        "basket_id": ["B" + r[0] for r in lines],
        "outlet_code": [r[2] for r in lines],
        "channel": [r[3] for r in lines],
        "sku_code": [r[4] for r in lines],
        "event_ts": [r[5] for r in lines],
        "quantity_units" if new else "qty": pa.array([r[6] for r in lines], pa.int32()),
        "unit_price": [float(r[8]) for r in lines],
        "discount_amount": [0.5] * n,
        "tax_amount": [0.1] * n,
        "payment_mode": ["UPI"] * n,
        "till_id": pa.array([1] * n, pa.int16()),
        "cashier_id": ["C1"] * n,
        "promo_code": pa.array([None] * n, pa.string()),
        "source_file": [f"pos_{day}.jsonl"] * n,
    }
    if new:
        out["uom"] = [r[7] for r in lines]
        out["loyalty_id"] = pa.array([None] * n, pa.string())
    return out


def _cdc(key: str, rows: list[tuple], attrs: dict) -> dict:
    """rows: (key, op, ts, seq, overrides)"""
    out = {key: [r[0] for r in rows]}
    for name, default in attrs.items():
        out[name] = [r[4].get(name, default) for r in rows]
    out["__op"] = [r[1] for r in rows]
    out["__op_ts"] = [r[2] for r in rows]
    out["__seq"] = pa.array([r[3] for r in rows], pa.int64())
    return out


def write_landing(root: str, corrupt: bool = True, manifest: bool = True) -> dict[str, str]:
    """Write everything; returns the paths a test may want to touch."""
    paths: dict[str, str] = {}
    raw = os.path.join(root, "raw")
    sales = {
        "2025-09-29": [("T1", 1, "O1", "GT", "S1", "2025-09-29T10:00:00Z", 2, None, 10.0)],
        "2025-09-30": [
            ("T2", 1, "O1", "GT", "S1", "2025-09-30T18:30:00Z", 1, None, 20.0),
            ("T1", 1, "O1", "GT", "S1", "2025-09-29T10:00:00Z", 2, None, 10.0),
        ],
        "2025-10-01": [
            ("T3", 1, "O1", "GT", "S1", "2025-10-01T05:00:00Z", 3, "EA", 5.0),
            ("T3", 2, "O2", "MT", "S2", "2025-10-01T05:00:00Z", 2, "CS", 7.0),
            ("T4", 1, "O9", "MT", "S3", "2025-10-01T06:00:00Z", 2, "CS", 1.5),
        ],
        "2025-10-02": [
            ("T3", 1, "O1", "GT", "S1", "2025-10-01T05:00:00Z", 3, "EA", 5.0),
            ("T5", 1, "O1", "GT", "S4", "2025-10-01T19:00:00Z", 4, "CS", 2.0),
        ],
    }
    for day, lines in sales.items():
        write_part(raw, "pos_transactions", f"ingest_date={day}", "part-00000", _pos(day, lines))

    gateways = {"G1": DAYS, "G2": (DAYS[0], DAYS[2], DAYS[3])}
    for day in DAYS:
        here = [g for g, days in gateways.items() if day in days for _ in range(2)]
        n = len(here)
        paths[day] = write_part(
            raw,
            "reefer_telemetry",
            f"dt={day}",
            "part-00000",
            {
                "device_id": [f"D{g}" for g in here],
                "telemetry_vendor": ["COLDEYE" if g == "G1" else "THERMLOG" for g in here],
                "firmware_version": ["3.0.2"] * n,
                "vehicle_registration": [f"V{g}" for g in here],
                "route_code": ["R1"] * n,
                "warehouse_code": ["WH1"] * n,
                "gateway_id": here,
                "reading_ts": [f"{day}T12:{i:02d}:00Z" for i in range(n)],
                "temp_value": [50.0 if g == "G1" else 4.0 for g in here],
                "temp_unit": pa.array(["F" if g == "G1" else None for g in here], pa.string()),
                "humidity_pct": [50.0] * n,
                "door_open_flag": pa.array([0] * n, pa.int8()),
                "gps_lat": [12.0] * n,
                "gps_lon": [77.0] * n,
                "battery_pct": [90.0] * n,
            },
        )
    paths["spare"] = write_part(
        raw,
        "reefer_telemetry",
        f"dt={DAYS[2]}",
        "part-00001",
        {k: v.slice(0, 1).to_pylist() if isinstance(v, pa.ChunkedArray) else v for k, v in
         {c: pq.read_table(paths[DAYS[2]], partitioning=None).column(c) for c in
          pq.read_schema(paths[DAYS[2]]).names}.items()} | {"reading_ts": [f"{DAYS[2]}T15:00:00Z"]},
    )

    scans = [
        ("SC1", "SO1", "RECEIVE", "2025-10-01 08:00:00"), ("SC2", "SO1", "DISPATCH", "2025-10-01 10:00:00"),
        ("SC3", "SO2", "DISPATCH", "2025-10-04 10:00:00"), ("SC4", "SO2", "PICK", "2025-10-01 10:00:00"),
    ]
    write_part(
        raw,
        "wms_scan_events",
        "dt=2025-10-01",
        "part-00000",
        {
            "scan_id": [s[0] for s in scans],
            "warehouse_code": ["WH1"] * 4,
            "event_type": [s[2] for s in scans],
            "order_number": [s[1] for s in scans],
            "sku_code": ["S1"] * 4,
            "batch_id": ["B"] * 4,
            "qty_cases": pa.array([1] * 4, pa.int16()),
            "pallet_id": ["P"] * 4,
            "dock_door": pa.array([1] * 4, pa.int8()),
            "operator_id": ["OP"] * 4,
            "handheld_device": ["H"] * 4,
            "event_ts": [s[3] for s in scans],
        },
    )
    outlet = {
        "outlet_name": "Outlet", "channel": "GT", "outlet_format": "F", "city": "Pune", "route_code": "R", "warehouse_code": "WH1",
        "credit_limit": 1000.0, "credit_terms_days": 7, "gst_number": "G", "status": "ACTIVE",
    }
    write_part(
        os.path.join(raw, "erp_cdc"), "outlet_master", "extract_date=2025-09-01", "part-00000",
        _cdc("outlet_code", [
            ("O1", "I", "2025-01-01T00:00:00Z", 1, {}),
            ("O1", "U", "2025-10-01T00:00:00Z", 3, {"channel": "ECOM"}),
            ("O2", "I", "2025-01-01T00:00:00Z", 2, {"channel": "HORECA"}),
        ], outlet),
    )
    product = {
        "product_name": "Product", "category": "Dairy", "brand": "B", "case_pack": 6, "mrp": 1.0, "list_price": 1.0,
        "gst_rate_pct": 5.0, "shelf_life_days": 10, "is_chilled": 1, "status": "ACTIVE",
    }
    write_part(
        os.path.join(raw, "erp_cdc"), "product_master", "extract_date=2025-09-01", "part-00000",
        _cdc("sku_code", [
            ("S1", "I", "2025-01-01T00:00:00Z", 1, {}), ("S2", "I", "2025-01-01T00:00:00Z", 2, {}),
            ("S3", "I", "2025-01-01T00:00:00Z", 3, {"case_pack": 10}), ("S4", "I", "2025-01-01T00:00:00Z", 4, {}),
            ("S4", "D", "2025-02-01T00:00:00Z", 5, {}),
        ], product),
    )
    order = {
        "outlet_code": "O1", "warehouse_code": "WH1", "route_code": "R", "order_date": "2025-10-01",
        "requested_delivery_date": "2025-10-03", "order_status": "NEW", "order_value_gross": 100.0, "discount_amount": 0.0,
        "tax_amount": 0.0, "source_system": "ERP_WEB",
    }
    changes = _cdc("order_number", [
        ("SO1", "I", "2025-10-01T00:00:00Z", 1, {}),
        ("SO1", "U", "2025-10-01T06:00:00Z", 2, {"order_status": "SHIPPED", "order_value_gross": 120.0}),
        ("SO2", "I", "2025-10-01T00:00:00Z", 3, {"source_system": "PARTNER_API", "order_value_gross": 217.0}),
        ("SO3", "I", "2025-10-01T00:00:00Z", 4, {}), ("SO3", "U", "2025-10-01T09:00:00Z", 5, {}),
        ("SO3", "D", "2025-10-01T00:00:00Z", 10_000_004, {}),
        ("SO4", "I", "2025-10-01T00:00:00Z", 6, {}),
    ], order)
    changes["line_count"] = pa.array([2] * len(changes["order_number"]), pa.int16())
    write_part(os.path.join(raw, "erp_cdc"), "sales_order_header", "extract_date=2025-10-01", "part-00000", changes)

    write_csv(root, "reference/uom_conversion.csv", [
        {"sku_code": s, "eaches_per_case": 6, "base_uom": "EA", "case_uom": "CS"} for s in ("S1", "S2")])
    write_csv(root, "reference/warehouse_master.csv", [
        {"warehouse_code": "WH1", "warehouse_name": "First", "city": "Pune", "region_name": "West", "timezone": "Asia/Kolkata", "chilled_capacity_pallets": 10}])
    write_csv(root, "reference/carrier_master.csv", [
        {"carrier_id": "C", "carrier_name": "N", "mode": "M", "sla_hours": 24, "rate_per_km": 1.5}])
    write_csv(root, "reference/fiscal_calendar.csv", [
        {"calendar_date": d, "fiscal_year": "FY26", "fiscal_quarter": "Q2" if d < "2025-10-01" else "Q3", "fiscal_month_no": 6 if d < "2025-10-01" else 7,
         "iso_week": 40, "day_of_week": "X", "is_weekend": 0} for d in (*DAYS, "2025-10-03")])
    write_csv(root, "reference/legacy_finance_weekly_report.csv", [
        {"week_ending": "2025-10-01", "channel": "GT", "gross_sales_inr": 50.25, "units_sold": 5, "basket_count": 2, "prepared_by": "P", "note": "As published, quoted"}])

    if manifest:
        rows = []
        for feed in ("pos_transactions", "reefer_telemetry", "wms_scan_events"):
            for part in sorted(os.listdir(os.path.join(raw, feed))):
                folder = os.path.join(raw, feed, part)
                files = [os.path.join(folder, f) for f in sorted(os.listdir(folder))]
                rows.append({
                    "feed": feed, "partition": part, "file_count": len(files),
                    "row_count": sum(pq.read_metadata(f).num_rows for f in files), "bytes": sum(os.path.getsize(f) for f in files)})
        rows.append({"feed": "wms_scan_events", "partition": "dt=2025-10-09", "file_count": 1, "row_count": 3, "bytes": 1})
        write_csv(root, "_manifest/expected_partitions.csv", rows)
    if corrupt:
        truncate(paths["spare"])
    return paths

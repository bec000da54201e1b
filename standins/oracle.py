"""The stand-in feeds and the library's tables as plain SQL, for checking the Spark results.

`CTES` maps a relation to the SQL that defines it; `sql(final)` prepends the ones a query needs.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def money(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def week(d: str) -> str:
    """First day of the 7-day bucket counted from 2025-01-01."""
    off = f"date_diff('day', DATE '2025-01-01', {d})"
    return f"CAST({d} - CAST((({off}) % 7 + 7) % 7 AS INTEGER) AS DATE)"


def ts(c: str) -> str:
    return f"strptime({c}, '%Y-%m-%dT%H:%M:%SZ')"


def text(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%dT%H:%M:%SZ')"


DELETED = "(l_returnflag = 'R' AND l_linestatus = 'F')"

CTES["raw_pos"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS txn_id, l_linenumber AS txn_line_no, 'B' || l_suppkey AS basket_id,
       'OUT' || o_custkey AS outlet_code, o_orderpriority AS channel, 'SKU' || l_partkey AS sku_code,
       {text("o_orderdate + l_linenumber * 4 * INTERVAL 1 HOUR")} AS event_ts,
       CAST(l_shipdate AS DATE) AS ingest_date,
       CASE l_linestatus WHEN 'F' THEN CAST(l_quantity AS INTEGER) END AS qty,
       CASE l_linestatus WHEN 'O' THEN CAST(l_quantity AS INTEGER) END AS quantity_units,
       CASE l_returnflag WHEN 'A' THEN 'EA' WHEN 'N' THEN 'CS' END AS uom,
       l_extendedprice AS unit_price, l_discount AS discount_amount, l_tax AS tax_amount,
       l_returnflag AS payment_mode, 'pos_' || l_linestatus || '.jsonl' AS source_file
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["raw_outlet"] = f"""
SELECT 'OUT' || o_custkey AS outlet_code, 'Outlet ' || o_custkey AS outlet_name, o_orderpriority AS channel,
       o_orderstatus AS outlet_format, 'City ' || o_orderstatus AS city, o_orderpriority AS route_code,
       'WH' || o_orderstatus AS warehouse_code, o_totalprice AS credit_limit, o_custkey AS credit_terms_days,
       'GST' || o_custkey AS gst_number, 'ACTIVE' AS status,
       CASE o_orderstatus WHEN 'P' THEN 'D' WHEN 'F' THEN 'I' ELSE 'U' END AS op,
       o_orderdate AS op_ts, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS extract_date
FROM orders"""

CTES["raw_product"] = f"""
SELECT 'SKU' || p_partkey AS sku_code, p_name AS product_name, p_type AS category, p_brand AS brand,
       CAST(l_quantity AS BIGINT) AS case_pack, p_retailprice AS mrp, l_extendedprice AS list_price,
       l_tax AS gst_rate_pct, CAST(p_size AS BIGINT) AS shelf_life_days,
       CAST(p_type = 'ECONOMY' AS BIGINT) AS is_chilled, l_linestatus AS status,
       CASE WHEN {DELETED} THEN 'D' ELSE 'U' END AS op, l_shipdate AS op_ts, l_orderkey AS seq
FROM lineitem JOIN part ON l_partkey = p_partkey"""

_HEADER = """'SO' || o_orderkey AS order_number, 'OUT' || o_custkey AS outlet_code,
       'WH' || o_orderstatus AS warehouse_code, o_orderpriority AS route_code,
       CAST(o_orderdate AS DATE) AS order_date, CAST(o_orderdate AS DATE) + 30 AS requested_delivery_date"""
_SOURCE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'PARTNER_API' ELSE o_orderpriority END AS source_system"
CTES["raw_orders"] = f"""
SELECT {_HEADER}, o_orderstatus AS order_status, 0 AS line_count, o_totalprice AS order_value_gross,
       CAST(0 AS DOUBLE) AS discount_amount, CAST(0 AS DOUBLE) AS tax_amount, {_SOURCE},
       'I' AS op, o_orderdate AS op_ts, CAST(0 AS BIGINT) AS seq
FROM orders
UNION ALL
SELECT {_HEADER}, l_linestatus, l_linenumber, l_extendedprice, l_discount, l_tax, {_SOURCE},
       CASE WHEN {DELETED} THEN 'D' ELSE 'U' END,
       CASE WHEN {DELETED} THEN o_orderdate ELSE l_shipdate END, CAST(l_linenumber AS BIGINT)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["deliveries"] = """
SELECT *, CAST(ts AS DATE) AS dt FROM events
UNION ALL
SELECT *, CAST(ts AS DATE) + 1 FROM events WHERE event_type = 'purchase'"""
CTES["raw_telemetry"] = f"""
SELECT 'DEV' || user_id AS device_id,
       CASE event_type WHEN 'error' THEN 'COLDEYE' ELSE 'THERMLOG' END AS telemetry_vendor,
       event_type AS firmware_version, 'VH' || user_id AS vehicle_registration, event_type AS route_code,
       'WH' || (user_id // 30) AS warehouse_code, 'GW' || user_id AS gateway_id,
       {text("CASE event_type WHEN 'error' THEN ts + INTERVAL 7 HOUR ELSE ts END")} AS reading_ts,
       CASE WHEN value >= 2 THEN CASE event_type WHEN 'error' THEN value ELSE value / 10e0 END END AS temp_value,
       CASE WHEN event_type = 'signup' OR value > 100 THEN NULL WHEN event_type = 'error' THEN 'F' ELSE 'C' END AS temp_unit,
       dt
FROM deliveries"""

CTES["raw_wms"] = """
SELECT 'SC' || l_orderkey || '-' || l_linenumber AS scan_id, 'WH' || s_nationkey AS warehouse_code,
       ['RECEIVE', 'PUTAWAY', 'PICK', 'PACK', 'STAGE', 'DISPATCH'][least(l_linenumber, 6)] AS event_type,
       'SO' || l_orderkey AS order_number, 'SKU' || l_partkey AS sku_code, 'BT' || l_returnflag AS batch_id,
       CAST(l_quantity AS SMALLINT) AS qty_cases, 'PL' || l_suppkey AS pallet_id,
       CAST(l_linenumber AS TINYINT) AS dock_door, 'OP' || l_linestatus AS operator_id,
       'HH' || l_returnflag AS handheld_device,
       l_shipdate + l_linenumber * INTERVAL 1 HOUR AS event_ts, CAST(l_shipdate AS DATE) AS dt
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""

CTES["uom_conversion"] = """
SELECT 'SKU' || p_partkey AS sku_code, p_size AS eaches_per_case FROM part WHERE p_type <> 'PROMO'"""

CTES["warehouse_master"] = """
SELECT 'WH' || n_nationkey AS warehouse_code, n_name AS warehouse_name, r_name AS region_name
FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["dim_date"] = f"""
WITH span AS (
  SELECT least((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT min(CAST(l_shipdate AS DATE) + 2) FROM lineitem)) AS a,
         greatest((SELECT max(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(l_shipdate AS DATE) + 2) FROM lineitem)) AS b),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT d AS calendar_date,
       'FY' || lpad(CAST((year(d) + CASE WHEN month(d) > 3 THEN 1 ELSE 0 END) % 100 AS VARCHAR), 2, '0') AS fiscal_year,
       'Q' || ((month(d) + 8) % 12 // 3 + 1) AS fiscal_quarter,
       CAST((month(d) + 8) % 12 + 1 AS INTEGER) AS fiscal_month_no,
       CAST(weekofyear(d) AS INTEGER) AS iso_week, dayname(d) AS day_of_week,
       CAST(isodow(d) > 5 AS INTEGER) AS is_weekend, {week("d")} AS report_week
FROM days"""

CTES["published"] = f"""
SELECT {week("CAST(o_orderdate AS DATE)")} AS report_week, o_orderpriority AS channel,
       round({money("o_totalprice")}, 2) AS published_gross
FROM orders GROUP BY 1, 2"""

CTES["ingest_manifest"] = """
SELECT 'reefer_telemetry' AS feed, 'dt=' || CAST(ts AS DATE) AS part, CAST(count(DISTINCT event_type) AS INTEGER) AS file_count, count(*) AS row_count
FROM events GROUP BY 2
UNION ALL
SELECT 'wms_scan_events', 'dt=' || CAST(l_shipdate AS DATE), CAST(count(DISTINCT l_linestatus) AS INTEGER), count(*) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'sales_order_header', 'dt=' || CAST(o_orderdate AS DATE), 1, count(*) FROM orders GROUP BY 2"""

CTES["file_inventory"] = """
WITH grouped AS (
  SELECT 'reefer_telemetry' AS feed, dt, firmware_version AS piece, count(*) AS n, count(*) AS kept,
         coalesce(max(temp_value) > 150, false) AS broken
  FROM raw_telemetry GROUP BY dt, firmware_version
  UNION ALL
  SELECT 'wms_scan_events', dt, operator_id, count(*), count(*) FILTER (batch_id <> 'BTR'), false
  FROM raw_wms GROUP BY dt, operator_id)
SELECT 'raw/' || feed || '/dt=' || dt || '/part-' || piece || '.parquet' AS path, feed, 'dt=' || dt AS part,
       n * 100 AS bytes, CASE WHEN NOT broken THEN kept END AS actual_rows,
       CASE WHEN broken THEN 'CORRUPT' ELSE 'OK' END AS read_status,
       CASE WHEN broken THEN 'footer is unreadable' END AS error
FROM grouped"""

# --- library tables -------------------------------------------------------------------------

CTES["pos_lines"] = f"""
SELECT txn_id, txn_line_no, basket_id, outlet_code, channel AS till_channel, sku_code,
       {ts("event_ts")} AS event_ts_utc, ingest_date, CAST(coalesce(qty, quantity_units) AS DOUBLE) AS qty, uom,
       unit_price, discount_amount, tax_amount, payment_mode, source_file
FROM raw_pos"""

CTES["stg_pos"] = """
SELECT *, event_ts_utc + INTERVAL 330 MINUTE AS event_ts_ist,
       CAST(event_ts_utc + INTERVAL 330 MINUTE AS DATE) AS business_date, qty * unit_price AS gross_sales_inr
FROM pos_lines
QUALIFY row_number() OVER (
  PARTITION BY txn_id, txn_line_no
  ORDER BY ingest_date, event_ts_utc, basket_id, outlet_code, till_channel, sku_code, qty, uom NULLS LAST, unit_price,
           discount_amount, tax_amount, payment_mode, source_file) = 1"""

CTES["firmware_clock"] = """
WITH per_fleet AS (
  SELECT firmware_version,
         median(CAST(floor(epoch(strptime(reading_ts, '%Y-%m-%dT%H:%M:%SZ') - CAST(dt AS TIMESTAMP)) / 3600) AS BIGINT)) AS med_h,
         count(*) AS n
  FROM raw_telemetry GROUP BY firmware_version),
against AS (
  SELECT *, (SELECT median(med_h) FROM per_fleet) AS baseline_h FROM per_fleet),
rounded AS (SELECT *, CAST(round(med_h - baseline_h) AS INTEGER) AS raw_offset_hours FROM against)
SELECT *, CASE WHEN abs(raw_offset_hours) > 1 THEN raw_offset_hours ELSE 0 END AS observed_offset_hours FROM rounded"""

CTES["stg_telemetry"] = f"""
WITH typed AS (
  SELECT *, {ts("reading_ts")} AS reading_ts_raw,
         coalesce(temp_unit, CASE telemetry_vendor WHEN 'COLDEYE' THEN 'F' ELSE 'C' END) AS temp_unit_inferred
  FROM raw_telemetry),
celsius AS (
  SELECT *, CASE temp_unit_inferred WHEN 'F' THEN (temp_value - 32e0) * 5e0 / 9e0 ELSE temp_value END AS temperature_c FROM typed),
once AS (
  SELECT * FROM celsius
  QUALIFY row_number() OVER (PARTITION BY device_id, reading_ts_raw, round(temperature_c, 4), gateway_id, route_code, vehicle_registration
                             ORDER BY dt, telemetry_vendor, firmware_version, warehouse_code, temp_unit_inferred, temperature_c NULLS LAST) = 1),
clocked AS (
  SELECT o.*, coalesce(f.observed_offset_hours, 0) AS clock_offset_hours,
         reading_ts_raw - coalesce(f.observed_offset_hours, 0) * INTERVAL 1 HOUR AS reading_ts_corrected
  FROM once o LEFT JOIN firmware_clock f ON o.firmware_version = f.firmware_version)
SELECT device_id, telemetry_vendor, firmware_version, vehicle_registration, route_code, warehouse_code, gateway_id,
       reading_ts_raw, dt AS partition_date, clock_offset_hours, temp_unit_inferred, reading_ts_corrected,
       CAST(reading_ts_corrected AS DATE) AS business_date, temperature_c,
       coalesce(temperature_c > 8, false) AS above_limit_flag,
       coalesce(temperature_c < 2 OR temperature_c > 8, false) AS outside_band_flag,
       vehicle_registration || '|' || route_code || '|' || CAST(reading_ts_corrected AS DATE) AS trip_key
FROM clocked"""

CTES["outlet_versions"] = """
WITH stream AS (
  SELECT *, op_ts AS valid_from,
         coalesce(lead(op_ts) OVER (PARTITION BY outlet_code ORDER BY op_ts, seq), TIMESTAMP '9999-12-31') AS valid_to
  FROM raw_outlet)
SELECT outlet_code, outlet_name, channel, outlet_format, city, route_code, warehouse_code, credit_limit,
       credit_terms_days, gst_number, status, op AS __op, seq AS __seq, extract_date, valid_from, valid_to
FROM stream WHERE op <> 'D' AND valid_to > valid_from"""

CTES["dim_product"] = """
WITH newest AS (
  SELECT * FROM raw_product
  QUALIFY row_number() OVER (PARTITION BY sku_code ORDER BY op_ts DESC, seq DESC, product_name DESC, category DESC, brand DESC,
    case_pack DESC, mrp DESC, list_price DESC, gst_rate_pct DESC, shelf_life_days DESC, is_chilled DESC, status DESC, op DESC) = 1)
SELECT sku_code, product_name, category, brand, case_pack, mrp, list_price, gst_rate_pct, shelf_life_days, is_chilled, status
FROM newest WHERE op = 'U'"""

CTES["dead_orders"] = """
SELECT order_number FROM raw_orders GROUP BY order_number HAVING max(seq) = max(seq) FILTER (op = 'D')"""

CTES["stg_orders"] = """
SELECT order_number, outlet_code, warehouse_code, route_code, order_date, requested_delivery_date, order_status, line_count,
       order_value_gross, discount_amount, tax_amount, source_system, op_ts
FROM raw_orders ANTI JOIN dead_orders USING (order_number)
WHERE op <> 'D'
QUALIFY row_number() OVER (PARTITION BY order_number ORDER BY op_ts DESC, seq DESC, outlet_code DESC, warehouse_code DESC,
  route_code DESC, order_date DESC, requested_delivery_date DESC, order_status DESC, line_count DESC, order_value_gross DESC,
  discount_amount DESC, tax_amount DESC, source_system DESC, op DESC) = 1"""

CTES["order_source_profile"] = f"""
SELECT source_system, count(*) AS orders, round({money("order_value_gross")} / count(order_value_gross), 2) AS mean_gross,
       round(median(order_value_gross), 2) AS median_gross
FROM stg_orders GROUP BY source_system"""

CTES["order_source"] = f"""
SELECT source_system, count(*) AS orders, round({money("order_value_gross")}, 2) AS order_value_gross,
       round({money("order_value_gross")} / CASE source_system WHEN 'PARTNER_API' THEN 1.085e0 ELSE 1e0 END, 2) AS order_value_ex_suspected_freight,
       round({money("order_value_gross")} / count(order_value_gross), 2) AS mean_gross,
       round(median(order_value_gross), 2) AS median_gross
FROM stg_orders GROUP BY source_system"""

CTES["pos_line"] = """
SELECT p.txn_id, p.txn_line_no, p.basket_id, p.outlet_code, p.till_channel, v.channel AS outlet_channel_asof, v.outlet_name,
       v.city AS outlet_city, v.warehouse_code AS outlet_warehouse, p.sku_code, m.product_name, m.category, p.event_ts_utc,
       p.event_ts_ist, p.business_date, p.ingest_date, p.qty, p.uom, p.unit_price, p.discount_amount, p.tax_amount,
       p.gross_sales_inr, p.payment_mode, p.source_file, m.case_pack, u.eaches_per_case,
       CASE WHEN k.per_unit IS NULL THEN 'UNKNOWN' ELSE 'CONVERTED' END AS conversion_status,
       CASE WHEN k.per_unit IS NULL THEN 'UNKNOWN' WHEN p.uom = 'CS' AND u.eaches_per_case IS NULL THEN 'CDC_CASE_PACK'
            ELSE 'UOM_REFERENCE' END AS conversion_source,
       p.qty * k.per_unit AS eaches
FROM stg_pos p
LEFT JOIN outlet_versions v ON v.outlet_code = p.outlet_code AND p.event_ts_utc >= v.valid_from AND p.event_ts_utc < v.valid_to
LEFT JOIN dim_product m ON m.sku_code = p.sku_code
LEFT JOIN uom_conversion u ON u.sku_code = p.sku_code,
LATERAL (SELECT CASE p.uom WHEN 'EA' THEN 1 WHEN 'CS' THEN coalesce(u.eaches_per_case, m.case_pack) END AS per_unit) k"""

CTES["sales_daily"] = f"""
WITH daily AS (
  SELECT business_date, till_channel, outlet_channel_asof, count(*) AS line_count, count(DISTINCT basket_id) AS basket_count,
         round({money("gross_sales_inr")}, 2) AS gross_sales_inr, round({money("discount_amount")}, 2) AS discount_inr,
         round({money("eaches")}, 2) AS units_eaches,
         count(*) FILTER (conversion_status = 'UNKNOWN') AS units_unknown_lines
  FROM pos_line GROUP BY ALL)
SELECT business_date, fiscal_year, fiscal_quarter, fiscal_month_no, report_week, daily.* EXCLUDE (business_date)
FROM daily LEFT JOIN dim_date ON calendar_date = business_date"""

CTES["finance_recon"] = f"""
WITH c AS (SELECT {week("business_date")} AS report_week, till_channel AS channel, round({money("gross_sales_inr")}, 2) AS canonical_gross FROM stg_pos GROUP BY 1, 2),
l AS (SELECT {week("ingest_date")} AS report_week, till_channel AS channel, round({money("qty * unit_price")}, 2) AS legacy_gross FROM pos_lines GROUP BY 1, 2),
i AS (SELECT {week("ingest_date")} AS report_week, till_channel AS channel, round({money("gross_sales_inr")}, 2) AS once_gross FROM stg_pos GROUP BY 1, 2)
SELECT report_week, channel, canonical_gross, legacy_gross, published_gross,
       round(canonical_gross - legacy_gross, 2) AS canonical_minus_legacy,
       round(legacy_gross - published_gross, 2) AS legacy_minus_published,
       round(canonical_gross - published_gross, 2) AS canonical_minus_published,
       round(legacy_gross - once_gross, 2) AS impact_dedupe,
       round(once_gross - canonical_gross, 2) AS impact_date_attribution
FROM c FULL JOIN l USING (report_week, channel) FULL JOIN i USING (report_week, channel)
FULL JOIN published USING (report_week, channel)"""

CTES["trips"] = """
SELECT trip_key, vehicle_registration, route_code, business_date, min(warehouse_code) AS warehouse_code,
       min(telemetry_vendor) AS telemetry_vendor, count(*) AS reading_count, count(temperature_c) AS valid_readings,
       count(*) FILTER (above_limit_flag) AS above_limit_readings, count(*) FILTER (outside_band_flag) AS outside_band_readings,
       bool_or(above_limit_flag) AS has_above_limit_excursion, bool_or(outside_band_flag) AS has_outside_band_excursion
FROM stg_telemetry GROUP BY ALL"""

CTES["cycles"] = """
WITH firsts AS (
  SELECT order_number, min(warehouse_code) AS warehouse_code, min(event_ts) FILTER (event_type = 'RECEIVE') AS receive_ts,
         min(event_ts) FILTER (event_type = 'DISPATCH') AS dispatch_ts, count(*) AS scan_count,
         count(DISTINCT event_type) AS stage_count
  FROM raw_wms GROUP BY order_number)
SELECT *, CASE WHEN dispatch_ts >= receive_ts THEN date_diff('second', receive_ts, dispatch_ts) END AS cycle_seconds,
       coalesce(dispatch_ts >= receive_ts, false) AS complete_journey
FROM firsts"""

CTES["cycle_by_warehouse"] = """
SELECT warehouse_code, count(*) AS orders_with_scans, count(*) FILTER (complete_journey) AS complete_journeys,
       round(count(*) FILTER (complete_journey) * 100e0 / count(*), 2) AS coverage_pct,
       median(cycle_seconds) FILTER (complete_journey) AS median_cycle_seconds
FROM cycles GROUP BY warehouse_code"""

CTES["channel_changes"] = """
SELECT n.outlet_code, n.valid_from AS changed_at, o.channel AS channel_from, n.channel AS channel_to, o.outlet_name
FROM outlet_versions n JOIN outlet_versions o ON o.outlet_code = n.outlet_code AND o.valid_to = n.valid_from
WHERE n.channel IS DISTINCT FROM o.channel"""

CTES["partition_recon"] = """
WITH seen AS (
  SELECT feed, part, count(*) AS files, CAST(coalesce(sum(actual_rows) FILTER (read_status = 'OK'), 0) AS BIGINT) AS good,
         count(*) FILTER (read_status <> 'OK') AS bad
  FROM file_inventory GROUP BY feed, part)
SELECT feed, part AS "partition", file_count AS manifest_files, row_count AS manifest_rows,
       coalesce(files, 0) AS observed_files, coalesce(good, 0) AS observed_rows_ok, coalesce(bad, 0) AS corrupt_files
FROM seen FULL JOIN ingest_manifest USING (feed, part)"""

CTES["gateway_grid"] = """
SELECT gateway_id, dt, coalesce(n, 0) AS reading_count, n IS NULL AS is_missing
FROM (SELECT DISTINCT gateway_id FROM raw_telemetry) CROSS JOIN (SELECT DISTINCT dt FROM raw_telemetry)
LEFT JOIN (SELECT gateway_id, dt, count(*) AS n FROM raw_telemetry GROUP BY ALL) USING (gateway_id, dt)"""

CTES["dispatch"] = """
SELECT order_number, requested_delivery_date, order_status, source_system, warehouse_code, dispatch_ts,
       CAST(dispatch_ts AS DATE) AS dispatch_date, dispatch_ts IS NOT NULL AS has_dispatch_scan,
       CAST(dispatch_ts AS DATE) <= requested_delivery_date AS on_request_date
FROM stg_orders LEFT JOIN (
  SELECT order_number, min(event_ts) AS dispatch_ts FROM raw_wms WHERE event_type = 'DISPATCH' GROUP BY 1) USING (order_number)"""


def _needed(body: str, found: list[str]) -> list[str]:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", body):
            _needed(CTES[name], found)
            if name not in found:
                found.append(name)
    return found


def sql(final: str) -> str:
    """`final` with the definitions it needs in front."""
    names = _needed(final, [])
    if not names:
        return final
    defined = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    if final.startswith("WITH "):
        return f"WITH {defined},\n{final.removeprefix('WITH ')}"
    return f"WITH {defined}\n{final}"

import datetime as dt
import glob
import os
import shutil
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from grainledger.plans import checks, marts
from grainledger.plans.catalogue import METRICS, QUESTIONS, list_metrics, list_questions, run_metric, run_sql
from grainledger.plans.runs import DEGRADED, FAILED, SUCCESS, gate
from grainledger.plans.warehouse import TABLES, build_warehouse, check_scans, is_published, open_warehouse
from grainledger.sources import FEEDS, affected_partitions, file_inventory, read_manifest, read_reference, scan_feed, scan_files
from grainledger.sources.inventory import cut_off, path_exists
from grainledger.sources.tables import try_read, write_table
from landing import truncate, write_landing


def folders(root):
    return {f.name: f"{root}/{f.path}" for f in FEEDS.values()}


@pytest.fixture(scope="module")
def degraded(spark, tmp_path_factory):
    root, out = str(tmp_path_factory.mktemp("landing")), str(tmp_path_factory.mktemp("out"))
    write_landing(root)
    run = build_warehouse(spark, root, out, allow_degraded=True)
    return root, out, run


@pytest.fixture
def views(spark, degraded):
    return open_warehouse(spark, degraded[1])


def test_inventory_registers_the_truncated_file(spark, scratch):
    write_landing(scratch)
    inventory = file_inventory(spark, folders(scratch)).cache()
    bad = affected_partitions(inventory).collect()
    assert [(r.feed, r.partition) for r in bad] == [("reefer_telemetry", "dt=2025-10-01")]
    assert bad[0].actual_rows is None and 0 < len(bad[0].error) <= 500 and bad[0].bytes > 0
    assert inventory.where("read_status = 'OK'").count() == 4 + 4 + 1 + 1 + 1 + 1
    assert gate(inventory) == (FAILED, 1)
    assert gate(inventory, allow_degraded=True)[0] == DEGRADED


def test_absent_feeds_are_skipped_and_nothing_at_all_is_an_error(spark, scratch):
    os.makedirs(f"{scratch}/raw/pos_transactions")
    inventory = file_inventory(spark, folders(scratch))
    assert inventory.count() == 0
    with pytest.raises(FileNotFoundError):
        gate(inventory)


def test_scan_feed_reads_around_the_bad_file_and_unifies_drift(spark, scratch):
    write_landing(scratch)
    inventory = file_inventory(spark, folders(scratch))
    telemetry = scan_feed(spark, scratch, FEEDS["reefer_telemetry"], inventory)
    assert telemetry.count() == 14 and telemetry.agg({"temp_value": "sum"}).first()[0] == 8 * 50.0 + 6 * 4.0
    pos = scan_feed(spark, scratch, FEEDS["pos_transactions"], inventory)
    assert dict(pos.dtypes)["ingest_date"] == "date"
    filled = checks.drift_fill(pos).first()
    assert tuple(filled) == (3, 5)
    assert {r.uom for r in pos.where("qty IS NOT NULL").collect()} == {None}


def test_scan_feed_prunes_partitions(spark, scratch):
    write_landing(scratch)
    inventory = file_inventory(spark, folders(scratch))
    one = scan_feed(spark, scratch, FEEDS["reefer_telemetry"], inventory).where("dt = DATE '2025-09-30'").select("device_id")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text and "ReadSchema: struct<device_id:string>" in text
    assert one.count() == 2


def test_bad_file_without_exclusion_fails_loudly(spark, scratch):
    paths = write_landing(scratch)
    with pytest.raises(Exception, match="FAILED_READ_FILE|is not a Parquet file|footer"):
        spark.read.schema(FEEDS["reefer_telemetry"].schema).parquet(f"{scratch}/raw/reefer_telemetry").agg({"temp_value": "sum"}).collect()
    assert os.path.exists(paths["spare"])


def test_scan_files_union_by_name_and_empty_list(spark, scratch):
    write_landing(scratch, corrupt=False)
    root = f"{scratch}/raw/pos_transactions"
    files = [f"{root}/ingest_date={d}/part-00000.parquet" for d in ("2025-09-30", "2025-10-01")]
    df = scan_files(spark, files, root=root, union_by_name=True)
    assert {"qty", "quantity_units", "uom", "ingest_date"} <= set(df.columns) and df.count() == 5
    assert df.where("qty IS NULL AND uom IS NOT NULL").count() == 3
    with pytest.raises(FileNotFoundError):
        scan_files(spark, [])


def test_feed_with_only_bad_files_is_an_error(spark, scratch):
    write_landing(scratch, corrupt=False)
    truncate(f"{scratch}/raw/wms_scan_events/dt=2025-10-01/part-00000.parquet")
    inventory = file_inventory(spark, folders(scratch))
    with pytest.raises(FileNotFoundError):
        scan_feed(spark, scratch, FEEDS["wms_scan_events"], inventory)


def test_a_late_file_belongs_to_the_next_run(spark, scratch):
    write_landing(scratch, corrupt=False)
    before = cut_off()
    inventory = file_inventory(spark, folders(scratch), before).cache()
    rows = inventory.where("feed = 'reefer_telemetry'").agg({"actual_rows": "sum"}).first()[0]
    source = f"{scratch}/raw/reefer_telemetry/dt=2025-09-30/part-00000.parquet"
    late = f"{scratch}/raw/reefer_telemetry/dt=2025-09-30/late.parquet"
    shutil.copy(source, late)
    os.utime(late, (time.time() + 60, time.time() + 60))
    scanned = scan_feed(spark, scratch, FEEDS["reefer_telemetry"], inventory, before)
    assert scanned.count() == rows
    check_scans({"reefer_telemetry": scanned}, inventory)
    with pytest.raises(RuntimeError, match="reefer_telemetry"):
        check_scans({"reefer_telemetry": scan_feed(spark, scratch, FEEDS["reefer_telemetry"], inventory)}, inventory)


def test_repeated_factors_are_refused(spark, scratch):
    write_landing(scratch, corrupt=False)
    with open(f"{scratch}/reference/uom_conversion.csv") as handle:
        last = handle.readlines()[-1]
    with open(f"{scratch}/reference/uom_conversion.csv", "a") as handle:
        handle.write(last)
    with pytest.raises(Exception, match="uom_conversion repeats sku_code"):
        build_warehouse(spark, scratch, f"{scratch}/warehouse")


def test_missing_is_told_from_unreadable(spark, scratch):
    assert try_read(spark, f"{scratch}/nothing") is None and not path_exists(spark, f"{scratch}/nothing")
    os.makedirs(f"{scratch}/broken")
    with open(f"{scratch}/broken/part-0.parquet", "w") as handle:
        handle.write("not parquet")
    with pytest.raises(Exception):
        try_read(spark, f"{scratch}/broken")
    empty = spark.createDataFrame([], "x INT, day DATE")
    write_table(empty, f"{scratch}/empty", "day")
    assert try_read(spark, f"{scratch}/empty").count() == 0


def test_references_and_manifest(spark, scratch):
    write_landing(scratch, corrupt=False, manifest=False)
    assert read_manifest(spark, scratch).count() == 0
    assert [c for c, _ in read_manifest(spark, scratch).dtypes] == ["feed", "partition", "file_count", "row_count", "bytes"]
    report = read_reference(spark, scratch, "legacy_finance_weekly_report").first()
    assert report.week_ending == dt.date(2025, 10, 1) and report.note == "As published, quoted"
    with pytest.raises(FileNotFoundError):
        read_reference(spark, f"{scratch}/nowhere", "uom_conversion")
    with open(f"{scratch}/reference/uom_conversion.csv", "a") as handle:
        handle.write("S9,many,EA,CS\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ_FILE"):
        read_reference(spark, scratch, "uom_conversion").collect()


def test_gate_fails_and_publishes_only_the_findings(spark, scratch):
    write_landing(f"{scratch}/in")
    run = build_warehouse(spark, f"{scratch}/in", f"{scratch}/out")
    assert (run.status, run.bad_file_count, run.warning_count, run.source_row_count) == (FAILED, 1, 1, None)
    latest = open_warehouse(spark, f"{scratch}/out")
    assert latest.first().status == FAILED and not is_published(latest)
    assert spark.table("file_inventory").where("read_status = 'CORRUPT'").count() == 1
    assert not spark.catalog.tableExists("fct_pos_line")


def test_failed_run_hides_the_tables_of_an_earlier_one(spark, scratch):
    paths = write_landing(f"{scratch}/in", corrupt=False)
    assert build_warehouse(spark, f"{scratch}/in", f"{scratch}/out").status == SUCCESS
    open_warehouse(spark, f"{scratch}/out")
    assert spark.table("fct_pos_line").count() == 6
    truncate(paths["spare"])
    assert build_warehouse(spark, f"{scratch}/in", f"{scratch}/out").status == FAILED
    assert open_warehouse(spark, f"{scratch}/out").count() == 1
    assert not spark.catalog.tableExists("fct_pos_line")
    assert spark.read.parquet(f"{scratch}/out/pipeline_run").count() == 2


def test_an_undeclared_rename_degrades_the_run(spark, scratch):
    write_landing(f"{scratch}/in", corrupt=False)
    folder = f"{scratch}/in/raw/pos_transactions/ingest_date=2025-10-02"
    path = f"{folder}/part-00000.parquet"
    renamed = pq.read_table(path, partitioning=None).rename_columns(columns_with(path, {"uom": "unit_of_measure"}))
    pq.write_table(renamed, path)
    run = build_warehouse(spark, f"{scratch}/in", f"{scratch}/out")
    assert run.status == DEGRADED and "pos_transactions.unit_of_measure" in run.message and run.bad_file_count == 0
    open_warehouse(spark, f"{scratch}/out")
    found = {(r.feed, r.column): r for r in spark.table("dq_column_drift").collect()}
    row = found["pos_transactions", "unit_of_measure"]
    assert (row.finding, row.files, row.first_partition) == ("UNDECLARED", 1, "ingest_date=2025-10-02")
    assert {r.finding for k, r in found.items() if k != ("pos_transactions", "unit_of_measure")} <= {"ABSENT"}
    assert run.canonical_row_count == spark.table("fct_pos_line").count() == 6


def columns_with(path, names):
    return [names.get(c, c) for c in pq.read_schema(path).names]


def test_feeds_without_rows(spark, scratch):
    write_landing(f"{scratch}/in", corrupt=False)
    for path in glob.glob(f"{scratch}/in/raw/pos_transactions/*/*.parquet"):
        pq.write_table(pq.read_table(path, partitioning=None).slice(0, 0), path)
    run = build_warehouse(spark, f"{scratch}/in", f"{scratch}/out")
    assert (run.status, run.source_row_count, run.canonical_row_count) == (SUCCESS, 0, 0)


def test_opening_nothing_is_an_error(spark, scratch):
    with pytest.raises(FileNotFoundError):
        open_warehouse(spark, f"{scratch}/none")


def test_degraded_run_record(degraded):
    run = degraded[2]
    assert (run.status, run.source_row_count, run.canonical_row_count, run.duplicate_count) == (DEGRADED, 8, 6, 2)
    assert (run.bad_file_count, run.warning_count) == (1, 2)
    assert "dq_affected_partitions" in run.message and run.finished_at >= run.started_at


def test_all_tables_are_written(spark, views):
    for name in TABLES:
        assert spark.catalog.tableExists(name), name


def test_pos_lines_of_the_warehouse(spark, views):
    rows = {(r.txn_id, r.txn_line_no): r for r in spark.table("fct_pos_line").collect()}
    assert len(rows) == 6
    assert rows["T1", 1].ingest_date == dt.date(2025, 9, 29) and rows["T1", 1].conversion_status == "UNKNOWN"
    assert rows["T2", 1].business_date == dt.date(2025, 10, 1) and rows["T2", 1].outlet_channel_asof == "GT"
    assert rows["T3", 1].outlet_channel_asof == "ECOM" and rows["T3", 1].eaches == 3.0
    assert (rows["T3", 2].eaches, rows["T3", 2].conversion_source) == (12.0, "UOM_REFERENCE")
    assert (rows["T4", 1].eaches, rows["T4", 1].conversion_source) == (20.0, "CDC_CASE_PACK")
    assert rows["T4", 1].outlet_channel_asof is None and rows["T5", 1].eaches is None


def test_invariants_on_the_warehouse(spark, views):
    t = spark.table
    assert checks.duplicate_keys(t("fct_pos_line"), ["txn_id", "txn_line_no"]).count() == 0
    assert tuple(checks.conversion_violations(t("fct_pos_line")).first()) == (0, 0)
    assert tuple(checks.scd2_violations(t("dim_outlet_scd2"), t("fct_outlet_channel_change")).first()) == (0, 0)
    assert {r.order_number for r in t("stg_orders").collect()} == {"SO1", "SO2", "SO4"}
    agreement = checks.median_agreement(t("stg_telemetry"), ("COLDEYE", "THERMLOG"), tolerance=7).first()
    assert (agreement.first_median, agreement.second_median, agreement.agree, agreement.implausible) == (10.0, 4.0, True, 0)
    compared = checks.asof_vs_current(t("fct_pos_line"), t("dim_outlet_scd2")).first()
    assert tuple(compared) == (5, 2)
    assert [tuple(r) for r in t("dq_missing_gateway_days").collect()] == [("G2", dt.date(2025, 9, 30), 0)]
    assert [tuple(r) for r in checks.gap_ranges(t("dq_missing_gateway_days")).collect()] == [
        ("G2", dt.date(2025, 9, 30), dt.date(2025, 9, 30), 1)
    ]


def test_every_question_runs_on_the_warehouse(spark, views):
    params = {"fy": "FY26", "quarter": "Q3", "week": "2025-10-01", "channel": "GT"}
    for q in QUESTIONS.values():
        answer = run_metric(spark, q.id, **{p: params[p] for p in q.params})
        rows = answer.rows.collect()
        assert rows and answer.sql == q.sql.strip() and answer.source == q.source
        assert answer.run.first().status == DEGRADED


def test_question_values(spark, views):
    ask = lambda q, **p: [tuple(r) for r in run_metric(spark, q, **p).rows.collect()]
    assert ask("q01_gross_sales_by_channel", fy="FY26", quarter="Q3") == [
        ("FY26", "Q3", "ECOM", 23.0, 2), ("FY26", "Q3", "GT", 20.0, 1), ("FY26", "Q3", "HORECA", 14.0, 1), ("FY26", "Q3", "MT", 3.0, 1)
    ]
    assert ask("q03_units_eaches") == [
        (dt.date(2025, 10, 1), "ECOM", 3.0, 1), (dt.date(2025, 10, 1), "HORECA", 12.0, 1), (dt.date(2025, 10, 1), "MT", 20.0, 1)
    ]
    assert ask("q05_wms_cycle_time") == [("WH1", "First", "West", 2, 1, 50.0, 7200.0, 2.0)]
    assert ask("q06_outlet_channel_changes") == [("O1", "Outlet", dt.datetime(2025, 10, 1), "GT", "ECOM")]
    assert ask("q07_order_source") == [
        ("ERP_WEB", 2, 220.0, 220.0, 110.0, 110.0, 110.0), ("PARTNER_API", 1, 217.0, 200.0, 217.0, 217.0, 217.0)
    ]
    assert ask("q10_dispatch_proxy") == [(3, 2, 66.67, 1, 50.0)]
    issues = ask("q08_missing_days")
    assert [r[:3] for r in issues] == [
        ("corrupt_file", "reefer_telemetry", "dt=2025-10-01"),
        ("manifest_row_mismatch", "reefer_telemetry", "dt=2025-10-01"),
        ("manifest_row_mismatch", "wms_scan_events", "dt=2025-10-09"),
        ("missing_gateway_day", "reefer_telemetry", "2025-09-30"),
    ]
    assert issues[1][3] == "4 vs 5" and issues[2][3] == "0 vs 3"
    drill = ask("q09_recon_drilldown", week="2025-10-01", channel="GT")
    assert [(r[0], r[2]) for r in drill] == [("T2", dt.date(2025, 10, 1)), ("T3", dt.date(2025, 10, 1)), ("T5", dt.date(2025, 10, 2))]
    assert ask("q09_recon_drilldown", week="2025-10-02", channel="GT") == []


def test_quarter_question_prunes_days(spark, views):
    rows = run_metric(spark, "q01_gross_sales_by_channel", fy="FY26", quarter="Q2").rows
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower()
    drill = run_metric(spark, "q09_recon_drilldown", week="2025-10-01", channel="GT").rows
    text = drill._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "PartitionFilters: [isnotnull(business_date" in text


def test_asking_wrongly(spark, views):
    with pytest.raises(KeyError, match="unknown question"):
        run_metric(spark, "q99")
    with pytest.raises(ValueError, match="quarter"):
        run_metric(spark, "q01_gross_sales_by_channel", fy="FY26")
    injected = run_metric(spark, "q09_recon_drilldown", week="2025-10-01", channel="GT' OR '1'='1")
    assert injected.rows.count() == 0


def test_ad_hoc_sql(spark, views):
    answer = run_sql(spark, "SELECT count(*) AS n FROM fct_pos_line")
    assert answer.rows.first().n == 6 and answer.run.first().status == DEGRADED
    assert run_sql(spark, "WITH a AS (SELECT 1 AS x) SELECT x FROM a").rows.first().x == 1
    assert run_sql(spark, "FROM fct_pos_line |> AGGREGATE count(*) AS n;").rows.first().n == 6
    assert run_sql(spark, "SHOW VIEWS").rows.count() > 0


@pytest.mark.parametrize(
    "statement",
    [
        "DROP VIEW fct_pos_line", "CREATE TABLE t USING parquet AS SELECT 1 AS x", "CREATE VIEW v AS SELECT 1 AS x",
        "WITH a AS (SELECT 1 AS x) INSERT OVERWRITE DIRECTORY '{0}' USING parquet SELECT x FROM a",
        "FROM (SELECT 1 AS x) t INSERT OVERWRITE DIRECTORY '{0}' USING parquet SELECT x",
        "SELECT 1 AS x) t INSERT OVERWRITE DIRECTORY '{0}' USING parquet SELECT (1",
        "SET spark.sql.ansi.enabled=false",
    ],
)
def test_ad_hoc_sql_refuses_to_write(spark, views, scratch, statement):
    target = f"{scratch}/out"
    with pytest.raises(PermissionError):
        run_sql(spark, statement.format(target))
    assert not os.path.exists(target) and spark.table("fct_pos_line").count() == 6


def test_empty_statement(spark, views):
    for text in ("", " ; "):
        with pytest.raises(ValueError):
            run_sql(spark, text)


def test_command_line_prints_every_row(spark, scratch, capsys):
    from grainledger.__main__ import _show
    from grainledger.plans.catalogue import Answer

    _show(Answer("q", "s", spark.range(1234).toDF("n"), None), None)
    assert len(capsys.readouterr().out.splitlines()) == 1234 + 4
    _show(Answer("q", "s", spark.range(1234).toDF("n"), None), f"{scratch}/rows")
    assert spark.read.parquet(f"{scratch}/rows").count() == 1234


def test_catalogue_is_data(spark):
    questions, metrics = list_questions(spark), list_metrics(spark)
    assert questions.count() == 10 and metrics.count() == len(METRICS) == 9
    assert {m.question for m in METRICS} <= set(QUESTIONS)
    assert questions.where("id = 'q01_gross_sales_by_channel'").first().params == ["fy", "quarter"]


LINES = "txn_id STRING, txn_line_no INT, basket_id STRING, outlet_code STRING, till_channel STRING, sku_code STRING, event_ts_utc TS, event_ts_ist TS, business_date DATE, ingest_date DATE, qty DOUBLE, uom STRING, unit_price DOUBLE, discount_amount DOUBLE, tax_amount DOUBLE, gross_sales_inr DOUBLE, payment_mode STRING, source_file STRING"


def test_product_lookups_keep_all_lines_and_fall_away_where_unused(spark, frame):
    def line(n, sku, uom="CS"):
        return ("T", n, "B", "O", "MT", sku, *["2025-01-01 00:00:00"] * 2, *["2025-01-01"] * 2, 2.0, uom, 1.0, 0.0, 0.0, 2.0, "x", "f")

    lines = frame(LINES, line(1, "both"), line(2, "master"), line(3, "factor"), line(4, "none"), line(5, None), line(6, "none", "EA"))
    outlets = frame(
        "outlet_code STRING, channel STRING, outlet_name STRING, city STRING, warehouse_code STRING, valid_from TS, valid_to TS",
        ("O", "GT", "o", "c", "w", "2024-01-01 00:00:00", "9999-12-31 00:00:00"),
    )
    changes = frame("sku_code STRING, product_name STRING, category STRING, case_pack BIGINT", ("both", "p", "k", 4), ("master", "q", "k", 5), (None, "n", "k", 9))
    products = changes.groupBy("sku_code").agg(*[F.max(c).alias(c) for c in changes.columns[1:]])
    factors = frame("sku_code STRING, eaches_per_case INT", ("both", 6), ("factor", 7), (None, 8))
    made = marts.fct_pos_line(lines, outlets, products, factors)
    found = {r.txn_line_no: (r.product_name, r.case_pack, r.eaches_per_case, r.conversion_source, r.eaches) for r in made.collect()}
    assert found == {
        1: ("p", 4, 6, "UOM_REFERENCE", 12.0), 2: ("q", 5, None, "CDC_CASE_PACK", 10.0), 3: (None, None, 7, "UOM_REFERENCE", 14.0),
        4: (None, None, None, "UNKNOWN", None), 5: (None, None, None, "UNKNOWN", None), 6: (None, None, None, "UOM_REFERENCE", 2.0),
    }
    keys = checks.duplicate_keys(made, ["txn_id", "txn_line_no"])
    assert "Join" not in keys._jdf.queryExecution().optimizedPlan().toString() and keys.count() == 0


def test_daily_sales_send_baskets_without_figures(frame):
    row = "business_date DATE, till_channel STRING, outlet_channel_asof STRING, basket_id STRING, gross_sales_inr DOUBLE, discount_amount DOUBLE, eaches DOUBLE, conversion_status STRING"
    day = ("2025-01-01", "MT", None)
    lines = frame(
        row, (*day, "a", 1.25, 0.5, 3.0, "CONVERTED"), (*day, "a", 1.25, None, None, "UNKNOWN"), (*day, None, None, 0.25, 2.0, None),
        (*day, "b", 1.0, 0.0, 1.0, "CONVERTED"), ("2025-01-02", "MT", "GT", None, None, None, None, "UNKNOWN"),
    )
    dates = frame(
        "calendar_date DATE, fiscal_year STRING, fiscal_quarter STRING, fiscal_month_no INT, report_week DATE", ("2025-01-01", "FY25", "Q4", 10, "2025-01-01")
    )
    daily = marts.fct_sales_daily(lines, dates)
    found = {tuple(r)[-6:] for r in daily.collect()}
    assert found == {(4, 2, 3.5, 0.75, 6.0, 1), (1, 0, None, None, None, 1)}
    assert "distinct" not in daily._jdf.queryExecution().optimizedPlan().toString()

"""Files with a good footer and a broken page: found, held back, released; many unreadable paths in a scan."""

import os
import shutil
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from grainledger.plans.runs import DEGRADED, FAILED, SUCCESS
from grainledger.plans.warehouse import build_warehouse, open_warehouse
from grainledger.sources import FEEDS, file_inventory, read_manifest, scan_feed
from grainledger.sources.feeds import among
from grainledger.sources.pages import broken_pages, held_back, suspects, with_pages
from landing import break_page, write_landing

POS = "raw/pos_transactions/ingest_date=2025-10-02/part-00000.parquet"


def folders(root):
    return {f.name: f"{root}/{f.path}" for f in FEEDS.values()}


def test_page_probe_names_group_and_column(spark, scratch):
    table = pa.table({"a": list(range(5000)), "b": [f"text {i}" for i in range(5000)]})
    for name in ("whole", "hurt"):
        pq.write_table(table, f"{scratch}/{name}.parquet", row_group_size=1000, compression="zstd")
    pq.write_table(table.slice(0, 0), f"{scratch}/empty.parquet")
    break_page(f"{scratch}/hurt.parquet", group=3, column=1)
    inventory = file_inventory(spark, {"f": scratch}).cache()
    assert {r.read_status for r in inventory.collect()} == {"OK"}
    (bad,) = broken_pages(inventory).collect()
    assert bad.path.endswith("hurt.parquet") and bad.error.startswith("row group 3, column b: ")
    after = {os.path.basename(r.path): r for r in with_pages(inventory).collect()}
    assert (after["hurt.parquet"].read_status, after["hurt.parquet"].actual_rows, after["hurt.parquet"].columns) == ("CORRUPT", None, None)
    assert (after["whole.parquet"].read_status, after["whole.parquet"].actual_rows) == ("OK", 5000)
    assert with_pages(inventory, inventory.where("path LIKE '%whole%'").select("path")).where("read_status <> 'OK'").count() == 0
    assert with_pages(inventory).columns == inventory.columns and broken_pages(inventory.limit(0)).count() == 0


def test_a_chunk_outside_the_file_is_seen_from_the_footer(spark, scratch):
    pq.write_table(pa.table({"a": list(range(50_000))}), f"{scratch}/cut.parquet", compression="none", use_dictionary=False)
    with open(f"{scratch}/cut.parquet", "rb") as handle:
        data = handle.read()
    footer = int.from_bytes(data[-8:-4], "little") + 8
    with open(f"{scratch}/cut.parquet", "wb") as handle:  # the middle is lost, the footer is whole
        handle.write(data[:1000] + data[-footer:])
    (row,) = file_inventory(spark, {"f": scratch}).collect()
    assert row.read_status == "CORRUPT" and "outside the file" in row.error


def test_suspects(spark, scratch):
    write_landing(scratch, corrupt=False)
    inventory = file_inventory(spark, folders(scratch)).cache()
    nothing = spark.createDataFrame([], "path STRING")
    manifest = read_manifest(spark, scratch)
    some = {tuple(r.path.split("/")[-3:-1]) for r in suspects(inventory, manifest, nothing).collect()}
    differing = inventory.select("feed", "partition", "actual_rows").join(manifest, ["feed", "partition"])
    own = differing.groupBy("feed", "partition", "row_count", "file_count").agg(F.sum("actual_rows").alias("n"), F.count("*").alias("files"))
    assert some == {(r.feed, r.partition) for r in own.where("n <> row_count OR files <> file_count").collect()}
    path = inventory.where("feed = 'wms_scan_events'").select("path")
    assert {r.path for r in suspects(inventory, manifest.limit(0), path).collect()} == {path.first().path}


def test_broken_page_is_listed_and_released_when_replaced(spark, scratch):
    write_landing(f"{scratch}/in", corrupt=False, manifest=False)  # nothing makes the file suspect
    shutil.copy(f"{scratch}/in/{POS}", f"{scratch}/good")
    break_page(f"{scratch}/in/{POS}", group=0, column=0)
    assert build_warehouse(spark, f"{scratch}/in", f"{scratch}/out").status == FAILED  # a scan meets the page, the build starts over
    run = build_warehouse(spark, f"{scratch}/in", f"{scratch}/out", allow_degraded=True)  # now a suspect: probed at once
    assert (run.status, run.bad_file_count, run.source_row_count) == (DEGRADED, 1, 6)
    open_warehouse(spark, f"{scratch}/out")
    (listed,) = spark.table("dq_affected_partitions").collect()
    assert listed.partition == "ingest_date=2025-10-02" and listed.error.startswith("row group 0, column ")
    (held,) = held_back(spark.table("quarantine")).collect()
    assert held.path == listed.path and spark.table("quarantine").count() == 1
    assert spark.table("fct_pos_line").count() == 5

    shutil.copy(f"{scratch}/good", f"{scratch}/in/{POS}")
    past = time.time() - 60
    os.utime(f"{scratch}/in/{POS}", (past, past))
    run = build_warehouse(spark, f"{scratch}/in", f"{scratch}/out")
    assert (run.status, run.bad_file_count, run.canonical_row_count) == (SUCCESS, 0, 6)
    open_warehouse(spark, f"{scratch}/out")
    assert [r.event for r in spark.table("quarantine").orderBy("at").collect()] == ["HELD", "RELEASED"]
    assert held_back(spark.table("quarantine")).count() == 0


def test_a_hundred_thousand_unreadable_paths(spark, scratch):
    write_landing(scratch)
    inventory = file_inventory(spark, folders(scratch)).cache()
    first = inventory.where("feed = 'reefer_telemetry'").first()
    many = spark.range(100_000).select(
        F.concat(F.lit(first.path), F.col("id")).alias("path"), F.lit(first.feed).alias("feed"), F.lit("dt=x").alias("partition"),
        F.lit(1).cast("long").alias("bytes"), F.lit(None).cast("long").alias("actual_rows"), F.lit("CORRUPT").alias("read_status"),
        F.lit("").alias("error"), F.lit(None).cast("array<string>").alias("columns"),
    )
    began = time.time()
    scan = scan_feed(spark, scratch, FEEDS["reefer_telemetry"], inventory.union(many))
    assert scan.count() == 14
    day = scan.where("dt = DATE '2025-09-30'").select("device_id")
    assert day.count() == 2 and time.time() - began < 60
    plan = day._jdf.queryExecution().optimizedPlan().toString()
    assert " IN (" not in plan and "INSET" not in plan.upper()
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text and "ReadSchema: struct<device_id:string>" in text


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_among_tells_listed_from_others(spark, n):
    paths = spark.range(3000).select(F.concat(F.lit("file:/x/"), F.col("id")).alias("path"), "id")
    listed = paths.where(F.col("id") < n).select("path")
    inside = among(F.col("path"), listed.union(listed))
    if n == 0:
        assert inside is None
    else:
        assert [r.id for r in paths.where(inside).orderBy("id").collect()] == list(range(n))

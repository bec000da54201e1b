"""What `fct_pos_line` and the histories behind it send through shuffles: plans, and the rows that come back."""

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import functions as F

from grainledger.operators import asof_join, scd2
from grainledger.plans import marts
from grainledger.plans.staging import derived_of_line, stg_pos

LINES = (
    "txn_id STRING, txn_line_no INT, basket_id STRING, outlet_code STRING, till_channel STRING, sku_code STRING, event_ts_utc TS, "
    "event_ts_ist TS, business_date DATE, ingest_date DATE, qty DOUBLE, uom STRING, unit_price DOUBLE, discount_amount DOUBLE, "
    "tax_amount DOUBLE, gross_sales_inr DOUBLE, payment_mode STRING, source_file STRING"
)
OUTLETS = "outlet_code STRING, channel STRING, outlet_name STRING, city STRING, warehouse_code STRING, valid_from TS, valid_to TS"
PRODUCTS = "sku_code STRING, product_name STRING, category STRING, case_pack BIGINT"
AT = "2025-01-01 20:00:00"  # the next day in the shops


@contextmanager
def broadcasts_up_to(spark, most):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(most))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def shuffles(df):
    """(partitioning, names of the columns) of every shuffle of the plan as first made."""
    found = []

    def walk(p):
        kind = p.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found.append((p.outputPartitioning().toString(), [a.split("#")[0] for a in p.output().mkString(",").split(",")]))
        kids = [p.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [p.children().apply(i) for i in range(p.children().size())]
        for k in kids:
            walk(k)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def lookups(frame):
    outlets = frame(OUTLETS, ("O", "GT", "o", "c", "w", "2024-01-01 00:00:00", "9999-12-31 00:00:00"))
    products = frame(PRODUCTS, ("S", "p", "k", 4)).groupBy("sku_code").agg(*[F.max(c).alias(c) for c in ("product_name", "category", "case_pack")])
    return outlets, products, frame("sku_code STRING, eaches_per_case INT", ("S", 6))


def line(n, ist, day, qty, gross, at=AT):
    return ("T", n, "B", "O", "MT", "S", at, ist, day, "2025-01-02", qty, "CS", 1.5, 0.0, 0.0, gross, "x", "f")


def test_columns_that_follow_from_others_stay_out_of_the_shuffles_of_lines(spark, frame):
    raw = frame(
        "txn_id STRING, txn_line_no INT, basket_id STRING, outlet_code STRING, channel STRING, sku_code STRING, event_ts STRING, ingest_date DATE, "
        "qty INT, quantity_units INT, uom STRING, unit_price DOUBLE, discount_amount DOUBLE, tax_amount DOUBLE, payment_mode STRING, source_file STRING",
        ("T", 1, "B", "O", "MT", "S", "2025-01-01T20:00:00Z", "2025-01-02", 2, None, "CS", 1.5, 0.0, 0.0, "x", "f"),
    )
    with broadcasts_up_to(spark, -1):
        made = marts.fct_pos_line(stg_pos(raw), *lookups(frame))
        lines = [names for _, names in shuffles(made) if "payment_mode" in names]
        assert len(lines) >= 2  # by outlet and cell, and by product
        for names in lines:
            mine = [c for c in names if c in marts.SHUFFLED]
            assert mine == [c for c in marts.SHUFFLED if c in mine] and len(mine) >= 15
        assert not {"event_ts_ist", "business_date", "gross_sales_inr"} & {c for names in lines for c in names}
        got = made.first()
    assert (got.event_ts_ist, got.business_date, got.gross_sales_inr) == (dt.datetime(2025, 1, 2, 1, 30), dt.date(2025, 1, 2), 3.0)
    assert (got.outlet_channel_asof, got.product_name, got.eaches) == ("GT", "p", 12.0)


def test_values_that_do_not_follow_come_back_as_they_were(frame):
    ist, day = "2025-01-02 01:30:00", "2025-01-02"
    pos = frame(
        LINES, line(1, ist, day, 2.0, 3.0), line(2, None, None, 2.0, None), line(3, AT, "2025-01-01", None, 7.0), line(4, ist, day, None, None),
        line(5, ist, day, 2.0, float("nan")), line(6, ist, day, float("nan"), float("nan")), line(7, ist, day, 2.0, 3.0, at=None), line(8, None, None, 2.0, 3.0, at=None),
    )
    names = ["txn_line_no", *derived_of_line()]
    want = {str(tuple(r)) for r in pos.select(names).collect()}
    assert len(want) == 8
    assert {str(tuple(r)) for r in marts.fct_pos_line(pos, *lookups(frame)).select(names).collect()} == want
    assert marts.put_back(marts.set_apart(pos, derived_of_line()), derived_of_line()).select(pos.columns).exceptAll(pos).isEmpty()


def test_history_meets_its_cells_without_a_shuffle(spark):
    changes = spark.range(3000).selectExpr(
        "IF(id % 10 = 0, NULL, CAST(id % 3 AS STRING)) AS k", "TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval(0, CAST(id div 2 AS INT)) AS t",
        "id AS seq", "IF(id % 7 = 0, 'D', 'U') AS op", "id AS v",
    )
    with broadcasts_up_to(spark, 1 << 18):
        spread, whole = (scd2(changes, "k", "t", "seq", "op", busy_above=n) for n in (50, 10**6))
        dealt = [by for by, names in shuffles(spread) if "v" in names or "max" in names]
        assert dealt and not [by for by in dealt if "coalesce" in by]
        rows = [sorted(map(tuple, df.collect()), key=repr) for df in (spread, whole)]
    assert rows[0] == rows[1] and len(rows[0]) > 2000
    with broadcasts_up_to(spark, -1):
        assert sorted(map(tuple, scd2(changes, "k", "t", "seq", "op", busy_above=50).collect()), key=repr) == rows[0]


def test_bounds_and_lists_of_a_history_share_its_shuffles(spark):
    changes = spark.range(3000).selectExpr(
        "CAST(id % 300 AS STRING) AS k", "TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS t",
        "id AS seq", "'U' AS op", "CAST(id AS STRING) AS v", "id AS w",
    )
    facts = spark.range(500).selectExpr("id", "CAST(id % 310 AS STRING) AS k", "TIMESTAMP_NTZ '2025-02-01 00:00:00' AS at")
    with broadcasts_up_to(spark, 1 << 18):
        versions = scd2(changes.repartition(3), "k", "t", "seq", "op")
        by = [names for p, names in shuffles(asof_join(facts, versions, "k", "at", {"v": "v"})) if "_cell" in p and "op" in names]
    assert len(by) >= 2 and len({tuple(names) for names in by}) == 1  # one set of columns, so that Spark reuses the shuffle
    got = asof_join(facts, versions, "k", "at", {"v": "v"}).collect()
    assert len(got) == 500 and all((r.v is None) == (r.id % 310 >= 300) for r in got)

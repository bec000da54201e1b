"""Equal-count cells: bursts, hot keys and odd distributions against brute force, and how much one group holds."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from grainledger.operators import asof_join, exact_median, missing_cells, scd2
from grainledger.operators.cells import CELLS, cell_bounds, cell_of, same_keys
from grainledger.operators.medians import value_summary

START = "TIMESTAMP_NTZ '2015-01-01 00:00:00'"


def fullest(rows, keys, value, above=32):
    """The most rows of one group's cell."""
    mine = [f"_b_{k}" for k in keys]
    dealt = rows.join(cell_bounds(rows, keys, value, above), same_keys(keys, mine), "left").select(*keys, cell_of(F.col(value)).alias("c"))
    return dealt.groupBy(*keys, "c").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("power", [1, 3, 9])
def test_cells_hold_about_as_many_values_each(spark, power):
    rows = spark.range(100_000).selectExpr("id % 2 AS k", f"pow(id / 1e3, {power}) AS v")
    assert fullest(rows, ["k"], "v") < 15 * 50_000 / CELLS
    assert fullest(rows.where("v < 1"), ["k"], "v", above=10**6) > 10  # quiet groups have one cell


def test_a_cell_is_the_number_of_bounds_up_to_a_value(spark):
    rows = spark.range(0, 500, 5).selectExpr("CAST(NULL AS INT) AS k", "id AS v")
    asked = spark.range(-3, 505).selectExpr("CAST(NULL AS INT) AS k", "id AS x").unionAll(spark.sql("SELECT CAST(NULL AS INT), CAST(NULL AS BIGINT)"))
    got = asked.join(cell_bounds(rows, ["k"], "v", 0), same_keys(["k"], ["_b_k"]), "left").select("x", cell_of(F.col("x")).alias("c")).collect()
    assert len(got) == 509
    assert all(r.c == (0 if r.x is None else min(100, max(0, r.x // 5 + 1))) for r in got)


def burst(spark, n):
    """n versions of one key in one hour of ten years, and one on each side of it."""
    step = f"make_dt_interval(CAST(1800 AS INT), 0, 0, id * 3600e0 / {n})"
    inside = spark.range(n).selectExpr("'hot' AS k", f"{START} + {step} AS t", "id AS seq", "'U' AS op")
    ends = spark.sql(f"SELECT 'hot' AS k, {START} AS t, -1L AS seq, 'I' AS op UNION ALL SELECT 'hot', {START} + INTERVAL '3650' DAY, 9999999L, 'U'")
    return inside.unionAll(ends)


def test_asof_join_in_a_burst_compares_few_versions(spark):
    versions = scd2(burst(spark, 3600), "k", "t", "seq", "op")
    assert fullest(versions.selectExpr("k", "valid_from"), ["k"], "valid_from") < 40
    facts = spark.range(20_000).selectExpr("id", "'hot' AS k", f"{START} + make_dt_interval(CAST(1800 AS INT), 0, 0, id * 0.18e0) AS at")
    got = asof_join(facts, versions, "k", "at", {"seq": "seq", "valid_from": "since", "valid_to": "upto"})
    bad = got.where("seq IS NULL OR at < since OR at >= upto").count()
    assert (got.count(), bad, got.select("seq").distinct().count()) == (20_000, 0, 3600)


def test_history_of_a_burst_is_spread_and_right(spark):
    n = 60_000
    changes = burst(spark, n)
    assert fullest(changes, ["k"], "t", above=4096) < 15 * n / CELLS
    got = scd2(changes, "k", "t", "seq", "op").orderBy("valid_from").select("valid_from", "valid_to").collect()
    assert len(got) == n + 2 and got[-1].valid_to == dt.datetime(9999, 12, 31)
    assert all(a.valid_to == b.valid_from for a, b in zip(got, got[1:]))


def test_history_with_a_third_of_all_changes_on_one_key(spark):
    rng = random.Random(5)
    base = dt.datetime(2025, 1, 1)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}", base + dt.timedelta(microseconds=rng.randrange(40_000)), i, rng.choice("IUD")) for i in range(12_000)]
    df = spark.createDataFrame(rows, "k STRING, t TIMESTAMP_NTZ, seq BIGINT, op STRING").repartition(6)
    want = []
    for key in {r[0] for r in rows}:
        last = {r[1]: r for r in sorted((r for r in rows if r[0] == key), key=lambda r: r[2])}
        times = sorted(last)
        want += [(key, last[a][2], a, b) for a, b in zip(times, [*times[1:], dt.datetime(9999, 12, 31)]) if last[a][3] in "IU"]
    got = scd2(df, "k", "t", "seq", "op", busy_above=100).collect()
    assert sorted((r.k, r.seq, r.valid_from, r.valid_to) for r in got) == sorted(want)


def test_median_of_a_burst_ranks_few_values(spark):
    n = 1_000_000
    df = spark.range(n).selectExpr("'g' AS g", "1.7e9 + id * 1e-3 AS v").unionAll(spark.sql("SELECT 'g', -1e300 UNION ALL SELECT 'g', 1e300 UNION ALL SELECT 'g', CAST('NaN' AS DOUBLE)"))
    assert fullest(df, ["g"], "v", above=CELLS) < 15 * n / CELLS
    assert exact_median(df, ["g"], "v", "m").first().m == 1.7e9 + 500_000 * 1e-3


def test_summary_of_values_is_one_read(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, round(rng.uniform(0, 1e4), 2)])) for _ in range(5000)] + [("c", None)]
    df = spark.createDataFrame(rows, "s STRING, v DOUBLE")
    out = value_summary(df, ["s"], "v", "mid")
    got = {r.s: (r._rows, r._total, r._mean, r.mid) for r in out.collect()}
    for s in ("a", "b", None, "c"):
        mine = [v for k, v in rows if k == s]
        there = [v for v in mine if v is not None]
        n, total, mean, mid = got[s]
        assert n == len(mine)
        if there:
            assert (round(total, 2), mid) == (round(sum(there), 2), pytest.approx(statistics.median(there))) and mean == pytest.approx(total / len(there))
        else:
            assert (total, mean, mid) == (None, None, None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 1 or "ReusedExchange" in plan


def test_missing_cells_across_words_and_eras(spark):
    days = [dt.date(1969, 11, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2030, 6, 5)]
    rng = random.Random(1)
    rows = [(f"u{i}", d) for i in range(30) for d in days if rng.random() < 0.6] + [("all", d) for d in days] + [(None, days[2])]
    df = spark.createDataFrame(rows * 2, "u STRING, d DATE")
    units = {u for u, _ in rows}
    got = [tuple(r) for r in missing_cells(df, "u", "d").collect()]
    assert len(got) == len(set(got)) and set(got) == {(u, d) for u in units for d in days} - set(rows)
    wide = missing_cells(df.where("u = 'all'"), "u", "d", spark.sql("SELECT 'mute' AS u"), spark.sql("SELECT DATE '2031-01-01' AS d"))
    assert {tuple(r) for r in wide.collect()} == {("mute", d) for d in [*days, dt.date(2031, 1, 1)]} | {("all", dt.date(2031, 1, 1))}
    assert missing_cells(df.where("false"), "u", "d").collect() == []

import datetime as dt
import random

from pyspark.sql import functions as F

from grainledger.operators import asof_join, current_state, keep_first, latest_per_key, scd2, version_changes
from grainledger.operators.cdc import tombstoned_keys
from standins.feeds import warehouse_table
from standins.keys import QUERIES

T = [f"2025-01-{d:02d} 00:00:00" for d in range(1, 20)]
END = dt.datetime(9999, 12, 31)


def at(i):
    return dt.datetime(2025, 1, i + 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_exact_duplicates_late_copies_and_ties(frame):
    df = frame(
        "k STRING, ingest DATE, t TS, price DOUBLE",
        ("a", "2025-01-02", T[0], 1.0),
        ("a", "2025-01-02", T[0], 1.0),
        ("b", "2025-01-05", T[0], 2.0),
        ("b", "2025-01-03", T[1], 3.0),
        ("c", "2025-01-03", T[1], 9.0),
        ("c", "2025-01-03", T[1], 4.0),
        ("d", None, T[1], 1.0),
        ("d", "2025-01-09", T[1], 2.0),
    )
    for seed in range(3):
        mixed = df.orderBy(F.rand(seed)).repartition(3)
        got = {r.k: r.price for r in keep_first(mixed, ["k"], ["ingest", "t"]).collect()}
        assert got == {"a": 1.0, "b": 3.0, "c": 4.0, "d": 2.0}


def test_dedupe_combines_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    text = plan(keep_first(df, ["k"], ["v"]))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert text.count("Exchange") == 1 and "Window" not in text
    assert "partial_min" in after and "partial_min" not in before


def test_columns_without_an_order_travel_along(spark):
    df = spark.createDataFrame([("a", 2, {"x": 2}), ("a", 1, {"x": 1}), ("b", 3, None)], "k STRING, v INT, m MAP<STRING,INT>")
    assert {r.k: (r.v, r.m) for r in keep_first(df, ["k"], ["v"]).collect()} == {"a": (1, {"x": 1}), "b": (3, None)}
    assert {r.k: (r.v, r.m) for r in latest_per_key(df, ["k"], ["v"]).collect()} == {"a": (2, {"x": 2}), "b": (3, None)}


def test_latest_per_key_takes_sequence_on_ties(frame):
    df = frame("k STRING, t TS, seq BIGINT, v INT", ("a", T[1], 1, 1), ("a", T[1], 2, 2), ("a", T[0], 9, 3))
    assert [r.v for r in latest_per_key(df, ["k"], ["t", "seq"]).collect()] == [2]


CHANGES = (
    ("o1", T[0], 1, "I", "A"),
    ("o1", T[1], 2, "U", "B"),
    ("o1", T[1], 3, "U", "C"),
    ("o1", T[2], 4, "D", "C"),
    ("o1", T[3], 5, "U", "A"),
)


def test_scd2_ties_deletes_and_reopening(frame):
    df = frame("k STRING, t TS, seq BIGINT, op STRING, ch STRING", *CHANGES)
    got = sorted((r.ch, r.valid_from, r.valid_to) for r in scd2(df, "k", "t", "seq", "op").collect())
    assert got == [("A", at(0), at(1)), ("A", at(3), END), ("C", at(1), at(2))]


def test_scd2_cells_change_nothing(frame):
    df = frame("k STRING, t TS, seq BIGINT, op STRING, ch STRING", *CHANGES, (None, T[0], 6, "I", "A"), (None, T[1], 7, "D", "A"))
    rows = [sorted(map(tuple, scd2(df, "k", "t", "seq", "op", busy_above=n).collect()), key=repr) for n in (0, 2, 10**6)]
    assert rows[0] == rows[1] == rows[2]
    assert (None, at(0), 6, "I", "A", at(1)) in rows[0]


def test_scd2_several_changes_within_one_day(frame):
    df = frame(
        "k STRING, t TS, seq BIGINT, op STRING, ch STRING",
        ("k", "2025-01-01 08:00:00", 1, "I", "A"),
        ("k", "2025-01-01 09:00:00", 2, "U", "B"),
        ("k", "2025-01-01 10:00:00", 3, "D", "B"),
        ("k", "2025-01-04 07:00:00", 4, "U", "C"),
        ("k", None, 5, "U", "X"),
        ("other", "2025-01-02 00:00:00", 6, "D", "Z"),
    )
    got = sorted((r.ch, r.valid_from.hour, r.valid_to) for r in scd2(df, "k", "t", "seq", "op").collect())
    assert got == [
        ("A", 8, dt.datetime(2025, 1, 1, 9)),
        ("B", 9, dt.datetime(2025, 1, 1, 10)),
        ("C", 7, END),
    ]


def brute_scd2(rows):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(mine):
            nxt = mine[i + 1][1] if i + 1 < len(mine) else END
            if r[3] in "IU" and r[1] < nxt:
                out.append((r[0], r[4], r[1], nxt))
    return sorted(out)


def brute_asof(facts, versions):
    out = []
    for fid, key, t in facts:
        hit = [v for v in versions if v[0] == key and t is not None and v[2] <= t < v[3]]
        assert len(hit) <= 1
        out.append((fid, hit[0][1] if hit else None))
    return sorted(out)


def test_scd2_and_asof_match_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    base = dt.datetime(2025, 1, 1)
    moment = lambda: base + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 90, 30))
    key = lambda: "hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}"
    rows = [(key(), moment(), seq, rng.choice("IUUD"), rng.choice("ABC")) for seq in range(800)]
    df = spark.createDataFrame(rows, "k STRING, t TIMESTAMP_NTZ, seq BIGINT, op STRING, ch STRING").repartition(5)
    versions = scd2(df, "k", "t", "seq", "op")
    expected = brute_scd2(rows)
    assert sorted((r.k, r.ch, r.valid_from, r.valid_to) for r in versions.collect()) == expected

    facts = [(i, key(), moment() + dt.timedelta(days=rng.choice([-30, 0, 0, 60]))) for i in range(1500)]
    facts += [(9001, "absent", base), (9002, None, base), (9003, "hot", None)]
    facts += [(10000 + i, v[0], v[2]) for i, v in enumerate(expected)]
    facts += [(20000 + i, v[0], v[3]) for i, v in enumerate(expected) if v[3] != END]
    fact = spark.createDataFrame(facts, "id INT, k STRING, at TIMESTAMP_NTZ")
    want = brute_asof(facts, expected)
    for busy_above in (0, 5, 32, 10**6):
        got = asof_join(fact, versions, "k", "at", {"ch": "ch_asof"}, busy_above=busy_above)
        assert sorted((r.id, r.ch_asof) for r in got.collect()) == want, busy_above


def test_asof_bounds(frame):
    v = frame("k STRING, valid_from TS, valid_to TS, ch STRING", ("k", T[1], T[3], "A"), ("k", T[3], T[5], "B"))
    f = frame("id INT, k STRING, t TS", (1, "k", T[1]), (2, "k", T[3]), (3, "k", T[0]), (4, "x", T[2]), (5, "k", T[5]))
    for busy_above in (0, 32):
        got = {r.id: r.c for r in asof_join(f, v, "k", "t", {"ch": "c"}, busy_above=busy_above).collect()}
        assert got == {1: "A", 2: "B", 3: None, 4: None, 5: None}


def test_asof_without_any_version_keeps_all_facts(frame):
    v = frame("k STRING, valid_from TS, valid_to TS, ch STRING", ("k", T[1], T[3], "A")).where("false")
    f = frame("id INT, k STRING, t TS", (1, "k", T[1]), (2, "x", T[3]))
    assert asof_join(f, v, "k", "t", {"ch": "c"}).where("c IS NULL").count() == 2


def hot_history(spark, versions, facts):
    """One key owns all versions, one change per minute, and all facts."""
    start = "TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval(0, 0, CAST({} AS INT))"
    v = spark.range(versions).selectExpr(
        "CAST(id div 1000000 AS STRING) AS k", start.format("id") + " AS valid_from", start.format("id + 1") + " AS valid_to", "id AS version"
    )
    f = spark.range(facts).selectExpr("CAST(id div 1000000 AS STRING) AS k", start.format(f"id * 7 % {versions}") + " AS t", f"id * 7 % {versions} AS expected")
    return f, v


def test_asof_compares_a_hot_key_with_few_versions(spark):
    f, v = hot_history(spark, 20_000, 200_000)
    out = asof_join(f, v, "k", "t", {"version": "got"})
    assert out.where("got = expected").count() == 200_000


def test_asof_works_with_and_without_broadcast(spark):
    f, v = hot_history(spark, 500, 5_000)
    assert "BroadcastHashJoin" in plan(asof_join(f, v, "k", "t", {"version": "got"}))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = asof_join(f, v, "k", "t", {"version": "got"})
        assert "SortMergeJoin" in plan(out) and "Broadcast" not in plan(out)
        assert out.where("got = expected").count() == 5_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_version_changes_skip_a_delete_gap(frame):
    df = frame("k STRING, t TS, seq BIGINT, op STRING, ch STRING", *CHANGES)
    got = version_changes(scd2(df, "k", "t", "seq", "op"), "k", "ch")
    assert [tuple(r) for r in got.collect()] == [("o1", at(1), "A", "C")]


def test_version_changes_are_null_safe(frame):
    v = frame(
        "k STRING, valid_from TS, valid_to TS, ch STRING",
        ("a", T[0], T[1], None), ("a", T[1], T[2], "A"), ("a", T[2], T[3], None), ("a", T[3], T[4], None),
        ("b", T[0], T[1], "A"), ("b", T[1], T[2], "A"),
    )
    got = sorted((r.k, r.changed_at, r.ch_from, r.ch_to) for r in version_changes(v, "k", "ch").collect())
    assert got == [("a", at(1), None, "A"), ("a", at(2), "A", None)]


def test_current_state_by_time_drops_a_final_delete(frame):
    df = frame(
        "k STRING, t TS, seq BIGINT, op STRING, v INT",
        ("gone", T[0], 1, "I", 1), ("gone", T[1], 2, "D", 1),
        ("back", T[0], 3, "I", 1), ("back", T[1], 4, "D", 1), ("back", T[2], 5, "U", 7),
    )
    assert [(r.k, r.v) for r in current_state(df, "k", "t", "seq", "op").collect()] == [("back", 7)]


def test_current_state_by_sequence_handles_backdated_deletes(frame):
    df = frame(
        "k STRING, t TS, seq BIGINT, op STRING, v INT",
        ("dead", T[0], 1, "I", 1), ("dead", T[5], 2, "U", 2), ("dead", T[0], 9, "D", 1),
        ("live", T[0], 1, "I", 1), ("live", T[0], 2, "D", 1), ("live", T[1], 3, "U", 5),
        ("tied", T[1], 1, "I", 1), ("tied", T[1], 2, "U", 2),
        ("only-delete", T[1], 1, "D", 1),
    )
    got = current_state(df, "k", "t", "seq", "op", delete_rule="max_seq")
    assert got.columns == df.columns
    assert sorted((r.k, r.v) for r in got.collect()) == [("live", 5), ("tied", 2)]
    assert sorted(r.k for r in tombstoned_keys(df, "k", "seq", "op").collect()) == ["dead", "only-delete"]
    by_time = current_state(df, "k", "t", "seq", "op")
    assert "dead" in {r.k for r in by_time.collect()}


def test_tombstone_state_is_one_shuffle(spark):
    df = spark.range(50).selectExpr("id % 7 AS k", "current_date() AS t", "id AS seq", "'I' AS op", "id AS v")
    assert plan(current_state(df, "k", "t", "seq", "op", delete_rule="max_seq")).count("Exchange") == 1


def test_scd2_reads_its_input_once(spark):
    df = spark.range(200).selectExpr(
        "id % 7 AS k", "TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS t", "id AS seq",
        "'U' AS op", "id AS v",
    )
    out = scd2(df, "k", "t", "seq", "op")
    out._jdf.queryExecution().toRdd().count()
    assert "ReusedExchange" in plan(out)


def test_asof_looks_up_long_lists_and_shuffles_facts_once(spark):
    """Without any broadcast of the history: a key of 20,000 versions in one list, and in cells."""
    f, v = hot_history(spark, 20_000, 20_000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "262144")
    try:
        for busy_above in (32, 10**6):
            out = asof_join(f, v.repartition(3), "k", "t", {"version": "got"}, busy_above=busy_above)
            assert out.where("got = expected").count() == 20_000
        wide = [line for line in plan(out).splitlines() if "Exchange hashpartitioning(k#" in line]
        assert len(wide) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_asof_skips_empty_and_reversed_intervals(frame):
    v = frame("k STRING, valid_from TS, valid_to TS, ch STRING", ("k", T[1], T[1], "A"), ("k", T[4], T[2], "B"), ("k", T[1], None, "C"), ("k", T[1], T[5], "D"))
    f = frame("id INT, k STRING, t TS", (1, "k", T[1]), (2, "k", T[3]), (3, None, T[3]))
    assert {r.id: r.c for r in asof_join(f, v, "k", "t", {"ch": "c"}).collect()} == {1: "D", 2: "D", 3: None}


def shuffled_plan(spark, query):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(query())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lines_are_deduplicated_where_they_were_joined(spark, sf_dir):
    text = shuffled_plan(spark, lambda: warehouse_table(spark, sf_dir, "stg_pos"))
    assert text.count("Exchange hashpartitioning") == 2  # lines and orders


def test_changes_are_counted_before_the_semi_join(spark, sf_dir):
    text = shuffled_plan(spark, lambda: QUERIES["semi_join"](spark, sf_dir))
    assert text.index("LeftSemi") < text.index("count(1)")

"""Streams in several micro-batches end in the same tables as one batch."""

import datetime as dt
import random

import pytest

from grainledger.operators import current_state, keep_first
from grainledger.streaming import ChangeTable, dedupe_stream

SCHEMA = "k STRING, t TIMESTAMP_NTZ, seq BIGINT, op STRING, v INT"
BASE = dt.datetime(2025, 1, 1)


def changes(n, seed=1):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}", BASE + dt.timedelta(hours=rng.randrange(200)), i, rng.choice("IUUUD"), rng.randrange(9))
        for i in range(n)
    ]


@pytest.mark.parametrize("rule", ["latest", "max_seq"])
def test_batches_of_changes_end_in_the_batch_table(spark, scratch, rule):
    rows = changes(900)
    random.Random(2).shuffle(rows)  # changes arrive late and out of order
    table = ChangeTable(f"{scratch}/state", ("k",), "t", "seq", "op", buckets=8)
    parts = [rows[:300], rows[300:310], rows[310:]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        table.start(stream, f"{scratch}/checkpoint").awaitTermination()
        sofar = spark.createDataFrame([r for p in parts[: i + 1] for r in p], SCHEMA)
        want = current_state(sofar, "k", "t", "seq", "op", delete_rule=rule)
        got = table.current(spark, rule).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_repeated_batch_changes_nothing_and_small_ones_touch_few_buckets(spark, scratch):
    table = ChangeTable(f"{scratch}/state", ("k",), "t", "seq", "op", buckets=16)
    df = spark.createDataFrame(changes(400), SCHEMA)
    table.apply(df.where("seq < 300"), 0)
    late = df.where("seq >= 300 AND k = 'hot'")
    table.apply(late, 1)
    once = sorted(map(tuple, table.current(spark).collect()))
    table.apply(late, 1)
    assert sorted(map(tuple, table.current(spark).collect())) == once
    assert spark.read.parquet(f"{scratch}/state").where("state_batch = 1").select("state_bucket").distinct().count() == 1
    table.apply(late.limit(0), 2)
    assert sorted(map(tuple, table.current(spark).collect())) == once


def test_no_table_and_wrong_rules(spark, scratch):
    table = ChangeTable(f"{scratch}/none", ("k",), "t", "seq", "op")
    with pytest.raises(FileNotFoundError):
        table.current(spark)
    table.apply(spark.createDataFrame(changes(5), SCHEMA), 0)
    with pytest.raises(ValueError):
        table.current(spark, "other")
    with pytest.raises(TypeError):
        table.apply(spark.sql("SELECT 'a' AS k, current_timestamp() AS t, 1L AS seq, 'I' AS op, map(1, 2) AS m"), 1)


def test_copies_in_later_batches_are_dropped(spark, scratch):
    rows = [(f"T{i % 40}", BASE + dt.timedelta(minutes=i % 40), i % 40) for i in range(120)]
    for i in range(0, 120, 30):
        spark.createDataFrame(rows[i : i + 30], "id STRING, t TIMESTAMP_NTZ, v INT").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema("id STRING, t TIMESTAMP_NTZ, v INT").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    out = dedupe_stream(stream, ["id"], "t").writeStream.option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True)
    out.format("parquet").start(f"{scratch}/out").awaitTermination()
    want = keep_first(spark.read.parquet(f"{scratch}/in"), ["id"], ["t"])
    assert sorted(map(tuple, spark.read.parquet(f"{scratch}/out").collect())) == sorted(map(tuple, want.collect()))

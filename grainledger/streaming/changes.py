"""Feeds as streams: duplicates dropped while they can still arrive, and change streams merged into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import tie_breakers
from ..sources.tables import try_read


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, within: str = "2 days") -> DataFrame:
    """The first copy of each key that arrives; later copies within `within` of its event time are dropped.

    At-least-once feeds repeat whole lines, so any copy will do. Keys older than the watermark leave the state, which
    therefore holds a window of the stream and not its history; rows later than that are dropped.
    """
    timed = stream.withColumn("_event", F.col(ts).cast("timestamp"))
    return timed.withWatermark("_event", within).dropDuplicatesWithinWatermark(list(keys)).drop("_event")


@dataclass(frozen=True)
class ChangeTable:
    """The state of an I/U/D stream by key, kept as Parquet in hashed buckets and brought forward batch by batch.

    A key's state is what `current_state` needs of its changes: the highest sequence, the highest sequence of a
    delete, and the newest rows. All are maxima, so a batch's changes are combined before they meet the state, late
    changes find their place, and a batch that is run again changes nothing.

    A batch reads and writes only the buckets whose keys it changes, under a folder of its own (`state_batch=<batch>`); the
    newest folder of a bucket counts. A batch that failed half way is written again as a whole, because its folder is
    replaced; readers see a batch when its folder is committed by Spark's writer. Old folders are left to a retention
    rule. `buckets` should be about the table's bytes / 200 MB and stays as chosen when the table was begun.
    """

    path: str
    key: tuple[str, ...]
    ts: str
    seq: str
    op: str
    buckets: int = 64

    def _state(self, changes: DataFrame) -> DataFrame:
        rest = [c for c in changes.columns if c not in (*self.key, self.ts, self.seq)]
        if set(rest) - set(tie_breakers(changes, [*self.key, self.ts, self.seq])):
            raise TypeError("all columns of a change must be orderable")
        row, gone = F.struct(self.ts, self.seq, *rest), F.col(self.op) == "D"
        return changes.groupBy(*self.key).agg(
            F.max(self.seq).alias("_top"), F.max(F.when(gone, F.col(self.seq))).alias("_top_delete"),
            F.max(row).alias("_last"), F.max(F.when(~gone, row)).alias("_row"),
        )

    def _merged(self, states: DataFrame) -> DataFrame:
        return states.groupBy(*self.key).agg(*[F.max(c).alias(c) for c in ("_top", "_top_delete", "_last", "_row")])

    def _stored(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest state of every bucket, of the batches before a given one."""
        found = try_read(spark, self.path)
        if found is None:
            return None
        if before is not None:
            found = found.where(F.col("state_batch") < before)
        newest = found.groupBy("state_bucket").agg(F.max("state_batch").alias("state_batch"))  # reads partition values; one row a bucket
        return found.join(F.broadcast(newest), ["state_bucket", "state_batch"])

    def apply(self, changes: DataFrame, batch: int) -> None:
        """Bring the table forward by one batch of changes. Batches are numbered upwards from 0."""
        if changes.isEmpty():
            return
        spark = changes.sparkSession
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        fresh = self._state(changes).withColumn("state_bucket", bucket)
        stored = self._stored(spark, batch)
        if stored is not None:
            touched = fresh.select("state_bucket").distinct()  # `buckets` rows at most
            old = stored.join(F.broadcast(touched), "state_bucket", "left_semi").select(*self.key, "_top", "_top_delete", "_last", "_row")
            fresh = self._merged(old.unionByName(fresh.drop("state_bucket"))).withColumn("state_bucket", bucket)
        out = fresh.hint("rebalance", "state_bucket").write.mode("overwrite").partitionBy("state_bucket")
        out.parquet(f"{self.path}/state_batch={batch}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Follow a stream of changes up to what has arrived by now; run it again for what arrives later."""
        return (
            stream.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def current(self, spark: SparkSession, delete_rule: str = "latest") -> DataFrame:
        """The live row per key, by the rules of `current_state`."""
        stored = self._stored(spark)
        if stored is None:
            raise FileNotFoundError(f"no batch was written to {self.path}")
        if delete_rule == "latest":
            return stored.where(F.col(f"_last.{self.op}") != "D").select(*self.key, "_last.*")
        if delete_rule != "max_seq":
            raise ValueError(f"unknown delete_rule {delete_rule!r}")
        tombstoned = F.coalesce(F.col("_top") == F.col("_top_delete"), F.lit(False))
        return stored.where(F.col("_row").isNotNull() & ~tombstoned).select(*self.key, "_row.*")

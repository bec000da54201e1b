"""Change-data streams → validity history, current state and attribute changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cells import SHARED_BYTES, cell_of, same_keys, shared_bounds
from .dedupe import latest_per_key, tie_breakers
from .sizing import bounded_side

# Fixed value: end of an open validity interval.
OPEN_END = "9999-12-31 00:00:00"


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def scd2(df: DataFrame, key: str | Sequence[str], ts: str, seq: str, op: str,
         end: str = OPEN_END, busy_above: int = 4096) -> DataFrame:
    """Half-open validity intervals `[valid_from, valid_to)` from an I/U/D stream.

    A version ends at the key's next change of any kind, so a delete closes a version and opens
    none, and an update after a delete opens a new one. Of several changes at one instant only the
    last captured one can have a non-empty interval, so the others go first (before the shuffle).

    The changes of a busy key (more than `busy_above`) are dealt to cells of about equally many
    changes (see `shared_bounds`). The next change is looked up inside a key's cell and then across the
    key's cells: the second window holds one row per key and cell, some SHARED at most. So a key that
    owns a third of the stream is spread over tasks however its changes are spread over time.

    The bounds are drawn from the stream's keys and times, not from the deduplicated changes, and broadcast: the
    changes are shuffled whole once to lose copies and once to be ordered, whatever a query on the history filters.
    """
    keys = _as_list(key)
    dated = df.where(F.col(ts).isNotNull())
    last = latest_per_key(dated, [*keys, ts], [seq], nulls="first")
    mine = [f"_b_{k}" for k in keys]
    bounds = bounded_side(shared_bounds(dated.select(*keys, ts), keys, ts, busy_above), SHARED_BYTES)
    dealt = last.join(bounds, same_keys(keys, mine), "left").select(*last.columns, cell_of(F.col(ts)).alias("_cell"))
    in_cell = Window.partitionBy(*keys, "_cell").orderBy(ts)
    stepped = dealt.withColumn("_next", F.lead(ts).over(in_cell)).withColumn("_opens", F.first(ts).over(in_cell))
    across = Window.partitionBy(*keys).orderBy("_cell")
    inside = stepped.where(F.col("_next").isNotNull())
    cell_ends = stepped.where(F.col("_next").isNull()).withColumn("_next", F.lead("_opens").over(across))

    return (
        inside.unionByName(cell_ends)
        .where(F.col(op).isin("I", "U"))
        .withColumn("valid_to", F.coalesce(F.col("_next"), F.lit(end).cast("timestamp_ntz")))
        .withColumnRenamed(ts, "valid_from")
        .where("valid_from < valid_to")
        .drop("_cell", "_next", "_opens")
    )


def current_state(df: DataFrame, key: str | Sequence[str], ts: str, seq: str, op: str,
                  delete_rule: str = "latest") -> DataFrame:
    """The live row per key.

    `latest`: the newest change by (ts, seq) decides; a delete there removes the key.
    `max_seq`: the highest capture sequence decides whether the key is deleted, while the
    attributes come from the newest non-delete by (ts, seq). This is the rule for streams whose
    deletes repeat the insert's time. One shuffle, with map-side combining.
    """
    keys = _as_list(key)
    if delete_rule == "latest":
        return latest_per_key(df, keys, [ts, seq]).where(F.col(op) != "D")
    if delete_rule != "max_seq":
        raise ValueError(f"unknown delete_rule {delete_rule!r}")

    is_delete = F.col(op) == "D"
    rest = [c for c in df.columns if c not in (*keys, ts, seq)]
    orderable = set(tie_breakers(df, [*keys, ts, seq]))
    if not orderable.issuperset(rest):
        raise TypeError(f"columns cannot be ordered: {sorted(set(rest) - orderable)}")
    grouped = df.groupBy(*keys).agg(
        F.max(seq).alias("_top"),
        F.max(F.when(is_delete, F.col(seq))).alias("_top_delete"),
        F.max(F.when(F.col(op) != "D", F.struct(ts, seq, *rest))).alias("_row"),
    )
    tombstoned = F.coalesce(F.col("_top") == F.col("_top_delete"), F.lit(False))
    return grouped.where(F.col("_row").isNotNull() & ~tombstoned).select(*keys, "_row.*").select(*df.columns)


def tombstoned_keys(df: DataFrame, key: str | Sequence[str], seq: str, op: str) -> DataFrame:
    """Keys whose highest capture sequence belongs to a delete."""
    return (
        df.groupBy(*_as_list(key))
        .agg(F.max(seq).alias("_top"), F.max(F.when(F.col(op) == "D", F.col(seq))).alias("_top_delete"))
        .where("_top = _top_delete")
        .select(*_as_list(key))
    )


def version_changes(versions: DataFrame, key: str, attr: str, carry: Sequence[str] = ()) -> DataFrame:
    """Attribute changes between versions that touch: (key, changed_at, <attr>_from, <attr>_to).

    A version contributes its two boundaries; a change is a boundary where one version ends and
    another starts with a different value. Grouping by (key, boundary) needs one shuffle, reads the
    history once and stays balanced however many versions one key has. A gap left by a delete has
    no shared boundary, so it is no change. `carry` columns come from the version that ends.
    """
    ends = F.struct(
        F.col("valid_to").alias("at"), F.lit(True).alias("closes"), F.col(attr).alias("value"), *carry
    )
    starts = F.struct(
        F.col("valid_from").alias("at"), F.lit(False).alias("closes"), F.col(attr).alias("value"), *carry
    )
    sides = versions.select(key, F.explode(F.array(ends, starts)).alias("b"))
    met = sides.groupBy(key, F.col("b.at").alias("changed_at")).agg(
        F.max(F.when(F.col("b.closes"), F.struct("b.value", *[f"b.{c}" for c in carry]))).alias("old"),
        F.max(F.when(~F.col("b.closes"), F.struct("b.value"))).alias("new"),
    )
    return met.where(
        F.col("old").isNotNull() & F.col("new").isNotNull() & ~F.col("old.value").eqNullSafe(F.col("new.value"))
    ).select(
        key,
        "changed_at",
        F.col("old.value").alias(f"{attr}_from"),
        F.col("new.value").alias(f"{attr}_to"),
        *[F.col(f"old.{c}").alias(c) for c in carry],
    )

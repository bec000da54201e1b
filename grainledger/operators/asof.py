"""Join facts to the dimension version in force at the fact's time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import SHARED_BYTES, STRIDE, cell_of, shared_bounds
from .sizing import bounded_side, lookup_side


def asof_join(fact: DataFrame, versions: DataFrame, key: str, ts: str, cols: Mapping[str, str],
              busy_above: int = 32) -> DataFrame:
    """Left join: each fact row gets `cols` of the version with `valid_from <= ts < valid_to`.

    Intervals of one key must not overlap (see `scd2`), so the row count of `fact` is preserved.
    `cols` maps version columns to output names; `key` has the same name on both sides.

    Joining on the key and checking the interval compares every fact with every version of its key.
    That is right for the many keys with few versions, and quadratic for one that owns a large part
    of both sides. So the versions of the busiest keys (more than `busy_above`) are dealt to cells of
    about equally many starts (see `shared_bounds`): a version is listed in every cell it reaches
    into, which at most doubles the rows, and a fact falls into one cell. All other keys have the
    single cell 0. A cell's versions become one sorted list, which a fact joins by key and cell and
    looks up: the last start up to its time, among every STRIDE-th start first. The cells spread a hot
    key over tasks; what is still hot is left to adaptive skew handling, which may split the facts of
    a left join.

    The bounds are few at any size and are broadcast, so the facts are shuffled once, for the lists;
    not at all when three times the history's estimated size is inside Spark's broadcast threshold
    (Spark's own estimate of a joined side is a product and never is) and the lists are broadcast too.
    """
    right = versions.select(
        F.col(key).alias("_vkey"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[F.col(src).alias(out) for src, out in cols.items()],
    ).where("_from < _to")
    # always true; it reads every column, so that the shuffles behind the history serve the bounds and the lists
    whole = right.where("_vkey IS NOT NULL").where(F.hash(*cols.values()) >= F.lit(-(1 << 31)))
    bounds = shared_bounds(whole, ["_vkey"], "_from", busy_above)
    bounds = bounded_side(bounds, SHARED_BYTES)
    last = F.col("_to") - F.expr("INTERVAL '0.000001' SECOND")  # no time lies between this and the end
    listed = right.join(bounds, F.col("_vkey") == F.col("_b__vkey"), "left").select(
        *right.columns, F.explode(F.sequence(cell_of(F.col("_from")), cell_of(last))).alias("_vcell")
    )
    version = F.struct("_from", "_to", F.struct(*cols.values()).alias("_as"))
    lists = listed.groupBy("_vkey", "_vcell").agg(F.array_sort(F.collect_list(version)).alias("_list"))
    every = F.sequence(F.lit(1), F.size("_list"), F.lit(STRIDE))
    starts = F.transform(every, lambda i: F.element_at("_list", i)["_from"])
    lists = lists.withColumn("_starts", F.when(F.size("_list") > 2 * STRIDE, starts))
    placed = fact.join(bounds, F.col(key) == F.col("_b__vkey"), "left").select(
        *[fact[c] for c in fact.columns], cell_of(F.col(ts)).alias("_cell")
    )
    on = (F.col(key) == F.col("_vkey")) & (F.col("_cell") == F.col("_vcell"))
    joined = placed.join(lookup_side(lists, versions, copies=3), on, "left")
    block = F.greatest(F.size(F.filter("_starts", lambda s: s <= F.col(ts))), F.lit(1))
    near = F.when(F.col("_starts").isNull(), F.col("_list")).otherwise(F.slice("_list", (block - 1) * STRIDE + 1, F.lit(STRIDE)))
    found = F.get(F.filter(near, lambda v: (v["_from"] <= F.col(ts)) & (F.col(ts) < v["_to"])), F.lit(0))
    in_force = joined.select(*fact.columns, found["_as"].alias("_as"))
    return in_force.select(*fact.columns, *[F.col(f"_as.{out}").alias(out) for out in cols.values()])

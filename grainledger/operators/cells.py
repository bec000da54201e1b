"""Cells of about equally many values, cut from the data, over which a large group's ordered work is spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import bounded_side

#: Cells of a large group, and bounds that are compared one by one when a value's cell is looked up.
CELLS, STRIDE = 1024, 32
#: Bounds of all groups together, and groups that have some, where bounds are broadcast. An estimate of their bytes at most.
SHARED, LARGEST, SHARED_BYTES = 1 << 13, 1024, 1 << 18


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def cell_bounds(rows: DataFrame, keys: Sequence[str], value: str, above: int, named: str = "_b_") -> DataFrame:
    """(prefixed keys…, _bounds, _coarse): for every group of more than `above` rows the sorted values that cut it.

    A value is a bound if its hash is divisible by the group's rows per cell. So about CELLS of them are drawn
    whatever the values' distribution: a burst gets as many cells as its share of the rows. And the draw depends on
    the values alone, so all parts of a plan, and repeated tasks, see the same bounds. A group of at most CELLS rows
    has every value as a bound. _coarse holds every STRIDE-th bound.
    """
    mine = [f"{named}{k}" for k in keys]
    present = rows.where(F.col(value).isNotNull())
    large = present.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, mine)]).agg(F.count("*").alias("_rows"))
    large = large.where(F.col("_rows") > above)
    drawn = present.join(large, same_keys(keys, mine)).where(
        F.pmod(F.xxhash64(value), F.ceil(F.col("_rows") / CELLS)) == 0
    )
    sorted_bounds = F.array_sort(F.collect_set(value))  # about CELLS values
    return _with_coarse(drawn.groupBy(*mine).agg(sorted_bounds.alias("_bounds")))


def cell_of(value: Column) -> Column:
    """The number of bounds up to a value, in a frame that holds _bounds and _coarse; 0 without bounds or value."""
    upto = lambda bounds: F.size(F.filter(bounds, lambda b: b <= value))
    stretch = lambda n: F.slice("_bounds", (n - 1) * STRIDE + 1, F.lit(STRIDE))
    at = F.transform(F.array(upto(F.col("_coarse"))), lambda n: F.when(n > 0, (n - 1) * STRIDE + upto(stretch(n))).otherwise(0))
    return F.when(F.col("_bounds").isNull() | value.isNull(), F.lit(0)).otherwise(at[0])


def shared_bounds(rows: DataFrame, keys: Sequence[str], value: str, above: int, named: str = "_b_") -> DataFrame:
    """Like `cell_bounds`, with SHARED bounds for all groups together, about: at any size a frame that can be broadcast.

    The LARGEST groups of more than `above` rows get them, one for every so many rows. What is left, a cell or a whole
    group, has about 1 / SHARED of these groups' rows, or 1 / LARGEST at most where more groups than that are as large.
    """
    mine = [f"{named}{k}" for k in keys]
    present = rows.where(F.col(value).isNotNull())
    large = present.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, mine)]).agg(F.count("*").alias("_rows"))
    large = large.where(F.col("_rows") > above).orderBy(F.desc("_rows"), *mine).limit(LARGEST)
    every = F.ceil(F.sum("_rows").over(Window.partitionBy()) / SHARED)  # over LARGEST rows
    large = bounded_side(large.select(*mine, every.alias("_every")), SHARED_BYTES)
    drawn = present.join(large, same_keys(keys, mine)).where(F.pmod(F.xxhash64(value), F.col("_every")) == 0)
    return _with_coarse(drawn.groupBy(*mine).agg(F.array_sort(F.collect_set(value)).alias("_bounds")))


def _with_coarse(bounds: DataFrame) -> DataFrame:
    every = F.sequence(F.lit(1), F.size("_bounds"), F.lit(STRIDE))
    return bounds.withColumn("_coarse", F.transform(every, lambda i: F.element_at("_bounds", i)))

"""Several versions of one total, side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum, round_to


def series_recon(series: Mapping[str, tuple[DataFrame, Sequence[Column], str]], keys: Sequence[str],
                 gaps: Mapping[str, tuple[str, str]] = {}) -> DataFrame:
    """Totals of each series per key, and named gaps `a − b` between them.

    `series` maps a name to (frame, key expressions in the order of `keys`, value column). The
    series are stacked and summed in one grouping: one shuffle of partial sums instead of a chain
    of full outer joins, and a cell that is missing from a series stays NULL there, as do its gaps.
    """
    names = list(series)

    def lane(name: str) -> DataFrame:
        df, exprs, value = series[name]
        return df.select(
            *[e.alias(k) for k, e in zip(keys, exprs, strict=True)],
            *[(F.col(value) if n == name else F.lit(None)).cast("double").alias(f"_{n}") for n in names],
        )

    stacked = reduce(DataFrame.unionByName, [lane(n) for n in names])
    totals = stacked.groupBy(*keys).agg(*[round_to(exact_sum(f"_{n}"), 2).alias(n) for n in names])
    return totals.select("*", *[round_to(F.col(a) - F.col(b), 2).alias(g) for g, (a, b) in gaps.items()])

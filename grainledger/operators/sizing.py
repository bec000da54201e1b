"""The size check in front of every broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _threshold(df: DataFrame) -> int:
    if not hasattr(df, "_jdf"):  # no JVM behind the frame (Spark Connect)
        return -1
    return int(str(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))


def fits_broadcast(df: DataFrame, copies: int = 1) -> bool:
    """Whether `copies` times Spark's size estimate of `df` is inside its broadcast threshold."""
    limit = _threshold(df)
    if limit < 0:
        return False
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 0 < copies * size <= limit


def lookup_side(df: DataFrame, *sources: DataFrame, copies: int = 1) -> DataFrame:
    """`df` for the small side of a join, marked for broadcast when its sources are small.

    Spark estimates a joined relation as the product of its inputs, so it would shuffle the facts
    even for two tiny lookups. `sources` are what `df` was made of and `copies` bounds how often a
    source row can occur in it. Beyond the threshold `df` is returned as it is and the join shuffles.
    """
    return F.broadcast(df) if all(fits_broadcast(s, copies * len(sources)) for s in sources) else df


def bounded_side(df: DataFrame, most: int) -> DataFrame:
    """`df`, of at most `most` bytes by the way it is made, marked for broadcast when the threshold allows as much."""
    return F.broadcast(df) if most <= _threshold(df) else df

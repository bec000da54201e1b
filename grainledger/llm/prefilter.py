"""Keep rows that a join would drop anyway out of its shuffle, by a bitmap of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import fresh

#: Bits of the map: 4 MB at any size of input. With far more ids than this it lets everything through.
BITMAP = 1 << 25


def _spot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP))


def bitmap(ids: DataFrame) -> np.ndarray:
    """The spots of a frame's only column, as 64-bit words."""
    spot = _spot(F.col(ids.columns[0]))
    at = ids.select(spot.alias("spot")).selectExpr("cast(spot div 64 as int) AS at", "shiftleft(1L, cast(spot % 64 AS int)) AS bit")
    found = at.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most BITMAP / 64 rows
    out = np.zeros(BITMAP // 64, np.int64)
    out[np.asarray(found["at"])] = np.asarray(found["bits"])
    return out


def likely(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key may be among the ids: none that is gets lost, some others come along."""
    (spot,) = fresh(rows, "spot")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(ids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column(batch.num_columns - 1))
            held = shared.value[at // 64] >> (at % 64) & 1
            rest = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            yield rest.filter(pa.array(held.astype(bool)))

    return rows.withColumn(spot, _spot(F.col(key))).mapInArrow(work, rows.schema)

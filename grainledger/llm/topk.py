"""Exact top-k search by inner product: tiles of queries times shards, the best of each tile, merged in a tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle

#: Vectors of a shard and queries of a block, at most, and the bytes that they may take (packed, as 64-bit integers).
SHARD, BLOCK = 32_768, 4_096
SHARD_BYTES, BLOCK_BYTES = 1 << 24, 1 << 21
#: Top lists of one query that one merge takes in.
FAN_IN = 16
#: Queries that are multiplied with a shard at once.
STRIP = 128


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(own, vec_id, v): floor(scale * x) of every component as packed 64-bit integers, for the vectors that take part.

    own numbers the rows, so that rows with one vec_id are told apart; write the frame before it is used twice.
    """
    parts = F.col("embedding").cast("array<double>")
    ids = F.col("vec_id").cast("long").alias("vec_id")
    usable = vectors.select(ids, parts.alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    usable = usable.where(
        ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    one = usable.select(F.monotonically_increasing_id().alias("own"), "vec_id", "embedding")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat = np.floor(np.asarray(column.flatten(), float) * scale)
            if len(flat) and np.abs(flat).max() >= 2.0**63:
                raise OverflowError("a scaled component does not fit into 64 bits")
            flat = flat.astype("<i8")
            ends = np.cumsum(np.asarray(column.value_lengths()))
            packed = [flat[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["own", "vec_id", "v"])

    return one.mapInArrow(work, "own long, vec_id long, v binary")


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where all sums stay below 2**53."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * queries.shape[1]
    if bound < 2.0**53:
        return (queries.astype(float) @ shard.T.astype(float)).astype(np.int64)
    if bound >= 2.0**63:
        raise OverflowError("an inner product does not fit into 64 bits")
    return queries @ shard.T


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """[row, k] places of the largest scores of each row; of equal ones the first places. int64 min is no score."""
    n = scores.shape[1]
    k = min(k, n)
    bits = max(1, n - 1).bit_length()
    room = np.iinfo(np.int64).min
    held = scores == room
    if np.abs(np.where(held, 0, scores)).max(initial=0) < 2 ** (61 - bits):
        rank = np.where(held, room, (scores << bits) + (n - 1 - np.arange(n)))
        top = np.argpartition(rank, n - k, axis=1)[:, n - k :]
    else:
        top = np.lexsort((np.broadcast_to(-np.arange(n), scores.shape), scores), axis=1)[:, n - k :]
    return top


_LIST = ("asker", "query_id", "vec_id", "score", "part")
_NOTHING = pa.schema([(c, pa.int64()) for c in _LIST]).empty_table()


def _tile(k: int):
    def work(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if not len(left) or not len(right):
            return _NOTHING
        ids, row = np.asarray(left["vec_id"]), np.asarray(left["own"])
        owners, askers = np.asarray(right["query_id"]), np.asarray(right["asker"])
        sizes = np.array([len(x) for x in left["v"].to_pylist()], int)
        wants = np.array([len(x) for x in right["q"].to_pylist()], int)
        for size in np.intersect1d(sizes, wants).tolist():
            rows, asks = np.flatnonzero(sizes == size), np.flatnonzero(wants == size)
            rows = rows[np.argsort(ids[rows], kind="stable")]
            unpack = lambda c, at: np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), "<i8").reshape(len(at), size // 8)
            shard, own = unpack(left["v"], rows), ids[rows]
            by_row = np.argsort(row[rows])
            sorted_rows = row[rows][by_row]
            for i in range(0, len(asks), STRIP):
                some = asks[i : i + STRIP]
                scores = products(unpack(right["q"], some), shard)
                at = np.minimum(np.searchsorted(sorted_rows, askers[some]), len(own) - 1)
                mine = np.flatnonzero(sorted_rows[at] == askers[some])  # a query is not its own candidate
                scores[mine, by_row[at[mine]]] = np.iinfo(np.int64).min
                top = best(scores, k)
                found = np.take_along_axis(scores, top, axis=1)
                real = found != np.iinfo(np.int64).min
                out[0].append(np.broadcast_to(askers[some][:, None], top.shape)[real])
                out[1].append(np.broadcast_to(owners[some][:, None], top.shape)[real])
                out[2].append(own[top][real])
                out[3].append(found[real])
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        shard_no = np.full(len(flat[0]), key[0].as_py(), np.int64)
        return pa.table([*map(pa.array, flat), pa.array(shard_no)], names=_LIST)

    return work


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of every query with all other vectors.

    Components x become floor(scale * x). Queries are the rows whose vec_id is divisible by `every`; ties go to the
    smaller vec_id; a query with fewer than k candidates gets them all.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows without vec_id. Rows that
    share a vec_id are candidates each, of each other too, and each of them is a query of its own. Vectors of unlike length are no candidates of each other.
    A product beyond 64 bits raises. An empty table gives no rows; extra columns are not looked at.
    """
    ready = settle(integer_vectors(vectors, scale), "vectors")
    asks = ready.where(F.pmod("vec_id", F.lit(every)) == 0)
    held = ready.agg(F.count("*").alias("n"), F.max(F.octet_length("v")).alias("size")).first()
    rows = lambda most, size: max(1, min(most, size // max(held.size or 1, 1)))
    shards, blocks = max(1, -(-held.n // rows(SHARD, SHARD_BYTES))), max(1, -(-asks.count() // rows(BLOCK, BLOCK_BYTES)))
    place = lambda seed, count: F.pmod(F.xxhash64("own", F.lit(seed)), F.lit(count))
    every_of = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    left = ready.select(place(1, shards).alias("shard"), "own", "vec_id", "v").select("shard", every_of(blocks).alias("block"), "own", "vec_id", "v")
    named = (F.col("own").alias("asker"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))  # a cogroup must not share columns
    right = asks.select(place(2, blocks).alias("block"), *named).select(every_of(shards).alias("shard"), "block", "asker", "query_id", "q")
    lists = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        _tile(k), ", ".join(f"{c} long" for c in _LIST)
    )
    order = [F.desc("score"), F.asc("vec_id")]
    while shards > FAN_IN:
        group = lists.withColumn("part", F.floor(F.col("part") / FAN_IN))
        place_in = F.row_number().over(Window.partitionBy("asker", "part").orderBy(*order))
        lists = group.withColumn("rank", place_in).where(F.col("rank") <= k).drop("rank")
        shards = -(-shards // FAN_IN)
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("asker").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

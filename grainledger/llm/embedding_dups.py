"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, reranking with the original vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, forest
from .storage import settle

#: Distinct vectors that the rotations are learned from, and components of all of them, at most. Every vector is indexed.
SAMPLE, SAMPLE_COMPONENTS = 8_192, 1 << 22
#: Rounds of learning a rotation, the sampled vectors from which on a mean is trusted, and tables at most.
ROUNDS, CENTRED, MOST_TABLES = 40, 1_000, 64
#: Differing bits within which two words of a table meet: each vector is listed under all words one bit away.
REACH = 2
#: Rows of a bucket that are compared in one place; larger buckets are cut into parts, and every two parts meet.
PART = 2_048
#: Pairs of codes, and components of vectors, that are compared at once.
CODES, COMPONENTS = 1 << 20, 1 << 22


# --- codes ----------------------------------------------------------------------------------------


def rotation(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A matrix whose products with centred rows have signs that lie close to the rotated values (ITQ)."""
    _, _, axes = np.linalg.svd(x.T @ x)
    v = x @ axes.T
    r, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
    for _ in range(ROUNDS):
        u, _, w = np.linalg.svd(v.T @ np.where(v @ r >= 0, 1.0, -1.0))
        r = u @ w
    return axes.T @ r


class Codes:
    """Words of `bits` bits, one for each table, from the signs of centred and rotated unit vectors."""

    def __init__(self, mean: np.ndarray, matrix: np.ndarray, bits: int, reach: int) -> None:
        self.mean, self.matrix, self.bits, self.reach = mean, matrix, bits, reach

    def parts(self) -> tuple[np.ndarray, np.ndarray, int, int]:
        """What a broadcast holds: executors need not have this package."""
        return self.mean, self.matrix, self.bits, self.reach

    @property
    def tables(self) -> int:
        return self.matrix.shape[1] // self.bits

    def words(self, unit: np.ndarray) -> np.ndarray:
        """[vector, table] unsigned words."""
        signs = ((unit - self.mean) @ self.matrix >= 0).reshape(len(unit), self.tables, self.bits)
        return (signs.astype(np.uint32) << np.arange(self.bits, dtype=np.uint32)).sum(2, dtype=np.uint32)

    @classmethod
    def learn(cls, unit: np.ndarray, rows: int, threshold: float, target: float, seed: int = 11) -> Codes:
        """As many tables as find `target` of the pairs that lie exactly at the threshold.

        The pairs are made: every sampled vector gets a partner at that cosine in a random direction. The words are
        as long as the table is large (about one bucket for each row), so buckets do not grow with the input.
        Vectors are centred, for balanced bits, unless that takes more tables (where all lie close to their mean, or
        the sample is too small to tell).
        """
        rng = np.random.default_rng(seed)
        bits = int(np.clip(math.ceil(math.log2(max(rows, 2))), 12, 24))
        other = rng.standard_normal(unit.shape)
        other -= (other * unit).sum(1, keepdims=True) * unit
        length = np.linalg.norm(other, axis=1, keepdims=True)
        partner = threshold * unit + math.sqrt(1 - threshold**2) * other / np.where(length > 0, length, 1)
        plain = cls._fitted(unit, partner, np.zeros(unit.shape[1]), bits, target, rng)
        if len(unit) < CENTRED:
            return plain
        centred = cls._fitted(unit, partner, unit.mean(0), bits, target, rng)
        return centred if centred.tables <= plain.tables else plain

    @classmethod
    def _fitted(cls, unit: np.ndarray, partner: np.ndarray, mean: np.ndarray, bits: int, target: float, rng: np.random.Generator) -> Codes:
        matrix = np.zeros((unit.shape[1], 0))
        while True:
            matrix = np.hstack([matrix, rotation(unit - mean, rng)])
            codes = cls(mean, matrix[:, : matrix.shape[1] // bits * bits], bits, 0)
            if not codes.tables:
                continue
            apart = np.bitwise_count(codes.words(unit) ^ codes.words(partner))
            met = np.logical_or.accumulate(apart <= REACH, axis=1)
            enough = np.flatnonzero(met.mean(0) >= target)
            if len(enough) or codes.tables >= MOST_TABLES:
                tables = int(enough[0]) + 1 if len(enough) else codes.tables
                found = met[:, tables - 1]
                reach = int(apart[found, :tables].sum(1, dtype=int).max(initial=REACH * tables))
                return cls(mean, matrix[:, : tables * bits], bits, reach)


def unit_rows(column: pa.Array, size: int) -> np.ndarray:
    """[vector, component] of length one; scaled first, so that no square overflows."""
    x = np.asarray(column.flatten(), float).reshape(-1, size)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- buckets --------------------------------------------------------------------------------------

_KEY = ("size", "tab", "word", "i", "j")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by bucket, in whole buckets (of 2 * PART rows at most): the rows and where buckets begin."""
    held: pa.Table | None = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        start = _starts(held)
        if len(start) > 1:
            yield held.slice(0, int(start[-1])), start[:-1]
            held = held.slice(int(start[-1])).combine_chunks()
    if held is not None and len(held):
        yield held, _starts(held)


def _starts(rows: pa.Table) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in _KEY:
        new[1:] |= np.diff(np.asarray(rows[name].combine_chunks())) != 0
    return np.flatnonzero(new)


def _pairs(rows: pa.Table, start: np.ndarray, codes: Codes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs that are to be compared in these buckets, some at a time.

    Two vectors meet in several buckets; they are compared in the first table in which their words are near, under
    the smallest word that both are listed under. Pairs whose codes are too far apart are left out.
    """
    n = len(rows)
    column = lambda name: np.asarray(rows[name].combine_chunks()).astype(np.int64)
    part, i, j, tab, key = (column(c) for c in ("part", "i", "j", "tab", "word"))
    words = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint32).reshape(n, codes.tables)
    stop = np.append(start[1:], n)
    bucket = np.repeat(np.arange(len(start)), stop - start)
    firsts = np.add.reduceat((part == i).astype(np.int64), start)  # rows of part i come first
    split = (i != j)
    begin = np.where(split, start[bucket] + firsts[bucket], np.arange(n) + 1)
    count = np.where(split & (part != i), 0, stop[bucket] - begin)
    total = np.cumsum(count)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CODES, "right")))
        some = count[at:to]
        p = np.repeat(np.arange(at, to), some)
        q = np.arange(len(p)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(begin[at:to], some)
        at = to
        diff = words[p] ^ words[q]
        apart = np.bitwise_count(diff)
        near = apart <= REACH
        t = tab[p]
        keep = np.flatnonzero(near[np.arange(len(p)), t] & (near.argmax(1) == t) & (apart.sum(1, dtype=int) <= codes.reach))
        p, q, t = p[keep], q[keep], t[keep]
        a, d = words[p, t].astype(np.int64), diff[keep, t].astype(np.int64)
        low = d & -d
        meet = np.where(np.bitwise_count(d) == 2, np.minimum(a ^ low, a ^ low ^ d), np.minimum(a, a ^ d))
        keep = meet == key[p]
        yield p[keep], q[keep]


def _listing(vectors: DataFrame, models: dict[int, Codes]) -> DataFrame:
    """Every vector under its word and all words one bit away, in every table."""
    shared = _broadcast(vectors, models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column(1))
            for one in np.unique(size).tolist():
                codes, rows = Codes(*shared.value[one]), np.flatnonzero(size == one)
                for some in (rows[k : k + 4096] for k in range(0, len(rows), 4096)):
                    part = batch.take(pa.array(some))
                    words = codes.words(unit_rows(part.column(2), one))
                    flips = np.append(np.uint32(0), np.uint32(1) << np.arange(codes.bits, dtype=np.uint32))
                    keys = words[:, :, None] ^ flips
                    copies = codes.tables * len(flips)
                    node = np.repeat(np.arange(len(some)), copies)
                    code = pa.array([w.tobytes() for w in words], pa.binary())
                    yield pa.record_batch([
                        pa.array(np.full(len(node), one, np.int32)),
                        pa.array(np.tile(np.repeat(np.arange(codes.tables, dtype=np.int32), len(flips)), len(some))),
                        pa.array(keys.ravel().astype(np.int32)),
                        part.column(0).take(pa.array(node)), code.take(pa.array(node)),
                    ], names=["size", "tab", "word", "node", "code"])

    return vectors.select("node", "size", "embedding").mapInArrow(work, "size int, tab int, word int, node long, code binary")


def _tiles(listing: DataFrame, part: int) -> DataFrame:
    """The listing with (i, j, part): large buckets are cut into parts, and every row goes to the tiles of its part."""
    sizes = listing.groupBy("size", "tab", "word").count().where(F.col("count") > part)
    large = sizes.select("size", "tab", "word", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    own = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    placed = listing.join(large, ["size", "tab", "word"], "left").withColumn("part", own)
    other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    placed = placed.withColumn("other", other).withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    return placed.select(*_KEY, "part", "node", "code")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_KEY).sortWithinPartitions(*_KEY, "part")


def _candidates(tiles: DataFrame, models: dict[int, Codes]) -> DataFrame:
    """The rows of the tiles that have a partner there, by their codes."""
    shared = _broadcast(tiles, models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, start in _runs(batches):
            for some, begin, codes in _by_size(rows, start, shared.value):
                wanted = np.zeros(len(some), bool)
                for p, q in _pairs(some, begin, codes):
                    wanted[p] = wanted[q] = True
                yield from some.filter(pa.array(wanted)).to_batches()

    return _dealt(tiles).mapInArrow(work, tiles.schema)


def _broadcast(rows: DataFrame, models: dict[int, Codes]) -> Broadcast:
    """The models' matrices: one for each length of vectors, of a few times its square."""
    return rows.sparkSession.sparkContext.broadcast({size: codes.parts() for size, codes in models.items()})


def _by_size(rows: pa.Table, start: np.ndarray, models: dict[int, tuple]) -> Iterator[tuple[pa.Table, np.ndarray, Codes]]:
    size = np.asarray(rows["size"].combine_chunks())
    cut = np.flatnonzero(np.diff(size, prepend=-1, append=-1))
    for a, b in zip(cut, cut[1:]):
        yield rows.slice(a, b - a), start[(start >= a) & (start < b)] - a, Codes(*models[int(size[a])])


def _links(candidates: DataFrame, vectors: DataFrame, models: dict[int, Codes], threshold: float) -> DataFrame:
    """(a, b, n): with b null, n vectors linked to a; otherwise a link, as many as connect what is linked."""
    shared = _broadcast(candidates, models)
    joined = candidates.join(vectors.select("node", "embedding", "copies"), "node").select(*_KEY, "part", "node", "code", "embedding", "copies")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, start in _runs(batches):
            for some, begin, codes in _by_size(rows, start, shared.value):
                size = some["size"][0].as_py()
                unit = unit_rows(some["embedding"].combine_chunks(), size)
                node, copies = (np.asarray(some[c].combine_chunks()) for c in ("node", "copies"))
                n, first, second = np.zeros(len(some), np.int64), [], []
                step = max(1, COMPONENTS // size)
                for p, q in _pairs(some, begin, codes):
                    for k in range(0, len(p), step):
                        x, y = p[k : k + step], q[k : k + step]
                        linked = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
                        x, y = x[linked], y[linked]
                        np.add.at(n, x, copies[y])
                        np.add.at(n, y, copies[x])
                        a, b = forest(node[x], node[y])
                        first.append(a)
                        second.append(b)
                own = np.flatnonzero(n)
                yield _rows(node[own], None, n[own])
                if first:
                    yield _rows(*forest(np.concatenate(first), np.concatenate(second)), None)

    return _dealt(joined).mapInArrow(work, "a long, b long, n long")


def _rows(a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    columns = [pa.array(a), *(none if x is None else pa.array(x) for x in (b, n))]
    return pa.record_batch(columns, names=["a", "b", "n"])


# --- the operator ---------------------------------------------------------------------------------


def learn(vectors: DataFrame, threshold: float, target: float) -> dict[int, Codes]:
    """A code for each length of vectors, from at most SAMPLE of them (those with the smallest hashes)."""
    models = {}
    for row in vectors.groupBy("size").count().collect():  # one row for each length
        most = max(2, min(SAMPLE, SAMPLE_COMPONENTS // row.size))
        sample = vectors.where(F.col("size") == row.size).orderBy(F.xxhash64("embedding"), "node").limit(most).select("embedding").toArrow()
        models[row.size] = Codes.learn(unit_rows(sample["embedding"].combine_chunks(), row.size), row["count"], threshold, target)
    return models


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, target: float = 0.97, part: int = PART) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row: links are pairs found whose cosine is `threshold` or more.

    No pair below the threshold is linked; of those that lie at it, about `target` are found, and more of the closer
    ones. Equal vectors are always linked: they are one vector with copies, and their pairs are never listed.
    Rows whose vector is null, empty, zero, or holds a null or non-finite component link with nothing, nor do vectors of
    unlike length. A row without vec_id takes no part and gets no component; rows with one vec_id are vectors of their
    own with that id. An empty table gives no rows; extra columns are not looked at.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & ~odd & some, F.lit(False))
    rows = rows.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding"))
    one = rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    distinct = settle(one.select(F.monotonically_increasing_id().alias("node"), F.size("embedding").alias("size"), "*"), "vectors")

    models = learn(distinct, threshold, target)
    candidates = settle(_candidates(_tiles(_listing(distinct, models), part), models), "candidates")
    links = settle(_links(candidates, distinct, models, threshold), "links")
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("near"))
    linked = distinct.select("node", "first", "copies", "embedding").join(counts, "node", "left")
    linked = linked.join(components(links.where("b IS NOT NULL").select("a", "b")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    known = linked.join(least, "root").select(
        F.col("embedding").alias("same"), "component", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("near")
    )
    found = rows.join(known, F.col("embedding") == F.col("same"), "left")
    component = F.coalesce("component", "vec_id")
    return found.select(
        "vec_id", F.coalesce("near", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

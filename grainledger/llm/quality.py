"""Quality classifier: n-gram indicators scaled by class log-count ratios, under a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import Rows, hinge_by_dual_descent
from .storage import fresh
from .textscan import SPACE, mix, slices, span_hashes, spans, text_bytes

#: Hashed feature space; the class counts, ratios and weights are arrays of this length.
BITS = 18
#: Labelled rows of each class that the hinge-loss model is fitted on at most (drawn by a hash of the id). The class
#: counts behind the ratios come from all labelled rows.
FIT_ROWS = 3000
#: n-grams of this many words over shapes, and of characters around word ends.
SHAPE_WORDS = 3

_MULT = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _classes(data: np.ndarray) -> np.ndarray:
    """Each byte as a class: lower case, upper case, digit, beyond ASCII, or the sign itself."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 97, 65, 48, 200
    return table[data]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) once for each distinct n-gram of each row.

    Words are runs without white space. Their n-grams: single words, and 1 to 3 neighbouring word shapes; a shape is
    the case of the first and second letter, the last two bytes' classes, the length up to 8, and whether the word
    equals the one before it. So a style shows whatever its words are.
    """
    starts, ends, rows = spans(data, offsets, ~SPACE)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = span_hashes(data, starts, ends)
    kind = _classes(data).astype(np.uint64)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    last, size = ends - 1, ends - starts
    second = np.minimum(starts + 1, last)
    shape = kind[starts]
    for part in (kind[second], kind[np.maximum(last - 1, starts)], kind[last], np.minimum(size, 8), same):
        shape = shape * np.uint64(256) + np.asarray(part).astype(np.uint64)
    with np.errstate(over="ignore"):
        grams, owners = [hashes * _MULT[0]], [rows]
        running = np.zeros(len(shape), np.uint64)
        for n in range(SHAPE_WORDS):
            running = mix(running * _MULT[1] + np.roll(shape, -n) + np.uint64(n + 1))
            fits = np.ones(len(rows), bool)
            if n:
                fits[len(rows) - n :] = False
                fits[: len(rows) - n] = rows[n:] == rows[: len(rows) - n]
            grams.append(running[fits] * _MULT[2])
            owners.append(rows[fits])
    column = (mix(np.concatenate(grams)) >> np.uint64(64 - BITS)).astype(np.int64)
    keys = np.unique(np.concatenate(owners) * (1 << BITS) + column)
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _per_row(part: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    data, offsets = text_bytes(part.column(at))
    rows, columns = features(data, offsets)
    return rows, columns, len(offsets) - 1


@dataclass
class QualityModel:
    """score = logistic(slope * (weights . features / sqrt(n features) + bias)); the ratios are inside the weights."""

    weights: np.ndarray
    bias: float
    slope: float = 4.0

    def scores(self, part: pa.RecordBatch, at: int) -> np.ndarray:
        rows, columns, n = _per_row(part, at)
        count = np.bincount(rows, minlength=n)
        margin = np.bincount(rows, self.weights[columns], n) / np.sqrt(np.maximum(count, 1)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin, -40, 40)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is not held out (nor learned from)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, y) of the labels that may be learned from: one per id, 0 or 1, not held out.

    An id whose labels contradict each other, a null id and a null or other label are left out.
    """
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    one = one.where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out(F.col("doc_id")))
    return one.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")


def class_counts(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """[class, feature] counts of labelled texts that hold each feature; the last column counts the texts."""
    width = (1 << BITS) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, columns, n = _per_row(part, 0)
                y = np.asarray(part.column(1))
                for c in (0, 1):
                    sums[c, : width - 1] += np.bincount(columns[y[rows] == c], minlength=width - 1)
                    sums[c, width - 1] += (y == c).sum()
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.record_batch([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], names=["f", "n0", "n1"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    # a sort-merge join at every size: labels grow with the documents, so they are never broadcast
    texts = texts.where(~held_out(F.col("doc_id"))).join(labels.hint("merge"), "doc_id").select("text", "y")
    sums = texts.mapInArrow(work, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = sums.toArrow()  # at most one row for each of the hashed features
    out = np.zeros((2, width))
    out[0, np.asarray(found["f"])], out[1, np.asarray(found["f"])] = np.asarray(found["n0"]), np.asarray(found["n1"])
    return out


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """The model for `labels.quality` of the rows of docs that may be learned from.

    Log-count ratios compare how often each feature stands in the texts of either class, over all of them. The hinge
    loss is fitted on at most fit_rows texts a class, both classes weighing the same. Without texts of both classes
    every document scores 0.5.
    """
    known = training_labels(labels)
    counts = class_counts(docs, known)
    width = 1 << BITS
    if not counts[:, width].all():
        return QualityModel(np.zeros(width), 0.0)
    share = (counts[:, :width] + 1) / (counts[:, width:] + 2)
    ratio = np.log(share[1] / share[0])
    draw = F.xxhash64("doc_id", F.lit(7))
    sample = None
    # only labels of documents at hand are drawn from; both sides grow, so neither is broadcast
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    present = known.join(there.hint("merge"), "doc_id", "left_semi")
    for y in (0, 1):
        some = present.where(F.col("y") == y).orderBy(draw, "doc_id").limit(fit_rows)
        sample = some if sample is None else sample.union(some)
    picked = sample.toArrow()  # at most 2 * fit_rows pairs of numbers
    chosen = docs.sparkSession.createDataFrame(picked, "doc_id long, y int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, columns, n = _per_row(part, 0)
                ends = np.searchsorted(rows, np.arange(n), "right")
                begins = np.append(0, ends[:-1])
                grams = [columns[a:b].astype("<i4").tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.record_batch([part.column(1), part.column(2), pa.array(grams, pa.binary())], names=["doc_id", "y", "grams"])

    table = texts.select("text", "doc_id", "y").mapInArrow(work, "doc_id long, y int, grams binary").toArrow()
    order = np.asarray(pc.sort_indices(table["doc_id"]))
    columns = [np.frombuffer(table["grams"][i].as_buffer(), "<i4") for i in order.tolist()]
    truth = np.asarray(table["y"])[order]
    if len(set(truth.tolist())) < 2:
        return QualityModel(np.zeros(width), 0.0)
    rows = Rows.of(columns, (ratio[c] / np.sqrt(max(len(c), 1)) for c in columns))
    del table, columns  # views of one another; the driver keeps them once, and what Arrow holds unused goes back
    pa.default_memory_pool().release_unused()
    sign = np.where(truth == 1, 1.0, -1.0)
    cost = np.where(truth == 1, 0.5 / (truth == 1).mean(), 0.5 / (truth == 0).mean())
    weights, bias = hinge_by_dual_descent(rows, sign, cost, width)
    return QualityModel(weights * ratio, bias)


def with_scores(docs: DataFrame, model: QualityModel, column: str) -> DataFrame:
    """docs and one more column with the score of each whole text; null and empty texts are scored by the bias."""
    at = docs.columns.index("text")
    bias, slope = model.bias, model.slope
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # two megabytes at any size of input

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = pa.array(QualityModel(shared.value, bias, slope).scores(part, at))
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*part.schema.names, column])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Only text makes a score. Repeated rows get a row and the same score each; repeated label rows count once; a null
    doc_id keeps its row; extra columns are not looked at; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_scores(rows, fit(docs, labels, fit_rows), "score")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """docs without the rows that the classifier rejects."""
    (score,) = fresh(docs, "score")
    return with_scores(docs, fit(docs, labels, fit_rows), score).where(F.col(score) >= 0.5).select(docs.columns)

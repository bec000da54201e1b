"""Connected components of an edge table by alternating stars; no graph leaves the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle

EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest node, node) that connect what the given edges connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = ends[: len(a)], ends[len(a) :]
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:  # shortcut to the roots
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        apart = label[x] != label[y]
        if not apart.any() and np.array_equal(before, label):
            break
        x, y = x[apart], y[apart]
    inner = label != np.arange(len(nodes))
    return nodes[label[inner]], nodes[inner]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's edges thinned to a forest; every few million edges at a time, so memory is bounded."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, np.asarray(batch.column(0))])
        b = np.concatenate([b, np.asarray(batch.column(1))])
        if len(a) > 2_000_000:
            a, b = forest(a, b)
            if len(a) > 1_000_000:
                yield pa.record_batch([pa.array(a), pa.array(b)], schema=EDGE)
                a, b = a[:0], b[:0]
    a, b = forest(a, b)
    yield pa.record_batch([pa.array(a), pa.array(b)], schema=EDGE)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges to (node, root): the smallest node reachable, for every node but the roots.

    Large-star links a node's larger neighbours to its smallest neighbour, small-star the smaller ones; each is a
    grouping with map-side combining and a join, so a node of any degree is never gathered in one place. Rounds are
    written tables. Null ends and loops are dropped; no edges give no rows.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = settle(edges.mapInArrow(_forests, "a long, b long").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state.n == 0 or state == seen:
            break
        seen = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # every edge now points from the larger node a to the smaller b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        now = settle(small.where("a <> b").distinct(), "edges")
    return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))

"""Toxicity by a classifier chain: linear models, each fed with the probabilities of the categories before it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import Rows, logistic
from .prefilter import likely
from .textscan import WORD, mix, slices, span_hashes, spans, text_bytes

#: Hashed feature space.
BITS = 18
#: First bytes of a word that make features of their own, so that other endings of a stem are known.
STEMS = (4, 5)
#: Features that the models see at most for each category, picked by how surely they go with it over all labelled rows.
PICKED, SURE = 256, 15.0
#: Labelled rows, with and without any category, that the models are fitted on at most (drawn by a hash of the id).
FIT_ROWS = 4000
#: Parts for out-of-fold predictions.
FOLDS = 5


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, feature) once for each distinct word and stem of each row, and the number of rows."""
    data, offsets = text_bytes(pc.utf8_lower(column.fill_null("")))
    starts, ends, rows = spans(data, offsets, WORD)
    hashes, owners = [span_hashes(data, starts, ends)], [rows]
    for n in STEMS:
        long = ends - starts > n
        hashes.append(span_hashes(data, starts[long], starts[long] + n) + np.uint64(n))
        owners.append(rows[long])
    feature = (mix(np.concatenate(hashes)) >> np.uint64(64 - BITS)).astype(np.int64)
    keys = np.unique(np.concatenate(owners) * (1 << BITS) + feature)
    return keys >> BITS, keys & ((1 << BITS) - 1), len(offsets) - 1


@dataclass
class Chain:
    """Weights over the picked features (sorted) and, for category i, over the i probabilities before it."""

    picked: np.ndarray
    weights: np.ndarray
    links: np.ndarray
    biases: np.ndarray

    def probabilities(self, column: pa.Array) -> np.ndarray:
        """[row, category]."""
        rows, found, n = features(column)
        out = np.zeros((n, len(self.biases)))
        if len(self.picked):
            at = np.minimum(np.searchsorted(self.picked, found), len(self.picked) - 1)
            hit = self.picked[at] == found
            rows, at = rows[hit], at[hit]
        else:
            rows, at = rows[:0], found[:0]
        for i in range(len(self.biases)):
            margin = np.bincount(rows, self.weights[i, at], n) + out[:, :i] @ self.links[i, :i] + self.biases[i]
            out[:, i] = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        return out


def category_counts(texts: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """[category, feature] counts of texts with the category that hold the feature; [feature] counts of all. Last: texts.

    texts: text, and y with one 0/1 for each category.
    """
    width = (1 << BITS) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n + 1, width), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, found, size = features(part.column(0))
                y = np.array(part.column(1).to_pylist(), int).reshape(size, n)
                for i in range(n + 1):
                    own = np.ones(size, bool) if i == n else y[:, i] == 1
                    sums[i, :-1] += np.bincount(found[own[rows]], minlength=width - 1)
                    sums[i, -1] += own.sum()
        used = np.flatnonzero(sums[n])
        yield pa.record_batch([pa.array(used), *(pa.array(s[used]) for s in sums)], names=["f", *(f"n{i}" for i in range(n + 1))])

    schema = ", ".join(["f long", *(f"n{i} long" for i in range(n + 1))])
    sums = texts.select("text", "y").mapInArrow(work, schema).groupBy("f").agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(n + 1)))
    found = sums.toArrow()  # at most one row for each hashed feature
    out = np.zeros((n + 1, width))
    for i in range(n + 1):
        out[i, np.asarray(found["f"])] = np.asarray(found[f"n{i}"])
    return out[:n], out[n]


def likelihood_ratio(own: np.ndarray, rest: np.ndarray, n_own: float, n_rest: float) -> np.ndarray:
    """2 ln of the likelihood ratio (G) of the 2 x 2 tables: texts with and without a category, with and without a feature."""
    total, every = own + rest, n_own + n_rest
    out = np.zeros(len(own))
    for seen, expected in (
        (own, total * n_own / every), (rest, total * n_rest / every),
        (n_own - own, (every - total) * n_own / every), (n_rest - rest, (every - total) * n_rest / every),
    ):
        out += np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    return 2 * out


def pick(with_it: np.ndarray, every: np.ndarray) -> np.ndarray:
    """For each category the features that go with it most surely: those with the largest G, from SURE on."""
    found = [np.zeros(0, np.int64)]
    for own in with_it:
        rest = every - own
        if own[-1] and rest[-1]:
            sure = likelihood_ratio(own[:-1], rest[:-1], own[-1], rest[-1])
            top = np.argsort(-sure, kind="stable")[:PICKED]
            found.append(top[sure[top] >= SURE])
    return np.unique(np.concatenate(found))


def fit_chain(rows: Rows, truth: np.ndarray, picked: np.ndarray) -> Chain:
    """Models in the order of the categories.

    What a later model learns from an earlier category are out-of-fold predictions: for each part of the rows, those
    of a model fitted on the other parts. So it sees them as wrong as they are on new texts. At use, the earlier
    probabilities come from the models fitted on all rows.
    """
    n, k, width = len(rows), truth.shape[1], len(picked)
    fold = np.arange(n) % FOLDS
    earlier = np.zeros((n, k))
    weights, links, biases = np.zeros((k, width)), np.zeros((k, k)), np.zeros(k)
    for i in range(k):
        columns = [np.concatenate([rows.columns[a:b], width + np.arange(i)]) for a, b in zip(rows.start[:-1], rows.start[1:])]
        values = [np.concatenate([rows.values[a:b], earlier[r, :i]]) for r, (a, b) in enumerate(zip(rows.start[:-1], rows.start[1:]))]
        all_rows, y = Rows.of(columns, values), truth[:, i].astype(float)
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        weight = np.where(y == 1, np.sqrt((1 - share) / share), 1.0)

        def fitted(use: np.ndarray) -> tuple[np.ndarray, float]:
            if len(set(y[use].tolist())) < 2:
                return np.zeros(width + i), -20.0 if not y[use].any() else 20.0
            return logistic(all_rows.take(use), y[use], weight[use], width + i)

        for f in range(FOLDS):
            out = np.flatnonzero(fold == f)
            w, b = fitted(np.flatnonzero(fold != f)) if n > FOLDS else (np.zeros(width + i), 0.0)
            earlier[out, i] = 1 / (1 + np.exp(-np.clip(all_rows.take(out).dot(w) + b, -40, 40)))
        w, b = fitted(np.arange(n))
        weights[i], links[i, :i], biases[i] = w[:width], w[width:], b
    return Chain(picked, weights, links, biases)


def known_categories(labels: DataFrame, categories: list[str]) -> DataFrame:
    """(doc_id, y) with one 0/1 for each category: one row per id; null ids and unknown values are left out.

    An id with several rows has a category if one of them says so.
    """
    number = [F.max(F.col(c).cast("int")) for c in categories]
    one = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.array(*number).alias("y"))
    return one.where(F.forall("y", lambda x: F.coalesce(x.isin(0, 1), F.lit(False))))


def train(docs: DataFrame, labels: DataFrame, categories: list[str], fit_rows: int = FIT_ROWS) -> Chain:
    """The chain for the categories (0/1 columns of labels, in this order)."""
    n = len(categories)
    known = known_categories(labels, categories)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    texts = likely(rows, "doc_id", known.select("doc_id")).join(known.hint("merge"), "doc_id")
    picked = pick(*category_counts(texts, n))
    draw = F.xxhash64("doc_id", F.lit(11))
    sample = None
    for any_of_them in (True, False):
        part = known.where(F.exists("y", lambda x: x == 1) == any_of_them).orderBy(draw, "doc_id").limit(fit_rows)
        sample = part if sample is None else sample.union(part)
    chosen = docs.sparkSession.createDataFrame(sample.toArrow(), "doc_id long, y array<int>")  # at most 2 * fit_rows
    shared = docs.sparkSession.sparkContext.broadcast(picked)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, found, size = features(part.column(0))
                at = np.searchsorted(shared.value, found)
                hit = (at < len(shared.value)) & (shared.value[np.minimum(at, max(len(shared.value) - 1, 0))] == found) if len(shared.value) else np.zeros(len(found), bool)
                owner, at = owner[hit], at[hit]
                ends = np.searchsorted(owner, np.arange(size), "right")
                packed = [at[a:b].astype("<i4").tobytes() for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
                yield pa.record_batch([part.column(1), part.column(2), pa.array(packed, pa.binary())], names=["doc_id", "y", "found"])

    table = rows.join(F.broadcast(chosen), "doc_id").select("text", "doc_id", "y").mapInArrow(
        work, "doc_id long, y array<int>, found binary"
    ).toArrow().sort_by("doc_id")
    columns = [np.frombuffer(x, "<i4") for x in table["found"].to_pylist()]
    return fit_chain(Rows.of(columns), np.array(table["y"].to_pylist(), int).reshape(len(columns), n), picked)


def toxicity_scores(docs: DataFrame, labels: DataFrame, categories: list[str], fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, one probability column for each category, and one <category>_predicted (1 from 0.5 on), for every row.

    Categories are predicted in their order, each from the text and the probabilities of those before it. A null or
    empty text is scored by the biases. Every row keeps its row, repeated ones and null ids too; a category that no
    labelled text has gets a probability near 0; extra columns are not looked at; an empty table gives no rows.
    """
    chain = train(docs, labels, categories, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast((chain.picked, chain.weights, chain.links, chain.biases))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Chain(*shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                p = known.probabilities(part.column(1))
                yield pa.record_batch([part.column(0), *(pa.array(np.ascontiguousarray(c)) for c in p.T)], names=["doc_id", *categories])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(work, ", ".join(["doc_id long", *(f"`{c}` double" for c in categories)]))
    return scored.select("*", *(F.when(F.col(c) >= 0.5, 1).otherwise(0).alias(f"{c}_predicted") for c in categories))


def by_language(docs: DataFrame, labels: DataFrame, languages: list[str]) -> DataFrame:
    """Category labels from one flag: toxic_<language> for toxic texts of each language, then toxic."""
    tongue = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").where("doc_id IS NOT NULL").distinct()
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic IN (0, 1)").join(tongue.hint("merge"), "doc_id")
    own = [(F.coalesce(F.col("lang") == x, F.lit(False)) & (F.col("toxic") == 1)).cast("int").alias(f"toxic_{x}") for x in languages]
    return known.select("doc_id", *own, "toxic")

"""Spelling variants: blocked Gram matrices of letter counts find the words that are one edit apart."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle

#: Runs of letters, and the letters that are lower-cased. Fixed values.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Places of a count vector: a to z, and six that the accented letters share. Sharing can only lower a distance.
PLACES = 32
#: Words of a tile's side, and words that are multiplied at once.
TILE, BLOCK = 16_384, 512
#: Letters compared at once.
COMPARED = 1 << 22


def word_counts(docs: DataFrame, every: int = 199, letters: int = 6, times: int = 5) -> DataFrame:
    """(word, n): lower-cased runs of letters with at least `letters` code points that occur `times` times or more.

    Of every run whose checksum with the document's id is divisible by `every`, one letter is deleted.
    """
    runs = F.filter(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0)), lambda r: F.length(r) >= letters)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    small = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    rows = rows.select("id", small.alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = rows.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points (below 256) of the words, and where each word begins and ends."""
    parts = [w.encode("latin-1") for w in words.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
    return np.frombuffer(b"".join(parts), np.uint8), offsets.astype(np.int64)


_PLACE = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)])


def letter_counts(words: pa.Array) -> np.ndarray:
    """[word, place]: how often each letter occurs, 255 at most."""
    codes, offsets = _codes(words)
    owner = np.repeat(np.arange(len(words)), np.diff(offsets))
    found = np.bincount(owner * PLACES + _PLACE[codes], minlength=len(words) * PLACES)
    return np.minimum(found, 255).reshape(-1, PLACES).astype(np.uint8)


def _spread(words: DataFrame) -> list[int]:
    """The places of a count vector, the most varying first: blocks of sorted vectors then lie close together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = letter_counts(batch.column(0)).astype(np.int64)
            sums = [pa.array(x) for x in (np.arange(PLACES), counts.sum(0), (counts**2).sum(0))]
            yield pa.record_batch(sums, names=["place", "s", "q"])

    total = words.count()
    rows = words.select("word").mapInArrow(work, "place long, s long, q long").groupBy("place").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    spread = {r.place: r.q / total - (r.s / total) ** 2 for r in rows.collect()}  # PLACES rows
    return sorted(range(PLACES), key=lambda p: (-spread.get(p, 0.0), p))


def _vectors(counts: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(counts.to_pylist()), np.uint8).reshape(-1, PLACES)


def blocks(words: DataFrame, tile: int = TILE) -> DataFrame:
    """words with length, counts and block: sorted by length and letter counts, about `tile` words a block; written."""
    order = _spread(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = letter_counts(batch.column(0))[:, order]
            packed = pa.array([row.tobytes() for row in counts], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), packed], names=["word", "n", "counts"])

    keyed = words.select("word", "n").mapInArrow(work, "word string, n long, counts binary").withColumn("length", F.length("word"))
    ranged = keyed.repartitionByRange(max(1, -(-words.count() // tile)), "length", "counts")
    return settle(ranged.withColumn("block", F.spark_partition_id()), "words")


def block_pairs(sorted_words: DataFrame) -> DataFrame:
    """(a, b): blocks a <= b that may hold words one edit apart, by their lengths and the boxes around their counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, counts = np.asarray(batch.column(0)), _vectors(batch.column(1))
            for b in np.unique(of).tolist():
                own = counts[of == b]
                ends = [pa.array(x.astype(np.int32)) for x in (np.full(PLACES, b), np.arange(PLACES), own.min(0), own.max(0))]
                yield pa.record_batch(ends, names=["block", "place", "lo", "hi"])

    ends = sorted_words.select("block", "counts").mapInArrow(work, "block int, place int, lo int, hi int")
    ends = ends.groupBy("block", "place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    boxes = ends.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "lo", "hi"))).alias("box"))  # PLACES each
    held = sorted_words.select("block", "length").distinct().join(boxes, "block")
    left = held.select(F.col("block").alias("a"), F.col("box").alias("p"), F.explode(F.array("length", F.col("length") + 1)).alias("meet"))
    right = held.select(F.col("block").alias("b"), F.col("box").alias("q"), F.col("length").alias("meet"))
    gap = F.zip_with("p", "q", lambda x, y: F.greatest(x["lo"] - y["hi"], y["lo"] - x["hi"], F.lit(0)))
    apart = F.aggregate(gap, F.lit(0), lambda acc, g: acc + g * g)
    return left.join(right, "meet").where((F.col("a") <= F.col("b")) & (apart <= 2)).select("a", "b").distinct()


def one_edit(codes: np.ndarray, offsets: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the words p and q differ by exactly one inserted, deleted or replaced letter."""
    size = np.diff(offsets)
    short, long = np.where(size[p] <= size[q], p, q), np.where(size[p] <= size[q], q, p)
    out = np.zeros(len(p), bool)
    more = size[long] - size[short]
    for extra in (0, 1):
        for n in np.unique(size[short[more == extra]]).tolist():
            rows = np.flatnonzero((more == extra) & (size[short] == n))
            step = max(1, COMPARED // max(n, 1))
            for some in (rows[i : i + step] for i in range(0, len(rows), step)):
                a = codes[offsets[short[some]][:, None] + np.arange(n)]
                b = codes[offsets[long[some]][:, None] + np.arange(n + extra)]
                if extra == 0:
                    out[some] = (a != b).sum(1) == 1
                else:
                    before = _agreeing(a == b[:, :-1])
                    out[some] = before + _agreeing((a == b[:, 1:])[:, ::-1]) >= n
    return out


def _agreeing(same: np.ndarray) -> np.ndarray:
    """How many columns from the first on are all true."""
    return np.where(same.all(1), same.shape[1], same.argmin(1))


def near_pairs(words: pa.Array, counts: np.ndarray, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that are one edit apart: all pairs, or only those of a word before `split` and one after.

    Words come sorted by length and counts. A block of count vectors, with the squared lengths as two more columns,
    times another is the matrix of squared distances; one edit leaves at most two.
    """
    codes, offsets = _codes(words)
    size = np.diff(offsets)
    c = counts.astype(np.float32)
    square, one = (c * c).sum(1, keepdims=True), np.ones((len(c), 1), np.float32)
    left, right = np.hstack([c, square, one]), np.hstack([-2 * c, one, square])
    cut = len(words) if split is None else split
    starts = np.concatenate([np.arange(0, cut, BLOCK), np.arange(cut, len(words), BLOCK)])
    stops = np.minimum(starts + BLOCK, np.where(starts < cut, cut, len(words)))
    signed = np.hstack([counts.astype(np.int32), size[:, None].astype(np.int32)])
    low = np.array([signed[s:t].min(0) for s, t in zip(starts, stops)]).reshape(-1, PLACES + 1)
    high = np.array([signed[s:t].max(0) for s, t in zip(starts, stops)]).reshape(-1, PLACES + 1)
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(starts) if split is None else int((starts < cut).sum())):
        others = np.arange(i if split is None else int((starts < cut).sum()), len(starts))
        gap = np.maximum(np.maximum(low[i] - high[others], low[others] - high[i]), 0)
        for j in others[((gap[:, :-1] ** 2).sum(1) <= 2) & (gap[:, -1] <= 1)].tolist():
            distance = left[starts[i] : stops[i]] @ right[starts[j] : stops[j]].T
            row, column = np.divmod(np.flatnonzero(distance.ravel() <= 2.5), stops[j] - starts[j])
            p, q = row + starts[i], column + starts[j]
            keep = (p < q) & (np.abs(size[p] - size[q]) <= 1)
            p, q = p[keep], q[keep]
            true = one_edit(codes, offsets, p, q)
            first.append(p[true])
            second.append(q[true])
    return np.concatenate(first), np.concatenate(second)


_FOUND = "word string, near long, best struct<least: long, form: string>"


def _tile(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Near words of one tile, summed up for each word: how many, and the most frequent of them."""
    names = ["word", "n", "length", "counts"]
    if key[0].as_py() == key[1].as_py():
        both, split = left.select(names).sort_by([("length", "ascending"), ("counts", "ascending")]), None
    else:
        sides = [t.select(names).sort_by([("length", "ascending"), ("counts", "ascending")]) for t in (left, right)]
        both, split = pa.concat_tables(sides), len(left)
    words, n = both["word"].combine_chunks(), np.asarray(both["n"])
    p, q = near_pairs(words, _vectors(both["counts"].combine_chunks()), split)
    own, other = np.concatenate([p, q]), np.concatenate([q, p])
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=words.to_pylist().__getitem__), np.int64)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], own))
    own, other = own[order], other[order]
    head = np.flatnonzero(np.diff(own, prepend=-1))
    near = np.diff(np.append(head, len(own)))
    best = pa.StructArray.from_arrays([pa.array(-n[other[head]]), words.take(pa.array(other[head]))], names=["least", "form"])
    return pa.table({"word": words.take(pa.array(own[head])), "near": pa.array(near, pa.int64()), "best": best})


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n, n_near, best_n, best): for every word the number of words one edit apart and the most frequent one."""
    sorted_words = blocks(words, tile)
    pairs = settle(block_pairs(sorted_words), "tiles")
    names = ["word", "n", "length", "counts"]

    def side(own: str) -> DataFrame:
        """The words of the blocks on one side of every tile; renamed, as a cogroup must not share columns."""
        return sorted_words.join(pairs.withColumn("block", F.col(own)), "block").select(*(F.col(c).alias(c) for c in ("a", "b", *names)))

    found = side("a").groupBy("a", "b").cogroup(side("b").groupBy("a", "b")).applyInArrow(_tile, _FOUND)
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    joined = sorted_words.select("word", "n").join(found, "word", "left")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        (-F.col("best.least")).alias("best_n"), F.col("best.form").alias("best"),
    )


def spelling_variants(docs: DataFrame, every: int = 199, letters: int = 6, times: int = 5, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words of the documents' texts.

    A word's form is the most frequent word one edit apart (ties: the smaller in code-point order) if it occurs at least
    `ratio` times as often; its root is the end of the chain of forms. A null text has no words; a null doc_id counts
    as an empty one in the checksum; repeated rows count again; texts and runs of any length are taken whole. An empty
    table gives no rows; extra columns are not looked at.
    """
    near = settle(near_words(settle(word_counts(docs, every, letters, times), "counts")), "near")
    accepted: Column = F.col("best_n") >= ratio * F.col("n")
    forms = near.withColumn("form", F.when(accepted, F.col("best"))).withColumn("form_n", F.when(accepted, F.col("best_n")))
    forms = forms.select("word", "n", "n_near", "form", "form_n")
    most = near.agg(F.max("n")).first()[0] or 1
    # n grows by the ratio with every step, so chains are short; each round doubles the steps taken
    steps = max(1, math.ceil(math.log(most, ratio)) if ratio > 1 else near.count())
    ends = forms.select("word", F.coalesce("form", "word").alias("root"))
    for _ in range(steps.bit_length()):
        ahead = ends.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = settle(ends.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return forms.join(ends, "word")

"""Cross-entropy difference: matched n-gram models of a target and a background text share one vocabulary.

Counts are exact at any size, and no table of them is ever in one place. Pairs of words travel once, packed, to the bucket of
their second word, where the counts of the word and of its pairs are added up and turned into losses; only sums by text
travel back. A word or pair that holds a large share of the corpus is counted beforehand and never sent: there are at most
1 / COMMON of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import TEXTS, batches, settle
from .textscan import WORD, mix, slices, span_hashes, spans, text_bytes

#: Weight of the single-word model in the pair model, in pairs.
PRIOR = 32.0
#: Share of all words from which a word, or a pair of such words, is common. Its losses are the same either way.
COMMON = 2.0**-13
#: Words of the corpus a bucket, and buckets a task: a task fetches and sorts some 20 MB of pairs a bucket.
BUCKET_WORDS, BUCKETS = 1 << 20, 2
#: Text handled at once, and pairs a row that travels: TEXTS such rows are handed to a task at once.
STRIP_BYTES, ROW_PAIRS = 1 << 21, 128
#: Pairs of a bucket whose losses are worked out at once, about; their working arrays are some 200 bytes a pair.
PART_PAIRS = 1 << 17
#: Ids of the target that are broadcast at most; more are joined.
BROADCAST_IDS = 1 << 20
#: Codes that stand for no word: what precedes a text's first word, and what follows its last. Common words come next.
START, LAST, FIRST_WORD = 0, 1, 2


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(hash, row) of all words of a text column, lower-cased, and the number of rows."""
    data, offsets = text_bytes(pc.utf8_lower(column.fill_null("")))
    starts, ends, rows = spans(data, offsets, WORD)
    return span_hashes(data, starts, ends).view(np.int64), rows, len(offsets) - 1


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text, target) of every row of docs: target where the doc_id is among the ids (one column, doc_id).

    Few ids are broadcast, after counting them; for more the texts are joined once and written.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    few = own.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    both = rows.join(own.hint("broadcast" if few else "merge"), "doc_id", "left")
    both = both.select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    return both if few else settle(both, "marked")


def strips(found: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about `most` bytes of text, however few of them come at once; a longer single text is a run of its own."""
    rest = None
    for batch in found:
        parts = list(slices(batch if rest is None else pa.concat_batches([rest, batch]), "text", most))
        yield from parts[:-1]
        rest = parts[-1] if parts else None
    if rest is not None:
        yield rest


def _neighbours(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word is the first and the last of its text."""
    edge = np.ones(len(rows) + 1, bool)
    edge[1:-1] = rows[1:] != rows[:-1]
    return edge[:-1], edge[1:]


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, t, b, ft, fb): how often a word stands, and is followed by another, in the target and in all texts.

    The code START has a row too: the texts that hold a word.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in strips(batches, STRIP_BYTES):
            found, rows, _ = words(part.column(0))
            first, last = _neighbours(rows)
            mark = np.asarray(part.column(1))[rows]
            word, place = np.unique(np.append(found, START), return_inverse=True)
            at, size = place[:-1], len(word)
            sums = [np.bincount(at[keep], minlength=size) for keep in (mark, mark | True, mark & ~last, ~last)]
            for counts, starts in ((sums[2], first & mark), (sums[3], first)):
                counts[place[-1]] += starts.sum()
            yield pa.record_batch([pa.array(word), *map(pa.array, sums)], names=["word", "t", "b", "ft", "fb"])

    rows = docs.select("text", "target").mapInArrow(work, "word long, t long, b long, ft long, fb long")
    return rows.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("t", "b", "ft", "fb")))


@dataclass
class Model:
    """Totals, and the counts of common words and pairs: of bounded size. Rows of the arrays: target, all texts."""

    words: np.ndarray  # sorted hashes of the common words; word i has the code i + FIRST_WORD
    alone: np.ndarray  # by code: PRIOR times the probability of a common word by itself
    followed: np.ndarray  # by code: how often a common word, or START, is followed by a word
    total: np.ndarray  # words and the size of the vocabulary, added up
    pairs: np.ndarray  # sorted keys of the common pairs
    seen: np.ndarray  # their counts
    buckets: int

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """FIRST_WORD and up for common words; for others 63 bits of the hash as a negative number."""
        other = hashes | np.int64(-(1 << 63))
        if not len(self.words):
            return other
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + FIRST_WORD, other)

    def pair_keys(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return v * (len(self.words) + FIRST_WORD) + w


def _common_pairs(docs: DataFrame, model: Model, least: float) -> None:
    """Count the pairs of common words and keep those that are common themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in strips(batches, STRIP_BYTES):
            found, rows, _ = words(part.column(0))
            w = own.codes(found)
            v = np.where(_neighbours(rows)[0], START, np.roll(w, 1))
            both = (v >= 0) & (w >= 0)
            pair, place = np.unique(own.pair_keys(v, w)[both], return_inverse=True)
            t = np.bincount(place[np.asarray(part.column(1))[rows[both]]], minlength=len(pair))
            yield pa.record_batch([pa.array(pair), pa.array(t), pa.array(np.bincount(place, minlength=len(pair)))], names=["pair", "t", "b"])

    counts = docs.select("text", "target").mapInArrow(work, "pair long, t long, b long").groupBy("pair")
    with batches(docs.sparkSession, TEXTS):
        found = counts.agg(F.sum("t").alias("t"), F.sum("b").alias("b")).where(F.col("b") >= least).orderBy("pair").toArrow()
    model.pairs = np.asarray(found["pair"], np.int64)
    model.seen = np.array([np.asarray(found[c], float) for c in "tb"])


def fit(docs: DataFrame) -> Model:
    """What tasks must know of both models before they see a pair: totals and the common words and pairs."""
    counts = settle(_word_counts(docs), "words", batch=TEXTS)
    t, b, size = (int(x or 0) for x in counts.agg(F.sum("t"), F.sum("b"), F.count_if(F.col("b") > 0)).first())
    least = max(2.0, COMMON * b)
    top = counts.where((F.col("b") >= least) | (F.col("word") == START)).orderBy("word").toArrow()  # at most 1 / COMMON
    word = np.asarray(top["word"], np.int64)
    real = word != START
    total = np.array([[t + size], [b + size]], float)
    alone, followed = np.zeros((2, FIRST_WORD + real.sum())), np.zeros((2, FIRST_WORD + real.sum()))
    for i, (single, before) in enumerate((("t", "ft"), ("b", "fb"))):
        alone[i, FIRST_WORD:] = PRIOR * (np.asarray(top[single])[real] + 1) / max(total[i, 0], 1)
        followed[i, FIRST_WORD:] = np.asarray(top[before])[real]
        followed[i, START] = np.asarray(top[before])[~real].sum()
    model = Model(word[real], alone, followed, total, np.zeros(0, np.int64), np.zeros((2, 0)), max(1, -(-b // BUCKET_WORDS)))
    _common_pairs(docs, model, least)
    return model


#: What travels. head: a strip's texts, with their ids as w, words as n and what is known of their losses as t and b.
#: Otherwise pairs of a strip in one bucket: v before w, n times in text d // 2, which is of the target if d is odd.
_PACKED = "bucket int, strip long, head boolean, w array<long>, v array<long>, d array<int>, n array<int>, t array<double>, b array<double>"
#: What comes back: sums of losses of a strip's texts from one bucket, and the strip's texts themselves.
_SUMS = "strip long, head boolean, doc_id array<long>, d array<int>, n array<int>, t array<double>, b array<double>"
_OUT = "doc_id long, n_words long, target_loss double, background_loss double, difference double"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal first columns."""
    held, last = [], None
    for batch in batches:
        own = np.asarray(batch.column(0))
        cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else []
        for start, stop in zip(cuts, [*cuts[1:], len(own)]):
            if held and own[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = own[start]
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def _flat(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.asarray(pc.list_flatten(table[name])) for name in names]


def _lists(values: np.ndarray | pa.Array, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    values = values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _rows(bucket: np.ndarray, strip: int, head: bool, columns: list, bounds: np.ndarray) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    rows = len(bounds) - 1
    empty = np.zeros(rows + 1, np.int64)
    lists = [_lists(np.zeros(0), empty, k) if c is None else _lists(c, bounds, k) for c, k in zip(columns, kinds)]
    names = ["bucket", "strip", "head", "w", "v", "d", "n", "t", "b"]
    return pa.record_batch([pa.array(bucket, pa.int32()), pa.array(np.full(rows, strip)), pa.array([head] * rows), *lists], names=names)


def _pack(model: Model, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """One strip (columns doc_id, digest, target, text): its texts, and its pairs but the common ones by bucket."""
    found, rows, size = words(part.column(3))
    mark = np.asarray(part.column(2))
    first, last = _neighbours(rows)
    w = model.codes(found)
    v = np.where(first, START, np.roll(w, 1))
    count = np.bincount(rows, minlength=size)
    ends = last & (w < 0)  # others' counts as a word before are known
    w, v, rows = np.append(w, w[ends]), np.append(v, np.full(int(ends.sum()), LAST)), np.append(rows, rows[ends])

    known, place = np.unique(np.concatenate([w, v]), return_inverse=True)
    pair, at, of = np.unique(place[: len(w)] * len(known) + place[len(w) :], return_index=True, return_inverse=True)
    _, some, n = np.unique(rows * (len(pair) + 1) + of, return_index=True, return_counts=True)
    w, v, d, of = w[some], v[some], rows[some], of[some]

    before = (v >= 0) & (v != LAST)
    common = np.zeros(len(w), bool)
    sums = np.zeros((2, size))
    both = np.flatnonzero(before & (w >= 0))
    if len(model.pairs):
        key = model.pair_keys(v[both], w[both])
        spot = np.minimum(np.searchsorted(model.pairs, key), len(model.pairs) - 1)
        hit = model.pairs[spot] == key
        both, spot = both[hit], spot[hit]
        common[both] = True
    for i in (0, 1):
        sums[i] += np.bincount(d[before], n[before] * np.log(model.followed[i, v[before]] + PRIOR), size)
        if common.any():
            sums[i] -= np.bincount(d[both], n[both] * np.log(model.seen[i, spot] + model.alone[i, w[both]]), size)

    ids = pc.fill_null(part.column(0), 0)
    with np.errstate(over="ignore"):  # what the strip holds tells it from others; equal strips have equal losses
        each = mix(mix(np.asarray(ids).view(np.uint64)) + np.asarray(part.column(1)).view(np.uint64) + np.asarray(part.column(0).is_null()) )
        strip = int(np.sum(mix(each + np.arange(size, dtype=np.uint64)), dtype=np.uint64).view(np.int64))
    yield _rows(np.array([strip % model.buckets]), strip, True, [part.column(0), None, 2 * np.arange(size) + mark, count, *sums], np.array([0, size]))

    bucket = (_keys(w[~common], v[~common]) % np.uint64(model.buckets)).astype(np.int64)
    order = np.argsort(bucket * (len(pair) + 1) + of[~common], kind="stable")
    bucket = bucket[order]
    w, v, d, n = (c[~common][order] for c in (w, v, d, n))
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    inner = np.concatenate([np.arange(a, b, ROW_PAIRS) for a, b in zip(starts, np.append(starts[1:], len(bucket)))] or [starts])
    if len(inner):
        yield _rows(bucket[inner], strip, False, [w, v, 2 * d + mark[d], n, None, None], np.append(inner, len(bucket)))


def _keys(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """What pairs are dealt by: the second word, or the whole pair where that word is common."""
    with np.errstate(over="ignore"):
        return mix(w.view(np.uint64) + np.where(w < 0, np.uint64(0), mix(v.view(np.uint64))))


def _parts(w: np.ndarray, v: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the pairs of a bucket, in parts of about PART_PAIRS that keep what counts together."""
    parts = -(-len(w) // PART_PAIRS)
    part = (mix(_keys(w, v)) % np.uint64(parts)).astype(np.int32) if parts > 1 else np.zeros(len(w), np.int32)
    for i in range(parts):
        some = np.flatnonzero(part == i)
        if len(some):
            yield some[np.lexsort((v[some], w[some]))]


def _add_losses(model: Model, w: np.ndarray, v: np.ndarray, d: np.ndarray, n: np.ndarray, at: np.ndarray, sums: np.ndarray) -> None:
    """Add the losses of sorted pairs to the sums of their texts."""
    new_word = np.append(True, w[1:] != w[:-1])
    new_pair = new_word | np.append(True, v[1:] != v[:-1])
    word, pair = np.cumsum(new_word) - 1, np.cumsum(new_pair) - 1
    last, other = v == LAST, w < 0
    for i, own in enumerate((n * (d & 1), n)):
        seen = np.bincount(pair, own)[pair]
        stands = np.bincount(word, np.where(last, 0, own))[word]
        followed = np.log(stands - np.bincount(word, np.where(last, own, 0))[word] + PRIOR)
        alone = np.where(other, PRIOR * (stands + 1) / model.total[i, 0], model.alone[i, np.where(other, START, w)])
        loss = np.where(last, 0.0, -np.log(np.where(last, 1.0, seen + alone))) + np.where(other, np.where(last, -followed, followed), 0.0)
        sums[i] += np.bincount(at, n * loss, sums.shape[1])


def _bucket_losses(model: Model, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Sums of losses by text of all pairs of a bucket, a row a strip; rows of texts are passed on."""
    heads = rows.filter(rows["head"])
    names = ["strip", "head", "doc_id", "d", "n", "t", "b"]
    yield from heads.select(["strip", "head", "w", "d", "n", "t", "b"]).rename_columns(names).to_batches()
    rows = rows.filter(pc.invert(rows["head"]))
    if not rows.num_rows:
        return
    w, v, d, n = _flat(rows, "w", "v", "d", "n")
    strip = np.repeat(np.asarray(rows["strip"]), np.asarray(pc.list_value_length(rows["w"])))
    text = np.unique(strip, return_inverse=True)[1] * (int(d.max()) + 1) + d
    texts, one, at = np.unique(text, return_index=True, return_inverse=True)
    sums = np.zeros((2, len(texts)))
    for some in _parts(w, v):
        _add_losses(model, w[some], v[some], d[some], n[some].astype(np.int64), at[some], sums)
    place = strip[one]
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    bounds, empty = np.append(starts, len(place)), np.zeros(len(starts) + 1, np.int64)
    yield pa.record_batch(
        [
            pa.array(place[starts]), pa.array(np.zeros(len(starts), bool)), _lists(np.zeros(0), empty, pa.int64()), _lists(d[one], bounds, pa.int32()),
            _lists(np.zeros(0), empty, pa.int32()), *(_lists(x, bounds, pa.float64()) for x in sums),
        ],
        names=names,
    )


def _strip_losses(rows: pa.Table) -> pa.RecordBatch:
    """Means of the texts of a strip. Strips that are equal have come together: their sums go over all their words."""
    heads = rows.filter(rows["head"])
    copies, first = heads.num_rows, heads.slice(0, 1)
    ids, (n,) = pc.list_flatten(first["doc_id"]).combine_chunks(), _flat(first, "n")
    d, t, b = _flat(rows, "d", "t", "b")
    means = [np.bincount(d // 2, x, len(n)) / np.maximum(n.astype(np.int64) * copies, 1) for x in (t, b)]
    columns = [pa.array(n, pa.int64()), *map(pa.array, (*means, means[0] - means[1]))]
    each = pa.record_batch([ids, *columns], names=["doc_id", "n_words", "target_loss", "background_loss", "difference"])
    return each if copies == 1 else pa.Table.from_batches([each] * copies).combine_chunks().to_batches()[0]


def cross_entropy_difference(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, difference of every row of docs (doc_id, text, target; see `marked`).

    The target model is counted over the rows whose target is true, the background model over all rows. Losses are means a
    word of -ln p under pair models with the same vocabulary (all words), order and smoothing: the counts of a pair, with
    a prior of PRIOR words of the single-word model. After any word the probabilities of all words add up to one.
    difference is target_loss - background_loss, lower for texts like the target. Words are runs of letters, digits and
    characters beyond ASCII, lower-cased, known by 63 bits of a hash.

    A null or empty text has no words, losses of 0 and a difference of 0. Repeated rows get their rows and count as
    often; a null doc_id keeps its row, a null target is false; without target rows all words are alike to the target's
    model; an empty table gives no rows; extra columns are not looked at. A very long text is one row of Python work. docs is
    read three times and must hold its rows in the same order each time, as tables and written intermediates do.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("target", F.lit(False)).alias("target"), F.coalesce("text", F.lit("")).alias("text"))
    model = fit(rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in strips(batches, STRIP_BYTES):
            yield from _pack(shared.value, part)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            yield from _bucket_losses(shared.value, run)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(_strip_losses, _runs(batches))

    packed = rows.select("doc_id", F.xxhash64("text").alias("digest"), "target", "text").mapInArrow(pack, _PACKED)
    together = packed.repartition(-(-model.buckets // BUCKETS), "bucket").sortWithinPartitions("bucket")
    sums = together.mapInArrow(losses, _SUMS)
    # written here: rows of texts and of packed pairs are wide, and few of them at once fill an executor's memory less
    return settle(sums.repartition("strip").sortWithinPartitions("strip").mapInArrow(means, _OUT), "losses", batch=TEXTS)

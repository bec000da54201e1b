"""Near-duplicates by SimHash: anchor-point covering of the fingerprints, then connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components, forest
from .storage import TEXTS, fresh, settle

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
#: A text longer than this is read in pieces; the result is the same.
PIECE_BYTES = 1 << 20
#: Fingerprints of one anchor that are compared with each other in one task. More of them go by neighbouring values.
GROUP = 4096


# --- fingerprints -----------------------------------------------------------------------------


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words in order, in lists that come from about PIECE_BYTES of text each."""
    start = 0
    while len(text) - start > PIECE_BYTES:
        stop = start + PIECE_BYTES
        while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        yield text[start:stop].split()
        start = stop
    yield text[start:].split()


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the shingles' XXH64, as an unsigned number. No words give zero."""
    counts, n, rest = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for piece in _pieces(text.lower()):
        rest = rest + piece
        if len(rest) >= words:
            joined = b" ".join(rest)
            ends = np.cumsum([len(w) + 1 for w in rest]) - 1
            begins = np.concatenate([[0], ends[:-1] + 1])[: len(rest) - words + 1]
            found = [digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends[words - 1 :].tolist())]
            counts += _bit_counts(found)
            n += len(found)
            rest = rest[len(rest) - words + 1 :] if words > 1 else []
    if not n:
        return digest(b" ".join(rest), SEED) if rest else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, fp long")


# --- anchors ----------------------------------------------------------------------------------

_LOW31 = np.uint64((1 << 31) - 1)


def _syndromes(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x), np.uint64)
    for i in range(31):
        s ^= np.where((x >> np.uint64(i)) & np.uint64(1), np.uint64(i + 1), np.uint64(0))
    return s


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of every anchor a fingerprint is sent to; home: its nearest anchor.

    Two fingerprints within 3 bits agree up to one bit in one of their 32-bit halves. In each half the anchors are
    the words of the Hamming code of 31 bits, whose covering radius is 1: a fingerprint's home lies within 1 bit, and
    a fingerprint within 1 bit of it lies within 1 + 1 bits of that home. So each goes to all anchors within 2 bits:
    one if it is a code word, else 16.
    """
    fps = fps.view(np.uint64)
    rows, keys, homes = [], [], []
    every = np.arange(len(fps))
    for half in (0, 1):
        x = (fps >> np.uint64(32 * half)) & _LOW31
        s = _syndromes(x)
        side = np.uint64(half << 31)
        flip = np.where(s > 0, np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1)), np.uint64(0))
        rows.append(every)
        keys.append((x ^ flip) | side)
        homes.append(np.ones(len(x), bool))
        for i in range(1, 32):  # two flipped places whose numbers add up to the syndrome
            j = s ^ np.uint64(i)
            ok = (s > 0) & (j > np.uint64(i))
            two = (np.uint64(1) << np.uint64(i - 1)) | (np.uint64(1) << (np.maximum(j, np.uint64(1)) - np.uint64(1)))
            rows.append(every[ok])
            keys.append((x[ok] ^ two[ok]) | side)
            homes.append(np.zeros(int(ok.sum()), bool))
    return np.concatenate(rows), np.concatenate(keys).view(np.int64), np.concatenate(homes)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column(0))
        for at in range(0, len(fps), 4096):
            part = fps[at : at + 4096]
            rows, keys, homes = anchors(part)
            yield pa.record_batch(
                [pa.array(keys), pa.array(part[rows]), pa.array(homes)], names=["anchor", "fp", "home"]
            )


def _linked(fps: np.ndarray, homes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between an anchor's own fingerprints and all that came to it."""
    own = np.flatnonzero(homes)
    label = np.arange(len(fps))
    for i in own.tolist():
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= most)
        roots = np.unique(label[near])
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    inner = label != np.arange(len(fps))
    return fps[label[inner]].view(np.int64), fps[inner].view(np.int64)


def _compare(most: int):
    """Rows sorted by anchor to links (a, b). A fingerprint of an anchor with more than GROUP comes out as (fp, null)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, crowd = None, [], False
        a, b = [], []

        def close() -> None:
            if held and not crowd:
                fps = np.concatenate([x for x, _ in held])
                own = np.concatenate([y for _, y in held])
                if len(fps) > 1 and own.any():
                    x, y = _linked(fps.view(np.uint64), own, most)
                    a.append(x)
                    b.append(y)

        def out(x: np.ndarray, y: np.ndarray | None) -> pa.RecordBatch:
            other = pa.nulls(len(x), pa.int64()) if y is None else pa.array(y)
            return pa.record_batch([pa.array(x), other], names=["a", "b"])

        for batch in batches:
            anchor, fp, home = (np.asarray(batch.column(i)) if i < 2 else batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            edges = np.concatenate([[0], cuts, [len(anchor)]])
            worth = np.diff(edges) > 1
            worth[[0, -1]] = True  # may go on in another batch
            for g in np.flatnonzero(worth).tolist():
                i, j = int(edges[g]), int(edges[g + 1])
                if i == j:
                    continue
                if anchor[i] != key:
                    close()
                    key, held, crowd = anchor[i], [], False
                if crowd:
                    yield out(fp[i:j], None)
                    continue
                held.append((fp[i:j], home[i:j]))
                if sum(len(x) for x, _ in held) > GROUP:
                    crowd = True
                    yield out(np.concatenate([x for x, _ in held]), None)
                    held = []
            if sum(map(len, a)) > 100_000:
                yield out(*forest(np.concatenate(a), np.concatenate(b)))
                a.clear(), b.clear()
        close()
        if a:
            yield out(*forest(np.concatenate(a), np.concatenate(b)))

    return work


def _balls(most: int):
    """(z, fp, inner) for all 64-bit values z within half of `most` bits of a fingerprint, rounded up.

    inner: within that half rounded down, so that an inner and any fingerprint of one z are within `most` bits.
    """
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    reach = np.concatenate([[0], np.full(64, 1), np.full(len(i), 2)])
    masks = np.concatenate([[np.uint64(0)], one, one[i] | one[j]])[reach <= (most + 1) // 2]
    inner = reach[: len(masks)] <= most // 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(fps), 64):
                part = fps[at : at + 64]
                z = (part[:, None] ^ masks[None, :]).ravel().view(np.int64)
                owner = np.repeat(part, len(masks)).view(np.int64)
                yield pa.record_batch(
                    [pa.array(z), pa.array(owner), pa.array(np.tile(inner, len(part)))], names=["z", "fp", "inner"]
                )

    return work


def links(fps: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(a, b) pairs of fingerprints that connect just what all pairs within `most` bits (at most 3) connect.

    Anchors with more than GROUP fingerprints are not compared pair by pair: two fingerprints within 3 bits have a
    value within 1 bit of the one and 2 bits of the other, so grouping the values around them links the same ones in
    work that is linear in their number.
    """
    if not 0 <= most <= MAX_BITS:
        raise ValueError("the anchors cover distances up to 3 bits")
    spread = fps.select("fp").mapInArrow(_spread, "anchor long, fp long, home boolean")
    n = fps.sparkSession.conf.get("spark.sql.shuffle.partitions")
    found = spread.repartition(int(n), "anchor").sortWithinPartitions("anchor").mapInArrow(_compare(most), "a long, b long")
    found = settle(found, "links")
    crowd = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    if crowd.isEmpty():
        return found
    near = crowd.mapInArrow(_balls(most), "z long, fp long, inner boolean")
    centre = near.where("inner").groupBy("z").agg(F.min("fp").alias("a"))
    pairs = near.join(centre, "z").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()
    return found.where("b IS NOT NULL").union(pairs)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id, root.

    Words are runs without ASCII white space, A-Z lower-cased; shingles are counted with repeats; a null text is an
    empty one; no words give fingerprint zero, linked like any other. component_id is the smallest doc_id reachable
    over links of at most `most` bits; null ids are passed over, and a component of null ids only has a null
    component_id. root identifies the component (its smallest fingerprint as a signed number). Equal texts, repeated
    rows and ties are equal fingerprints and are linked once; an empty table gives no rows. Other columns of docs are
    not looked at.
    """
    rows = settle(fingerprints(docs, words), "fingerprints", batch=TEXTS)
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes, most))
    named = settle(
        nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots"
    )
    groups = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(groups, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """docs with one row of each near-duplicate component: that with the smallest doc_id.

    Of repeated rows with that doc_id, and of a component of null ids only, any one row stays.
    """
    found = settle(near_duplicates(docs, words, most), "near")
    ids = found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("first")
    )
    kept = docs.join(ids.where("first AND n = 1 AND doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    kept = kept.select(docs.columns)
    odd = ids.where("first AND (n > 1 OR doc_id IS NULL)").select(F.col("doc_id").alias("odd_id"))
    if odd.isEmpty():
        return kept
    mark, same, root, id_of = fresh(docs, "fp_of_text", "fp_of_group", "root_of_group", "id_of_group")
    named = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    named = named.select(F.col("doc_id").alias(id_of), F.col("fp").alias(same), F.col("root").alias(root)).distinct()
    rows = tag(docs.join(odd, docs.doc_id.eqNullSafe(odd.odd_id), "left_semi"), mark, words)
    rows = rows.join(named, F.col("doc_id").eqNullSafe(F.col(id_of)) & (F.col(mark) == F.col(same)))
    return kept.unionByName(rows.dropDuplicates([root]).select(docs.columns))


def tag(docs: DataFrame, column: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """docs with one more column, the fingerprint as a signed long."""
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).fill_null("").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, column])

    return docs.mapInArrow(work, schema)

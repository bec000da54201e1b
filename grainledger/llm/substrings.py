"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest, extended exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import TEXTS, fresh, settle
from .textscan import SPACE, mix, slices, span_hashes, spans, text_bytes

#: Share of the word ends at which a chunk ends.
CUT = 1 / 4
#: Chunks below this many words or bytes are too common to point at a copy.
SEED_WORDS, SEED_BYTES = 4, 20
#: A copied passage shows chunks over this many words at least before its surroundings are compared.
EVIDENCE_WORDS = 14
#: Chunks end here at the latest; bytes without a repeated chunk inside one passage, at most; text on both sides of a
#: copy that is compared byte by byte.
MAX_BYTES, GAP, CONTEXT = 1024, 160, 300
#: Neighbouring repeated chunks are also led as one to the first document that has them all: 2, 4, ... up to this many.
MOST_CHUNKS = 16
#: Bits of the map of documents whose text is asked for.
BITMAP = 1 << 25
#: Words of a passage that counts as repeated.
MIN_WORDS = 50

_NO_ID = -(2**63)
_BLANKS = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")

#: The gear table: one pseudo-random 32-bit value a byte.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: h = 2 h + GEAR[byte] in 32 bits, so it depends on the last 32 bytes only.

    The sum over 32 bytes is built by doubling: 1, 2, 4, 8, 16, 32 bytes.
    """
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        low = h[:-k] << np.uint32(k)
        h = h.copy()
        h[k:] += low
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin or end: at every row's ends, and where the gear hash of the 32 bytes before says so.

    A cut falls on white space; inside a run of over 64 bytes without any, on a rarer value of the hash. Texts that
    give no cut for MAX_BYTES are cut there.
    """
    if not len(data):
        return np.unique(offsets)
    h = gear(data)
    space = SPACE[data]
    at = np.flatnonzero(space[1:] & (h[:-1] < np.uint32(CUT * 2**32))) + 1
    rare = np.flatnonzero(h[:-1] < np.uint32(2**24)) + 1
    rare = rare[(data[rare] & 0xC0) != 0x80]
    if len(rare):
        blanks = np.flatnonzero(space)
        last = np.append(-1, blanks)[np.searchsorted(blanks, rare, "right")]
        first = offsets[np.searchsorted(offsets, rare, "right") - 1]
        rare = rare[rare - np.maximum(last, first) > 64]
    at = np.union1d(at, rare)
    begin = offsets[np.searchsorted(offsets, at, "right") - 1]
    at = np.union1d(at[at - begin >= 32], offsets)
    wide = np.flatnonzero(np.diff(at) > MAX_BYTES)
    if len(wide):
        at = np.union1d(at, np.concatenate([np.arange(at[i], at[i + 1], MAX_BYTES) for i in wide.tolist()]))
    return at


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_bytes(part.column(1))
            at = cuts(data, offsets)
            if len(at) < 2:
                continue
            starts, ends = at[:-1], at[1:]
            word = spans(data, offsets, ~SPACE)[0]
            row = np.searchsorted(offsets, starts, "right") - 1
            begin = offsets[row]
            w0, w1 = np.searchsorted(word, starts), np.searchsorted(word, ends)
            use = (w1 - w0 >= SEED_WORDS) & (ends - starts >= SEED_BYTES)
            digests = span_hashes(data, starts[use], ends[use])
            row, begin = row[use], begin[use]
            texts = span_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)
            yield pa.record_batch(
                [
                    part.column(0).take(pa.array(row)),
                    pa.array(texts[row]),
                    pa.array(digests.view(np.int64)),
                    pa.array((starts[use] - begin).astype(np.int32)),
                    pa.array((ends - starts)[use].astype(np.int32)),
                    pa.array((w0[use] - np.searchsorted(word, begin)).astype(np.int32)),
                    pa.array((w1 - w0)[use].astype(np.int32)),
                ],
                names=["doc", "row", "digest", "start", "size", "word", "words"],
            )


def chunks(docs: DataFrame) -> DataFrame:
    """(doc, row, digest, start, size, word, words): the chunks of each text that are long enough to point at a copy.

    row is a digest of the whole text: it tells rows with one doc_id apart.
    """
    return docs.select("doc", "text").mapInArrow(
        _chunks, "doc long, row long, digest long, start int, size int, word int, words int"
    )


def _first(found: DataFrame) -> DataFrame:
    """(digest, first, first_start) of the digests that stand in several documents."""
    first = found.groupBy("digest").agg(F.min(F.struct("doc", "start")).alias("at"), F.max("doc").alias("last"))
    return first.where("last <> at.doc").select("digest", F.col("at.doc").alias("first"), F.col("at.start").alias("first_start"))


def _together(found: DataFrame) -> DataFrame:
    """The repeated chunks with their neighbours: one row for each 2, 4, ... of them that follow each other in a text."""
    along = Window.partitionBy("doc", "row").orderBy("start")
    rows = found.withColumns({"d1": F.col("digest"), "e1": F.col("start") + F.col("size"), "v1": F.col("word") + F.col("words")})
    n = 1
    while n < MOST_CHUNKS:
        d, e, v = (f"{c}{n}" for c in "dev")
        there = lambda c, n=n: F.lead(c, n).over(along)
        whole = F.col(d).isNotNull() & there(d).isNotNull() & (there("start") - F.col(e) <= GAP)
        joint = F.xxhash64(d, there(d), there("start") - F.col("start"))
        rows = rows.withColumns({f"d{2 * n}": F.when(whole, joint), f"e{2 * n}": there(e), f"v{2 * n}": there(v)})
        n *= 2
    scales = [2**k for k in range(1, MOST_CHUNKS.bit_length())]
    each = F.array(*(F.struct(F.col(f"d{n}").alias("d"), F.col(f"e{n}").alias("e"), F.col(f"v{n}").alias("v")) for n in scales))
    rows = rows.select("doc", "row", "start", "word", F.explode(each).alias("x")).where("x.d IS NOT NULL")
    return rows.selectExpr("doc", "row", "x.d AS digest", "start", "x.e - start AS size", "word", "x.v - word AS words")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each asked span of a text: what stands on either side, and a digest of what is inside."""
    names = ["doc", "s", "e", "left", "right", "inside"]
    for batch in batches:
        for part in slices(batch, "text"):
            out: list[list] = [[] for _ in names]
            for doc, text, asked in zip(*(part.column(i) for i in range(3))):
                data = (text.as_py() or "").encode()
                for span in asked.as_py():
                    s, e = span["s"], span["e"]
                    found = hashlib.blake2b(data[s:e], digest_size=16).digest()
                    row = (doc.as_py(), s, e, data[max(0, s - CONTEXT) : s], data[e : e + CONTEXT], found)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def shared_prefix(a: bytes, b: bytes) -> int:
    """Bytes that both begin with, in whole words: up to white space, or to the end of the text."""
    n = min(len(a), len(b))
    if a[:n] != b[:n]:
        low, high = 0, n
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
        n = low
    whole = [x[n : n + 1].isspace() or n == len(x) < CONTEXT for x in (a, b)]
    return n if all(whole) else max(0, *(a.rfind(blank, 0, n) for blank in _BLANKS))


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and words by which two equal spans can be made longer on the left and on the right; nulls if unequal."""
    for batch in batches:
        *kept, l1, r1, i1, l2, r2, i2 = batch.columns
        found = []
        for a, b, x, c, d, y in zip(*(v.to_pylist() for v in (l1, r1, i1, l2, r2, i2))):
            if x != y:
                found.append((None,) * 4)
                continue
            right, left = shared_prefix(b, d), shared_prefix(a[::-1], c[::-1])
            found.append((left, len(a[len(a) - left :].split()), right, len(b[:right].split())))
        more = [pa.array(v, pa.int32()) for v in zip(*found)] if found else [pa.array([], pa.int32())] * 4
        yield pa.RecordBatch.from_arrays([*kept, *more], names=[*batch.schema.names[: len(kept)], "lb", "lw", "rb", "rw"])


def _may_hold(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (4 MB) of the hashes of ids."""
    spot = F.pmod(F.xxhash64("doc"), F.lit(BITMAP))
    bits = ids.select((spot / 64).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc), {BITMAP}) % 64 as int))").alias("bit"))
    found = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITMAP // 64, np.int64)
    out[np.asarray(found["at"])] = np.asarray(found["bits"])
    return out


def _extended(rows: DataFrame, islands: DataFrame) -> DataFrame:
    """islands (doc, first, shift, s, e, ...) and by how much each can be made longer: lb, lw, rb, rw; null if unequal."""
    theirs = (F.col("s") - F.col("shift"), F.col("e") - F.col("shift"))
    asked = islands.select("doc", "s", "e").union(islands.select("first", *theirs)).distinct()
    asked = asked.groupBy("doc").agg(F.collect_list(F.struct("s", "e")).alias("asked"))
    shared = rows.sparkSession.sparkContext.broadcast(_may_hold(islands.select("doc").union(islands.select("first"))))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # keeps most texts that nobody asks for out of the shuffle
            spot = np.asarray(batch.column(2))
            held = shared.value[spot // 64] >> (spot % 64) & 1
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["doc", "text"]).filter(pa.array(held.astype(bool)))

    some = rows.select("doc", "text", F.pmod(F.xxhash64("doc"), F.lit(BITMAP)).alias("spot")).mapInArrow(near, "doc long, text string")
    around = some.join(asked, "doc").select("doc", "text", "asked").mapInArrow(
        _contexts, "doc long, s int, e int, left binary, right binary, inside binary"
    )
    around = settle(around, "contexts", batch=TEXTS)
    copy = around.select(
        F.col("doc").alias("first"), F.col("s").alias("fs"), F.col("e").alias("fe"), F.col("left").alias("l2"),
        F.col("right").alias("r2"), F.col("inside").alias("i2"),
    )
    sides = islands.join(around, ["doc", "s", "e"]).withColumns({"fs": theirs[0], "fe": theirs[1]})
    sides = sides.join(copy, ["first", "fs", "fe"])
    kept = [islands.schema[c] for c in islands.columns]
    schema = T.StructType([*kept, *(T.StructField(c, T.IntegerType()) for c in ("lb", "lw", "rb", "rw"))])
    return sides.select(*islands.columns, "left", "right", "inside", "l2", "r2", "i2").mapInArrow(_sides, schema)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per passage of a document that also stands in another: doc_id, start, end, n_words, kept, kept_doc_id, kept_start.

    start and end are byte offsets in the UTF-8 text. A passage has min_words words or more, is equal byte for byte
    to the one it points at, and is as long as it can be made by whole words; kept marks the occurrence that dedup
    leaves in place (that with the smallest doc_id), once for each extent in which others repeat it.

    Cuts depend on the 32 bytes before them only, so an insertion moves no cut behind it: within any repeated passage
    the same chunks come up again. Digests are counted over all documents; each repeated chunk is led to the first
    document that has it, and so are each 2, 4, ... MOST_CHUNKS repeated chunks that follow each other, so that a passage
    whose parts stand in other documents too still meets one that has it whole. Neighbouring ones are joined, their bytes compared by a digest of 128 bits and the text on
    both sides byte by byte. Words are runs without ASCII white space.

    Null or empty texts have no passage. Rows without a doc_id take part as one document that comes before all
    others; rows that share a doc_id are one document, and what repeats only among them is left alone. An empty
    table gives no rows; other columns are not looked at.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), "text")
    found = chunks(rows)
    found = settle(found.join(_first(found), "digest"), "repeated", batch=TEXTS)
    wide = settle(_together(found.drop("first", "first_start").distinct()), "together")
    wide = wide.join(_first(wide), "digest")
    hits = found.unionByName(wide).where("doc <> first")
    hits = hits.select("doc", "first", (F.col("start") - F.col("first_start")).alias("shift"), "start", "size", "word", "words").distinct()

    by = ("doc", "first", "shift")
    along = Window.partitionBy(*by).orderBy("start", "size")
    end = F.col("start") + F.col("size")
    away = F.col("start") - F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    hits = hits.withColumn("new", F.coalesce(away > 0, F.lit(True)).cast("int"))
    hits = hits.withColumn("far", F.coalesce(away > GAP, F.lit(True)).cast("int"))
    hits = hits.withColumn("run", F.sum("new").over(along)).withColumn("island", F.sum("far").over(along))
    runs = hits.groupBy(*by, "island", "run").agg(
        F.min("start").alias("s"), F.max(end).alias("e"), F.min("word").alias("w"),
        F.max(F.col("word") + F.col("words")).alias("v"),
    )
    islands = runs.groupBy(*by, "island").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.min("w").alias("w"), F.max("v").alias("v"),
        F.collect_list(F.struct("s", "e", "w", "v")).alias("runs"),
    )
    islands = settle(islands.where(F.col("v") - F.col("w") >= EVIDENCE_WORDS).drop("island"), "islands")
    whole = settle(_extended(rows, islands), "extended")
    # an island whose bytes differ between its chunks is taken chunk by chunk
    torn = whole.where("lb IS NULL").select(*by, F.explode("runs").alias("r")).select(*by, "r.*")
    torn = torn.withColumn("runs", F.array(F.struct("s", "e", "w", "v")))
    if not torn.isEmpty():
        whole = whole.union(_extended(rows, settle(torn, "torn")))
    longer = whole.where("lb IS NOT NULL").select(
        *by, (F.col("s") - F.col("lb")).alias("s"), (F.col("e") + F.col("rb")).alias("e"),
        (F.col("w") - F.col("lw")).alias("w"), (F.col("v") + F.col("rw")).alias("v"),
    )

    along = Window.partitionBy("doc", "first", "shift").orderBy("s", "e")
    before = F.max("e").over(along.rowsBetween(Window.unboundedPreceding, -1))
    longer = longer.withColumn("new", F.coalesce(F.col("s") > before, F.lit(True)).cast("int"))
    longer = longer.withColumn("run", F.sum("new").over(along))
    passages = longer.groupBy("doc", "first", "shift", "run").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), (F.max("v") - F.min("w")).alias("n_words")
    )
    passages = settle(passages.where(F.col("n_words") >= min_words), "passages")
    kept = passages.select(
        F.col("first").alias("doc"), "first", (F.col("s") - F.col("shift")).alias("s"),
        (F.col("e") - F.col("shift")).alias("e"), "n_words",
    ).distinct()
    out = passages.select(
        "doc", "first", "s", "e", "n_words", F.lit(False).alias("kept"), (F.col("s") - F.col("shift")).alias("fs")
    ).union(kept.select("doc", "first", "s", "e", "n_words", F.lit(True), "s"))
    name = lambda c: F.nullif(F.col(c), F.lit(_NO_ID))
    return out.select(
        name("doc").alias("doc_id"), F.col("s").alias("start"), F.col("e").alias("end"), "n_words", "kept",
        name("first").alias("kept_doc_id"), F.col("fs").alias("kept_start"),
    )


def _without(text: str | None, gone: list[dict] | None) -> str | None:
    if not gone:
        return text
    data, out, at = (text or "").encode(), [], 0
    for span in sorted(gone, key=lambda x: (x["start"], x["end"])):
        if span["start"] > at:
            out.append(data[at : span["start"]])
        at = max(at, span["end"])
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "ignore")


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with every passage but its kept occurrence cut out of text; a column n_chars follows the new text.

    All rows stay, null texts stay null, and texts without a repeated passage stay as they are. Texts that share a
    doc_id, or have none, are documents of their own here, behind all others.
    """
    gone, doc, own = fresh(docs, "gone_spans", "gone_doc", "gone_own")
    number = F.col("doc_id").cast("long")
    shared = settle(docs.groupBy(number.alias(own)).count().where(F.col(own).isNull() | (F.col("count") > 1)).select(own), "shared")
    if shared.isEmpty():
        docs_own = docs.withColumn(own, number)
    else:  # a number made of the id and the text, above all usual ids
        alone = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
        marked = docs.join(shared.select(F.col(own).alias(doc)), number.eqNullSafe(F.col(doc)), "left_semi").withColumn(own, alone)
        docs_own = docs.join(shared.select(F.col(own).alias(doc)), number.eqNullSafe(F.col(doc)), "left_anti").withColumn(own, number).union(marked)
    found = repeated_passages(docs_own.select(F.col(own).alias("doc_id"), "text"), min_words).where("NOT kept")
    found = found.groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set(F.struct("start", "end")).alias(gone))
    joined = docs_own.join(found, F.col(own) == F.col(doc), "left").drop(doc, own)
    at, spot = joined.columns.index("text"), joined.columns.index(gone)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = [_without(t.as_py(), g.as_py()) for t, g in zip(columns[at], columns[spot])]
            columns[at] = pa.array(texts, columns[at].type)
            del columns[spot]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != gone])

    out = joined.mapInArrow(work, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out

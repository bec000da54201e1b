"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH over item-sized windows, exact edit check."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import SPACE, slices, text_bytes

#: Edits allowed, as a share of the item's length.
MAX_EDITS = 0.15
#: Items are cut into pieces of this many bytes, or fewer where as many edits as are allowed could touch every piece.
PIECE = 6
#: Overlapping runs of this many bytes are counted around a window: each edit breaks no more than as many.
RUN = 4
#: Items whose pieces are looked up at once, and hits of pieces that are sorted at once.
GROUP, HITS = 250, 4_000_000
#: Share of the copies with exactly as many edits as are allowed that must be found; a test measures it.
RECALL = 0.99
#: Independent walks, hash tables a walk, and sampled places a table: as many tables as RECALL takes.
WALKS, TABLES, PLACES = 12, 8, 3
#: Items handled in one pass over the documents; more items take more passes.
BLOCK = 20_000
#: Text handled at once: walks are made for all windows of it together, so shorter runs cost more steps.
STRIP_BYTES = 1 << 21
#: Lengths of items that share walks and sampled places differ by at most this factor.
BAND = 1.25

_PAD = 0

#: White space of one byte, and the first bytes of that of two and three bytes.
_BLANK = SPACE.copy()
_BLANK[28:32] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE = np.array([int.from_bytes(c.encode().ljust(3, b"\0")) for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))])


def squeezed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of texts in lower case, each run of white space one blank, none at the ends.

    Items and documents both come through here, so a copy with wider gaps or line breaks is the same bytes.
    """
    data, offsets = text_bytes(pc.utf8_lower(column.fill_null("")))
    blank = _BLANK[data]
    lead = np.flatnonzero(_LEAD[data])
    padded = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.int64)
    two = data[lead] == 0xC2
    code = (padded[lead] << 16) + (padded[lead + 1] << 8) + np.where(two, 0, padded[lead + 2])
    wide = np.isin(code, _WIDE)
    lead, two = lead[wide], two[wide]
    blank[lead] = blank[lead + 1] = True
    blank[lead[~two] + 2] = True
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    keep[begin] = ~blank[begin]
    used = np.flatnonzero(keep)
    last = used[np.maximum(np.searchsorted(used, offsets[1:]) - 1, 0)] if len(used) else used
    keep[last[blank[last]]] = False
    ends = np.append(0, np.cumsum(keep))
    return np.where(blank, np.uint8(32), data)[keep], ends[offsets]


def normal(text: str) -> str:
    """Lower case, each run of white space one blank, none at the ends."""
    return squeezed(pa.array([text], pa.string()))[0].tobytes().decode()


def infix_distance(item: bytes, text: bytes) -> int:
    """Fewest edits that turn item into some substring of text (Myers' bit vectors, one column per byte of text)."""
    m = len(item)
    if not m:
        return 0
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            best = min(best, score)
        ph = ph << 1 & full
        mh = mh << 1 & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
    return best


def walk_bits(band: int, steps: int) -> np.ndarray:
    """[walk, step, byte] random bits: whether a walk moves on after it has read that byte in that step."""
    return np.random.default_rng(1000 + band).integers(0, 2, (WALKS, steps, 256), dtype=np.uint8)


def sampled_places(band: int, steps: int) -> np.ndarray:
    """[walk, table, place] steps whose output a hash table samples."""
    return np.random.default_rng(2000 + band).integers(0, steps, (WALKS, TABLES, PLACES))


def embed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, band: int, steps: int) -> np.ndarray:
    """[window, table] keys: what the CGK embedding of each window shows at each table's sampled places.

    The embedding reads one byte a step and moves on or not by a random bit of (step, byte); edits shift two walks
    against each other only until they meet again, so windows a few edits apart agree in most of the output.
    """
    bits, places = walk_bits(band, steps).transpose(1, 0, 2).reshape(steps, -1), sampled_places(band, steps)
    padded = np.append(data, np.uint8(_PAD))
    keys = np.zeros((WALKS * TABLES, len(starts)), np.uint64)
    wanted: dict[int, list[int]] = {}
    for t, some in enumerate(places.reshape(WALKS * TABLES, PLACES).tolist()):
        for j in some:
            wanted.setdefault(j, []).append(t)
    at, own = np.tile(starts, (WALKS, 1)), 256 * np.arange(WALKS)[:, None]
    for j in range(max(wanted) + 1):
        seen = padded[np.where(at < ends, at, len(data))]
        for t in wanted.get(j, ()):
            keys[t] = keys[t] * np.uint64(257) + seen[t // TABLES]
        at += bits[j][seen + own]
    keys = keys.T
    return keys


@dataclass
class Items:
    """The items of one pass: ids, normal texts, bands, hash keys, edits allowed, pieces that survive them, spots of
    their runs of RUN bytes; by group of items and piece length: sorted pieces, and where each stands in which item."""

    ids: np.ndarray
    texts: list[bytes]
    bands: np.ndarray
    steps: dict[int, int]
    keys: np.ndarray
    most: np.ndarray
    least: np.ndarray
    runs: list[np.ndarray]
    groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _band(n: int) -> int:
    return int(np.log(max(n, 1)) / np.log(BAND))


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from each place on, as one number."""
    n = max(len(data) - q + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(q):
        out = (out << np.uint64(8)) | data[k : k + n]
    return out


def _spots(grams: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((grams + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value is in the sorted table, and whether it is."""
    at = np.minimum(np.searchsorted(table, values), max(len(table) - 1, 0))
    return at, table[at] == values if len(table) else np.zeros(len(values), bool)


def _groups(texts: list[bytes], sizes: np.ndarray) -> list[tuple]:
    """Pieces of GROUP items at a time, by piece length."""
    out = []
    for q in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == q)
        for i in range(0, len(own), GROUP):
            item = np.concatenate([np.full(len(texts[x]) // q, x) for x in own[i : i + GROUP].tolist()])
            offset = np.concatenate([np.arange(len(texts[x]) // q) * q for x in own[i : i + GROUP].tolist()])
            grams = np.concatenate([_grams(np.frombuffer(texts[x], np.uint8), q)[::q][: len(texts[x]) // q] for x in own[i : i + GROUP].tolist()])
            order = np.argsort(grams, kind="stable")
            words, begin = np.unique(grams[order], return_index=True)
            bits = max(10, (64 * len(words) - 1).bit_length())
            held = np.zeros(1 << min(bits, 24), bool)
            held[_spots(words, min(bits, 24)).astype(np.int64)] = True
            out.append((q, held, words, np.append(begin, len(order)), item[order], offset[order]))
    return out


def prepare(benchmark: pa.Table, max_edits: float = MAX_EDITS) -> Items | None:
    """Pieces and hash keys of a block of items."""
    pairs = [(i.as_py(), normal(t.as_py() or "").encode()) for i, t in zip(benchmark["item_id"], benchmark["text"])]
    pairs = sorted({(i, t) for i, t in pairs if i is not None and re.search(rb"\w|[\x80-\xff]", t)})
    texts = [t for _, t in pairs]
    if not texts:
        return None
    lengths = np.array([len(t) for t in texts])
    most = np.array([int(max_edits * n) for n in lengths.tolist()])
    sizes = np.where(lengths // PIECE >= most + 3, PIECE, np.clip(lengths // (most + 1), 1, PIECE - 1))
    least = np.maximum(lengths // sizes - most, 1)
    bands = np.array([_band(n) for n in lengths.tolist()])
    steps = {int(b): 2 * int(lengths[bands == b].min()) for b in np.unique(bands)}
    keys = np.zeros((len(texts), WALKS * TABLES), np.uint64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(lengths)
    for band, n in steps.items():
        own = np.flatnonzero(bands == band)
        keys[own] = embed(data, ends[own] - lengths[own], ends[own], band, n)
    runs = [_spots(_grams(np.frombuffer(t, np.uint8), RUN), 16).astype(np.int64) for t in texts]
    return Items(np.array([i for i, _ in pairs]), texts, bands, steps, keys, most, least, runs, _groups(texts, sizes))


def _crowded(row: np.ndarray, item: np.ndarray, start: np.ndarray, items: Items, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, start) of the hits among as many of one item, with starts within its edits, as pieces survive the edits."""
    reach, widest = max(map(len, items.texts)), int(items.most.max())
    low, high = (width + reach + widest).bit_length(), len(items.texts).bit_length()
    key = np.sort((row << (low + high)) + (item << low) + start + reach)  # starts of two owners are over widest apart
    own = (key >> low) & ((1 << high) - 1)
    last = np.arange(len(key)) + items.least[own] - 1
    there = np.minimum(last, len(key) - 1)
    full = np.flatnonzero((last < len(key)) & (key[there] - key <= items.most[own]))
    edge = np.bincount(full, minlength=len(key) + 1) - np.bincount(last[full] + 1, minlength=len(key) + 1)
    key = np.unique(key[np.cumsum(edge[:-1]) > 0])
    return key >> (low + high), (key >> low) & ((1 << high) - 1), (key & ((1 << low) - 1)) - reach


def _alike(data: np.ndarray, offsets: np.ndarray, items: Items, row: np.ndarray, item: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows' surroundings hold as many of the item's overlapping runs of RUN bytes as its edits must leave."""
    if not len(row):
        return np.zeros(0, bool)
    spots = _spots(_grams(data, RUN), 16).astype(np.int64)
    part = start // (items.most[item] + 1)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    good = np.ones(len(first), bool)
    held = np.zeros(1 << 16, bool)
    for k, (r, i, lo, hi) in enumerate(zip(row[first].tolist(), item[first].tolist(), start[first].tolist(), start[last].tolist())):
        most, own = int(items.most[i]), items.runs[i]
        if len(own) > RUN * most:
            there = spots[max(int(offsets[r]), lo - most) : max(0, min(int(offsets[r + 1]), hi + len(items.texts[i]) + most) - RUN + 1)]
            held[there] = True
            good[k] = np.count_nonzero(held[own]) >= len(own) - RUN * most
            held[there] = False
    return np.repeat(good, last - first + 1)


def windows(data: np.ndarray, offsets: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, start) of the windows laid over the texts.

    Edits leave whole all but as many of an item's pieces as there are edits, and shift the pieces against each other
    by no more than that; so every copy within the limit has a window at each of its whole pieces. Likewise no more
    than RUN of its overlapping runs are lost by an edit; both counts only leave out what cannot be a copy.
    """
    found = []
    reach = max(map(len, items.texts)) + 2 * int(items.most.max())
    grams: dict[int, np.ndarray] = {}
    for q, held, words, begin, owner, offset in items.groups:
        if q not in grams:
            grams[q] = _grams(data, q)
        place = np.flatnonzero(held[_spots(grams[q], len(held).bit_length() - 1).astype(np.int64)])
        at, hit = _find(words, grams[q][place])
        at, place = at[hit], place[hit]
        row = np.searchsorted(offsets, place, "right") - 1
        whole = place + q <= offsets[row + 1]
        at, place, row = at[whole], place[whole], row[whole]
        many = begin[at + 1] - begin[at]
        total = np.append(0, np.cumsum(many))
        a = 0
        while a < len(place):  # a portion of the places at a time, and as much beyond as a window may reach
            b = max(a + 1, int(np.searchsorted(total, total[a] + HITS, "right")) - 1)
            c = int(np.searchsorted(place, place[b - 1] + reach, "right"))
            some = many[a:c]
            use = np.repeat(begin[at[a:c]] - (total[a:c] - total[a]), some) + np.arange(total[c] - total[a])
            own = np.repeat(row[a:c], some), owner[use], np.repeat(place[a:c], some) - offset[use]
            found.append(_crowded(*own, items, len(data) + 1))
            a = b
    row, item, start = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    start = np.maximum(start, offsets[row])
    _, once = np.unique(np.stack([row, item, start]), axis=1, return_index=True)
    row, item, start = row[once], item[once], start[once]
    use = _alike(data, offsets, items, row, item, start)
    return row[use], item[use], start[use]


def candidates(data: np.ndarray, offsets: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, start) of the windows that agree with their item in a hash table."""
    row, item, start = windows(data, offsets, items)
    good = np.zeros(len(row), bool)
    sizes = np.array([len(t) for t in items.texts])
    for band, steps in items.steps.items():
        own = np.flatnonzero(items.bands[item] == band)
        for i in range(0, len(own), 20_000):
            some = own[i : i + 20_000]
            end = np.minimum(start[some] + sizes[item[some]], offsets[row[some] + 1])
            keys = embed(data, start[some], end, band, steps)
            good[some] = (keys == items.keys[item[some]]).any(axis=1)
    return row[good], item[good], start[good]


def matches(column: pa.Array, items: Items) -> dict[tuple[int, int], int]:
    """Fewest edits by (row, item) of the texts of a column."""
    data, offsets = squeezed(column)
    best: dict[tuple[int, int], int] = {}
    done: dict[tuple[int, int], int] = {}
    for row, item, start in zip(*(x.tolist() for x in candidates(data, offsets, items))):
        text, most = items.texts[item], int(items.most[item])
        if best.get((row, item), most + 1) == 0:
            continue
        # the copy begins within most of start; room for another most lets near windows share one check
        a = max(int(offsets[row]), start - most)
        b = min(int(offsets[row + 1]), start + len(text) + 2 * most)
        if start + len(text) + most <= done.get((row, item), -1):
            continue
        done[row, item] = start + len(text) + 2 * most
        window = data[a:b].tobytes()
        edits = 0 if text in window else infix_distance(text, window)
        if edits <= most:
            best[row, item] = min(edits, best.get((row, item), edits))
    return best


def _blocks(docs: DataFrame, benchmark: DataFrame, max_edits: float):
    """The items in blocks of BLOCK, made ready and broadcast."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
    blocks = max(1, -(-items.count() // BLOCK))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        packed = prepare(some.toArrow(), max_edits)
        if packed is not None:
            yield docs.sparkSession.sparkContext.broadcast(tuple(vars(packed).values()))


def leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """One row per document and benchmark item that stands in it: doc_id, item_id, edits, item_bytes.

    An item stands in a document if some substring of the text is within max_edits times the item's length of it in
    edits (bytes of lower-cased text, white space squeezed). Item-sized windows are laid wherever as
    many of the item's pieces stand near their places as any copy within the limit must keep, so every copy gets
    windows, in scripts without blanks too. Windows that agree with the item in a hash table over the CGK embedding are
    checked exactly, so no row is wrong; the number of tables is set for RECALL of the copies at the limit of edits.

    Every text is read whole. Items are read in blocks of BLOCK, each with one pass over the documents. Null or
    empty texts and items without a word match nothing; a null item_id is passed over; repeated documents get their
    rows each, repeated items count once; an empty table gives no rows; extra columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, edits int, item_bytes int"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _blocks(rows, benchmark, max_edits):

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                for part in slices(batch, "text", STRIP_BYTES):
                    best = matches(part.column(1), items)
                    rows = np.array([r for r, _ in best], np.int64)
                    used = np.array([i for _, i in best], np.int64)
                    sizes = np.array([len(items.texts[i]) for i in used.tolist()], np.int32)
                    edits = np.array(list(best.values()), np.int32)
                    yield pa.record_batch(
                        [part.column(0).take(pa.array(rows)), *map(pa.array, (items.ids[used].astype(np.int64), edits, sizes))],
                        names=["doc_id", "item_id", "edits", "item_bytes"],
                    )

        out = out.union(rows.mapInArrow(work, schema))
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """docs without the rows in which a benchmark item stands; each row is judged by its own text, without a shuffle."""
    out, at = docs, docs.columns.index("text")
    for shared in _blocks(docs, benchmark, max_edits):

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                for part in slices(batch, "text", STRIP_BYTES):
                    clean = np.ones(len(part), bool)
                    clean[[r for r, _ in matches(part.column(at), items)]] = False
                    yield part.filter(pa.array(clean))

        out = out.mapInArrow(work, docs.schema)
    return out

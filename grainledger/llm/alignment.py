"""Cross-tokenizer alignment: documents are cut at shared token ends before blanks, and windows of ids aligned once."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle
from .textscan import mix, slices, span_hashes

#: Text that is tokenised at once, and text of a block, whose distinct id pairs are counted together.
STRIP_BYTES, BLOCK_BYTES = 1 << 20, 1 << 23
#: Pairs of tokens of one group that are listed one by one; those of larger groups are counted by distinct ids.
PAIRED = 1 << 12
#: The splitting pattern of byte-level vocabularies. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bits of an id in the code of a pair.
ID_BITS = 20


# --- vocabularies ---------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, then from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def moving_characters() -> np.ndarray:
    """Code points that Unicode versions class differently, as packed bits; all that came after version 3.2 among them.

    Two libraries with tables of different versions split texts without these in the same way.
    """
    old, now = unicodedata.ucd_3_2_0.category, unicodedata.category
    moving = np.array([old(c) != now(c) or now(c) in ("Cn", "Cs") for c in map(chr, range(0x110000))])
    moving[[*range(0x1C, 0x20), *range(0x80, 0xA0)]] = True
    return np.packbits(moving)


@dataclass(frozen=True)
class Vocabularies:
    """Files of a byte-level BPE vocabulary (JSON) and of a piece vocabulary (model), and what tells their splits apart."""

    first: bytes
    second: bytes
    moving: np.ndarray

    @classmethod
    def load(cls, first: str, second: str) -> Vocabularies:
        files = []
        for path in (first, second):
            with open(path, "rb") as file:
                files.append(file.read())
        return cls(*files, moving_characters())


class Tokenizers:
    """Ids of texts in both vocabularies, and the bytes of each id."""

    def __init__(self, first: bytes, second: bytes, moving: np.ndarray) -> None:
        import sentencepiece
        import tiktoken

        self.file, self.exact = first.decode(), None
        model = json.loads(first)["model"]
        alphabet, vocabulary = byte_alphabet(), model["vocab"]
        token = lambda s: bytes(alphabet[c] for c in s)
        left = {i: token(s) for s, i in vocabulary.items()}
        # merging by rank needs ids that follow the order of the merges
        joined = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        self.ranked = joined == sorted(joined) and len(left) == 256 + len(joined)
        self.fast = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks={t: i for i, t in left.items()}, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=second)
        right = {}
        for i in range(self.pieces.vocab_size()):
            piece = self.pieces.id_to_piece(i)
            right[i] = bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()
        self.moving = np.unpackbits(moving).view(bool)
        self.tables = [pa.array([t.get(i, b"") for i in range(max(t) + 1)], pa.large_binary()) for t in (left, right)]
        self.sizes = [np.array([len(t.get(i, b"")) for i in range(max(t) + 1)], np.int64) for t in (left, right)]
        self.blank = [np.array([t.get(i, b"").startswith(b" ") for i in range(max(t) + 1)]) for t in (left, right)]

    def _first(self, text: str) -> list[int]:
        if self.ranked and (text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") or not self.moving[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any()):
            return self.fast.encode_ordinary(text)
        if self.exact is None:
            import tokenizers

            self.exact = tokenizers.Tokenizer.from_str(self.file)
            self.exact.encode_special_tokens = True
        return self.exact.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of a blank and the text in the first vocabulary, of the text in the second; none where texts are not spelt out."""
        none = np.zeros(0, np.int32)
        first = [np.array(self._first(" " + t), np.int32) if t else none for t in texts]
        second = [np.array(x, np.int32) for x in self.pieces.encode(texts, num_threads=1)] if texts else []
        spelt = [b" " + t.encode() if t else b"" for t in texts]
        for side, ids in enumerate((first, second)):
            ends = np.cumsum([len(x) for x in ids])
            flat = np.concatenate([none, *ids])
            out = self.tables[side].take(pa.array(flat))
            offsets = np.frombuffer(out.buffers()[1], np.int64)[: len(out) + 1] if len(out) else np.zeros(1, np.int64)
            data = memoryview(out.buffers()[2]) if len(out) else memoryview(b"")
            at = offsets[np.append(0, ends)].tolist()
            for row, (a, b) in enumerate(zip(at, at[1:])):
                if bytes(data[a:b]) != spelt[row]:
                    first[row], second[row], spelt[row] = none, none, b""
        return first, second


# --- windows --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Windows:
    """Aligned windows: their groups as text, how many, their links, and the linked id pairs with their numbers.

    The pairs of all windows stand one behind the other; many[i] of them belong to window i.
    """

    text: pa.Array
    groups: np.ndarray
    links: np.ndarray
    many: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


@dataclass(frozen=True)
class Aligned:
    """Some documents' numbers, group texts, and the distinct id pairs of each (pairs and times, cut at ends)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    texts: list[bytes]
    pairs: np.ndarray
    times: np.ndarray
    ends: np.ndarray


class Aligner:
    """Aligns documents strip by strip; windows with the same ids on both sides are aligned once in a strip."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        # an id as text, with the sign that follows it: between ids, at the end of a side, at the end of a group
        signs = [[b"%d%b" % (i, sign) for i in range(len(tokenizers.sizes[s])) for sign in (b",", end)] for s, end in ((0, b"|"), (1, b";"))]
        self.second = len(signs[0])
        self.names = pa.array(signs[0] + signs[1], pa.large_binary())

    def _cuts(self, ids: np.ndarray, own: np.ndarray, other: np.ndarray, last: np.ndarray, side: int) -> np.ndarray:
        """Where windows end, counted in tokens: at ends shared with the other side, before a blank or at a text's end."""
        blank = np.append(self.tokenizers.blank[side][ids[1:]], False)
        blank[last] = True
        return np.flatnonzero(_shared(own, other) & blank) + 1

    def windows(self, ids: list[np.ndarray], cuts: list[np.ndarray]) -> Windows:
        """The alignment of windows that stand one behind the other; cuts are their ends, counted in tokens."""
        ends = [np.cumsum(self.tokenizers.sizes[s][ids[s]]) for s in (0, 1)]
        close = [_shared(ends[s], ends[1 - s]) for s in (0, 1)]  # a group ends with this token
        group = [np.cumsum(c) - c for c in close]
        n = int(close[0].sum())
        sizes = [np.bincount(g, minlength=n) for g in group]
        links = sizes[0] * sizes[1]
        last = np.append(0, np.cumsum(close[0]))[cuts[0]]  # groups up to each window's end
        groups = np.diff(last, prepend=0)

        place = np.concatenate([2 * ids[0].astype(np.int64) + close[0], self.second + 2 * ids[1].astype(np.int64) + close[1]])
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        spelt = self.names.take(pa.array(place[order]))
        offsets = np.frombuffer(spelt.buffers()[1], np.int64)[: len(order) + 1][np.append(0, cuts[0] + cuts[1])]
        text = pa.Array.from_buffers(pa.large_binary(), len(cuts[0]), [None, pa.py_buffer(offsets.tobytes()), spelt.buffers()[2]])

        large = links > PAIRED
        starts = np.cumsum(sizes[1]) - sizes[1]
        partners = np.where(large, 0, sizes[1])[group[0]]
        left = np.repeat(np.arange(len(ids[0])), partners)
        right = np.repeat(starts[group[0]] - (np.cumsum(partners) - partners), partners) + np.arange(len(left))
        pairs = ids[0][left].astype(np.int64) << ID_BITS | ids[1][right]
        owner, times = group[0][left], np.ones(len(pairs), np.int64)
        for g in np.flatnonzero(large).tolist():  # all pairs of a large group, by distinct ids
            (a, x), (b, y) = (np.unique(ids[s][group[s] == g].astype(np.int64), return_counts=True) for s in (0, 1))
            pairs = np.append(pairs, (a[:, None] << ID_BITS | b).ravel())
            times = np.append(times, np.outer(x, y).ravel())
            owner = np.append(owner, np.full(len(a) * len(b), g))
        window = np.searchsorted(last, owner, "right")
        order = np.argsort(window, kind="stable")
        many = np.bincount(window, minlength=len(last))
        return Windows(text, groups, np.diff(np.append(0, np.cumsum(links))[last], prepend=0), many, pairs[order], times[order])

    def align(self, texts: list[str]) -> Aligned:
        first, second = self.tokenizers.ids(texts)
        counts = [np.array([len(x) for x in side], np.int64) for side in (first, second)]
        ids = [np.concatenate([np.zeros(0, np.int32), *side]) for side in (first, second)]
        n = len(texts)
        if not len(ids[0]):
            none = np.zeros(0, np.int64)
            return Aligned(*counts, np.zeros(n, np.int64), np.zeros(n, np.int64), [b""] * n, none, none, np.zeros(n, np.int64))
        ends = [np.cumsum(self.tokenizers.sizes[s][ids[s]]) for s in (0, 1)]
        last = [(np.cumsum(c) - 1)[c > 0] for c in counts]
        cuts = [np.append(0, self._cuts(ids[s], ends[s], ends[1 - s], last[s], s)) for s in (0, 1)]
        # windows with equal ids get one number: by a hash of their ids, which is then checked
        with np.errstate(over="ignore"):
            hashes = [span_hashes(ids[s], cuts[s][:-1], cuts[s][1:]) for s in (0, 1)]
            _, head, number = np.unique(mix(hashes[0]) * np.uint64(3) + hashes[1], return_index=True, return_inverse=True)
        for s in (0, 1):
            size = np.diff(cuts[s])
            shift = np.repeat(cuts[s][head[number]] - cuts[s][:-1], size)
            if (size != size[head[number]]).any() or (ids[s] != ids[s][np.arange(len(ids[s])) + shift]).any():
                head = number = np.arange(len(size))  # two windows share a hash: every window by itself
        taken, stops = zip(*(_spans(ids[s], cuts[s][head], cuts[s][head + 1]) for s in (0, 1)))
        windows = self.windows(list(taken), list(stops))
        doc = np.repeat(np.arange(n), np.diff(np.searchsorted(cuts[0], np.append(0, np.cumsum(counts[0])))))
        groups, links = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(groups, doc, windows.groups[number])
        np.add.at(links, doc, windows.links[number])
        texts_of = windows.text.take(pa.array(number))
        offsets = np.frombuffer(texts_of.buffers()[1], np.int64)[: len(number) + 1]
        data = memoryview(texts_of.buffers()[2])
        at = offsets[np.append(0, np.cumsum(np.bincount(doc, minlength=n)))].tolist()
        spelt = [bytes(data[p : max(p, q - 1)]) for p, q in zip(at, at[1:])]
        return Aligned(*counts, groups, links, spelt, *_pairs_of(windows, number, doc, n))


def _shared(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of the sorted ends are ends on the other side too."""
    mark = np.zeros(int(own[-1]) + 1, bool)
    mark[other] = True
    return mark[own]


def _spans(ids: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some windows, one behind the other, and where each of them ends."""
    size = stop - start
    ends = np.cumsum(size)
    return ids[np.repeat(start - (ends - size), size) + np.arange(int(size.sum()))], ends


def _pairs_of(windows: Windows, number: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs of each document, how often each is linked, and where each document's pairs end."""
    distinct, code = np.unique(windows.pairs, return_inverse=True)
    begin = np.cumsum(windows.many) - windows.many
    many = windows.many[number]
    at = np.repeat(begin[number] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    found, where = np.unique(np.repeat(doc, many) * len(distinct) + code[at], return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, windows.times[at])
    return distinct[found % len(distinct)], total, np.searchsorted(found, np.arange(1, n + 1) * len(distinct))


# --- documents ------------------------------------------------------------------------------------


def _aligner(shared) -> Aligner:
    """The worker's own aligner, made once."""
    *files, kept = shared.value
    return kept.get("aligner") or kept.setdefault("aligner", Aligner(Tokenizers(*files)))


def _share(docs: DataFrame, vocabularies: Vocabularies):
    files = (vocabularies.first, vocabularies.second, vocabularies.moving)  # two files of a few MB
    return docs.sparkSession.sparkContext.broadcast((*files, {}))


def alignments(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups of every row: groups as `a1,a2|b1;a3|b2,b3`, the ids in order.

    A text that is null, empty, or not spelt out by the tokens of both vocabularies has no tokens and no groups.
    Repeated rows and null ids get their rows; texts of any length are taken whole, each by itself if it is long; an
    empty table gives no rows; extra columns are not looked at.
    """
    shared = _share(docs, vocabularies)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        for batch in batches:
            for part in slices(batch, "text", STRIP_BYTES):
                found = aligner.align(part.column(1).fill_null("").to_pylist())
                numbers = [pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                yield pa.record_batch([part.column(0), *numbers, pa.array([t.decode() for t in found.texts])], names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(work, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string")


_BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
    ("groups_sha256", pa.string()), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
    ("pair", pa.int64()), ("holders", pa.int64()),
])
_BLOCKS_DDL = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "at array<int>, times array<long>, pair long, holders long"
)


def _block(number: int, rows: list[tuple[pa.Array, Aligned]]) -> Iterator[pa.RecordBatch]:
    """A block's documents, which name their id pairs by place, and a row for each of its distinct pairs, in order."""
    pairs = np.concatenate([found.pairs for _, found in rows])
    distinct, at = np.unique(pairs, return_inverse=True)
    start = 0
    for ids, found in rows:
        n, size = len(ids), len(found.pairs)
        cuts = pa.array(np.append(0, found.ends).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (at[start : start + size].astype(np.int32), found.times)]
        digests = [hashlib.sha256(t).hexdigest() if a else "" for t, a in zip(found.texts, found.n_a.tolist())]
        numbers = [pa.array(x) for x in (np.full(n, number), found.n_a, found.n_b, found.n_groups, found.n_links)]
        none = pa.nulls(n, pa.int64())
        yield pa.record_batch([numbers[0], ids, *numbers[1:], pa.array(digests, pa.string()), *lists, none, none], schema=_BLOCKS)
        start += size
    holders = np.bincount(at, minlength=len(distinct))
    held = {"block": pa.array(np.full(len(distinct), number)), "pair": pa.array(distinct), "holders": pa.array(holders)}
    yield pa.record_batch([held.get(f.name, pa.nulls(len(distinct), f.type)) for f in _BLOCKS], schema=_BLOCKS)


def _looked_up(key, docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the corpus-wide counts of their pairs summed up."""
    order = np.argsort(np.asarray(known["pair"]))
    count, best = np.asarray(known["count"])[order], np.asarray(known["best"])[order]
    at, times = docs["at"].combine_chunks(), docs["times"].combine_chunks()
    row = np.repeat(np.arange(len(docs)), np.asarray(at.value_lengths()))
    at, times = np.asarray(at.flatten()), np.asarray(times.flatten())
    n_best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    np.add.at(n_best, row, np.where(best[at], times, 0) if len(at) else times)
    np.add.at(total, row, count[at] * times if len(at) else times)
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    kept = kept.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(total))
    return kept.append_column("groups_sha256", docs["groups_sha256"])


def alignment_counts(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    The count of an id pair is the number of documents that hold it linked; n_best are the links whose count is the
    highest of their first id (ties included), count_sum adds up the counts of all links. groups_sha256 is the digest
    of the groups that `alignments` returns. Rows are treated as there; a repeated row is a document of its own.

    Documents are gathered in blocks, so what is shuffled is each block's distinct pairs and not each document's.
    """
    shared = _share(docs, vocabularies)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in slices(batch, "text", STRIP_BYTES):
                texts = part.column(1).fill_null("").to_pylist()
                held.append((part.column(0), aligner.align(texts)))
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES:
                    yield from _block(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield from _block(number, held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = settle(rows.mapInArrow(work, _BLOCKS_DDL), "aligned")
    held = blocks.where("pair IS NOT NULL").select("block", "pair", "holders")
    counts = held.groupBy("pair").agg(F.sum("holders").alias("count")).withColumn("a", F.shiftright("pair", ID_BITS))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # a row for each id of the vocabulary at most
    known = counts.join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = held.select("block", F.col("pair")).join(known, "pair").select(*(F.col(c).alias(c) for c in ("block", "pair", "count", "best")))
    found = blocks.where("pair IS NULL").drop("pair", "holders").groupBy("block").cogroup(answers.groupBy("block"))
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return found.applyInArrow(_looked_up, out)

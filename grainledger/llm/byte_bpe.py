"""Byte-level BPE: Spark expressions fold ranked merges over the bytes of distinct words; decoding joins pieces."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import settle

#: Words that are folded once and looked up afterwards: the most frequent of all documents. All other words are folded
#: where they stand; the ids are the same.
FREQUENT_WORDS = 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if max(ranks.values()) >= 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must fit into 16 bits and hold every single byte")
    return ranks


# --- constant lookup tables ---------------------------------------------------------------------


def displace(first: np.ndarray, second: np.ndarray, buckets: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Shifts such that (second + shift[first]) modulo slots is different for every key, and those places.

    Keys that agree in both values cannot be told apart: the first of them gets a place, the others get -1.
    """
    shift, place = np.zeros(buckets, np.int64), np.full(len(first), -1, np.int64)
    _, once = np.unique(first * slots + second, return_index=True)
    taken = np.zeros(slots, bool)
    order = once[np.argsort(first[once], kind="stable")]
    edges = np.flatnonzero(np.diff(first[order], prepend=-1, append=-1))
    sizes = np.diff(edges)
    rng = np.random.default_rng(3)
    for g in np.argsort(-sizes, kind="stable")[: (sizes > 1).sum()].tolist():
        keys = order[edges[g] : edges[g + 1]]
        while True:
            d = int(rng.integers(slots))
            at = (second[keys] + d) % slots
            if not taken[at].any():
                break
        taken[at] = True
        shift[first[keys[0]]], place[keys] = d, at
    single = order[edges[:-1][sizes == 1]]
    free = np.flatnonzero(~taken)[: len(single)]
    shift[first[single]], place[single] = (free - second[single]) % slots, free
    return shift, place


def _size(n: int) -> int:
    return 1 << max(4, (2 * n - 1).bit_length())


@dataclass(frozen=True)
class Vocabulary:
    """Literal tables: pair ranks by a perfect hash, ids of bytes, hexadecimal bytes of ids."""

    ranks: dict[bytes, int]
    shift: list[int]
    slots: list[int]
    single: list[int]
    hexes: list[str]
    factor: int

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Vocabulary:
        pairs = np.array(
            [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks],
            np.int64,
        ).reshape(-1, 3)
        size = _size(len(pairs))
        buckets = size // 4
        a, b, rank = pairs.T
        for factor in range(69621, 70621, 2):  # until no two pairs agree in both hashes
            shift, place = displace((a * 40503 + b * 60493) % buckets, (a * 48271 + b * factor) // 8 % size, buckets, size)
            if (place >= 0).all():
                break
        slots = np.full(size, -1, np.int64)
        slots[place] = ((a << 16) + b << 16) + rank
        hexes = [""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            hexes[r] = token.hex().upper()
        return cls(ranks, shift.tolist(), slots.tolist(), [ranks[bytes([i])] for i in range(256)], hexes, factor)


def _constant(spark: SparkSession, value: list, kind: pa.DataType) -> Column:
    """A list as a scalar subquery: computed once, sent with the tasks, and not spelt out in plans."""
    return spark.createDataFrame(pa.table({"value": pa.array([value], pa.list_(kind))})).scalar()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression over a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- words --------------------------------------------------------------------------------------


def java_pattern(spark: SparkSession, pattern: str) -> str:
    """The splitting pattern for Spark's regular expressions, with the tokenizer library's idea of letters and numbers.

    The library's Unicode tables may be newer than the JVM's; code points that only the library counts as letters or
    numbers are added as ranges.
    """
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    extra = []
    for kind in (r"\p{L}", r"\p{N}"):
        one = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(one.encode_ordinary(every)).decode())
        line = spark.sql("SELECT 1").select(F.regexp_replace(F.lit("".join(sorted(theirs))), kind, "").alias("rest"))
        more = sorted(map(ord, line.first().rest))
        cuts = [0, *(i for i in range(1, len(more)) if more[i] != more[i - 1] + 1), len(more)]
        ranges = "".join(f"\\x{{{more[a]:X}}}-\\x{{{more[b - 1]:X}}}" for a, b in zip(cuts, cuts[1:]) if b > a)
        # one comparison settles all characters below the first of them
        extra.append(f"[\\x{{{more[0]:X}}}-\\x{{10FFFF}}&&[{ranges}]]" if more else "")
    letters, numbers = r"\p{L}" + extra[0], r"\p{N}" + extra[1]
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACES}{letters}{numbers}]")
    out = out.replace(r" ?\p{L}+", f" ?[{letters}]+").replace(r" ?\p{N}+", f" ?[{numbers}]+")
    return out.replace(r"\s", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]")


#: White space by the Unicode property of that name. Fixed values.
_SPACES = r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def fold(word: Column, shift: Column, slots: Column, single: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word: of all neighbours the pair with the lowest rank is joined, again and again.

    State: the ids, the rank of each pair of neighbours (null: no token), and the lowest of them. The id of a joined
    pair is its rank. A joined pair gets new neighbours, so two ranks are looked up anew in each step.
    """
    size, buckets = len(vocabulary.slots), len(vocabulary.shift)

    def rank(a: Column, b: Column) -> Column:
        d = shift[((a * 40503 + b * 60493) % buckets).cast("int")]
        entry = slots[((F.shiftright(a * 48271 + b * vocabulary.factor, 3) % size + d) % size).cast("int")]
        return let(entry, lambda e: F.when(F.shiftright(e, 16) == F.shiftleft(a, 16) + b, e.bitwiseAND(F.lit(65535))))

    none = F.array().cast("array<bigint>")
    chars = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    ids = F.transform(F.filter(chars, lambda c: c != ""), lambda c: single[F.ascii(c)])

    def start(s: Column) -> Column:
        ranks = F.when(F.size(s) > 1, F.transform(F.slice(s, 2, F.size(s)), lambda b, i: rank(s[i], b))).otherwise(none)
        return let(ranks, lambda r: F.struct(s.alias("ids"), r.alias("ranks"), F.array_min(r).alias("low")))

    def join(acc: Column, p: Column) -> Column:
        s, r, m = acc["ids"], acc["ranks"], acc["low"]
        left = F.when(p > 1, F.array(rank(s[p - 2], m))).otherwise(none)
        right = F.when(p + 2 <= F.size(s), F.array(rank(m, s[p + 1]))).otherwise(none)
        now = F.concat(F.slice(r, 1, F.greatest(p - 2, F.lit(0))), left, right, F.slice(r, p + 2, F.size(r)))
        joined = F.concat(F.slice(s, 1, p - 1), F.array(m), F.slice(s, p + 2, F.size(s)))
        return let(now, lambda x: F.struct(joined.alias("ids"), x.alias("ranks"), F.array_min(x).alias("low")))

    def step(acc: Column, _: Column) -> Column:
        found = let(F.array_position(acc["ranks"], acc["low"]).cast("int"), lambda p: join(acc, p))
        return F.when(acc["low"].isNull(), acc).otherwise(found)

    return let(ids, lambda s: F.aggregate(F.sequence(F.lit(1), F.size(s)), start(s), step, lambda acc: acc["ids"]))


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """words with the ids of each; a word that is a token as a whole is that token."""
    spark = words.sparkSession
    constants = [
        _constant(spark, vocabulary.shift, pa.int64()), _constant(spark, vocabulary.slots, pa.int64()),
        _constant(spark, vocabulary.single, pa.int64()),
    ]
    named = words.select("word", *(c.alias(n) for c, n in zip(constants, ("shift", "slots", "single"))))
    folded = let(F.col("shift"), lambda h: let(F.col("slots"), lambda t: let(F.col("single"), lambda b: fold(F.col("word"), h, t, b, vocabulary))))
    return named.select("word", folded.alias("ids"))


def token_words(ranks: dict[bytes, int]) -> dict[str, list[int]]:
    """The tokens that are texts; the others are parts of characters and never a word."""
    table = {}
    for token, rank in ranks.items():
        try:
            table[token.decode()] = [rank]
        except UnicodeDecodeError:
            continue
    return table


def frequent_table(docs: DataFrame, pattern: str, vocabulary: Vocabulary, words: int) -> pa.Table:
    """word, ids: the most frequent words, other than tokens, counted over all documents.

    The words are chosen, written and folded on executors; the driver gets them once, with their ids. They stay in
    Arrow: as Python's strings and lists they take several times the memory, and the driver keeps it.
    """
    spark = docs.sparkSession
    tokens = pa.table({"word": pa.array(list(token_words(vocabulary.ranks)), pa.string())})
    found = docs.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("word"))
    found = found.where(F.octet_length("word") <= 64).groupBy("word").count()
    rest = found.join(spark.createDataFrame(tokens), "word", "left_anti")
    top = settle(rest.orderBy(F.desc("count"), "word").limit(words).select("word"), "frequent")
    ids = encode_words(top.repartition(16), vocabulary).withColumn("ids", F.col("ids").cast("array<int>"))
    kinds = pa.schema([("word", pa.string()), ("ids", pa.list_(pa.int64()))])
    return ids.select(kinds.names).toArrow().cast(kinds)


def frequent_words(docs: DataFrame, pattern: str, vocabulary: Vocabulary, words: int) -> dict[str, list[int]]:
    """The same, as ids by word."""
    found = frequent_table(docs, pattern, vocabulary, words)
    return dict(zip(found["word"].to_pylist(), found["ids"].to_pylist()))


def _word_table(spark: SparkSession, table: dict[str, list[int]], tokens: int) -> tuple[list[Column], Callable]:
    """Constants and the lookup of a word's ids in them: null where the table does not have the word."""
    words = list(table)
    mask = (1 << 62) - 1
    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 42) & mask for w in words], np.int64)
    size = _size(len(words))
    buckets = size // 4
    for turn in range(24):  # until every token is in the table; another word may be left out, and is then folded
        shift, place = displace((hashes >> turn) % buckets, (hashes >> 30) % size, buckets, size)
        if (place[:tokens] >= 0).all():
            break
    names: list = [None] * size
    ids: list = [None] * size
    for w, at in zip(words, place.tolist()):
        if at >= 0:
            names[at], ids[at] = w, table[w]
    constants = [
        _constant(spark, shift.tolist(), pa.int64()), _constant(spark, names, pa.string()),
        _constant(spark, ids, pa.list_(pa.int64())),
    ]

    def look(word: Column, shift: Column, names: Column, ids: Column) -> Column:
        at = lambda h: ((F.shiftright(h, 30) % size + shift[(F.shiftright(h, turn) % buckets).cast("int")]) % size).cast("int")
        found = lambda i: F.when(names[i] == word, ids[i])
        return let(F.xxhash64(word).bitwiseAND(F.lit(mask)), lambda h: let(at(h), found))

    return constants, look


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, words: int = FREQUENT_WORDS) -> DataFrame:
    """doc_id, ids of every row: the byte-level BPE ids of each match of the pattern in the whole text.

    A null or empty text has no ids. Repeated rows and null ids get their rows; extra columns are not looked at; an
    empty table gives no rows. All work is in expressions of one row, so nothing is shuffled but the counts of words.
    """
    spark = docs.sparkSession
    split = java_pattern(spark, pattern)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = token_words(vocabulary.ranks)
    tokens = len(table)
    constants, look = _word_table(spark, table | frequent_words(rows, split, vocabulary, words), tokens)
    constants += [
        _constant(spark, vocabulary.shift, pa.int64()), _constant(spark, vocabulary.slots, pa.int64()),
        _constant(spark, vocabulary.single, pa.int64()),
    ]
    names = [f"constant{i}" for i in range(len(constants))]
    rows = rows.select("doc_id", F.regexp_extract_all("text", F.lit(split), F.lit(0)).alias("words"), *(c.alias(n) for c, n in zip(constants, names)))

    def bind(left: list[str], bound: list[Column]) -> Column:
        if left:
            return let(F.col(left[0]), lambda x: bind(left[1:], [*bound, x]))
        word = lambda w: F.coalesce(look(w, *bound[:3]), fold(w, *bound[3:], vocabulary))
        return F.flatten(F.transform("words", word))

    return rows.select("doc_id", bind(names, []).alias("ids"))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """encoded and one more column decoded: the bytes of all ids, one after the other."""
    hexes = _constant(encoded.sparkSession, vocabulary.hexes, pa.string())
    named = encoded.select("*", hexes.alias("hexes"))
    text = let(F.col("hexes"), lambda h: F.array_join(F.transform("ids", lambda i: h[i.cast("int")]), ""))
    return named.select(*encoded.columns, F.unhex(text).alias("decoded"))


# --- whole texts ----------------------------------------------------------------------------------

#: Words handled at once, and rare words that a worker remembers.
STRIP, REMEMBERED = 200_000, 200_000


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word, by the same merges."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        low = min((r for r in found if r is not None), default=None)
        if low is None:
            return [ranks[p] for p in parts]
        i = found.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del found[i]
        if i:
            found[i - 1] = ranks.get(parts[i - 1] + parts[i])
        if i < len(found):
            found[i] = ranks.get(parts[i] + parts[i + 1])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, for words of any length."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if end[i] else n
        if not end[i] or j >= n or end[j] != stop:
            continue  # one of the two has been joined since
        end[i], end[j], after[i] = stop, 0, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n and (r := ranks.get(word[a : end[b]])) is not None:
                heapq.heappush(heap, (r, a, end[b]))
    return [ranks[word[i : end[i]]] for i in range(n) if end[i]]


class Encoder:
    """Ids of many words: looked up in a table of frequent ones, merged and remembered otherwise."""

    def __init__(self, ranks: dict[bytes, int], words: pa.Array, sizes: np.ndarray, flat: np.ndarray) -> None:
        self.ranks, self.words, self.sizes, self.flat = ranks, words, sizes.astype(np.int64), flat.astype(np.int64)
        self.rare: dict[str, array] = {}
        top = max(ranks.values()) + 1
        names, pieces = [b""] * top, [b""] * top
        for token, rank in ranks.items():
            names[rank], pieces[rank] = b"%d," % rank, token
        self.names, self.pieces = pa.array(names, pa.large_binary()), pa.array(pieces, pa.large_binary())

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each word has. Each distinct word is looked up or merged once."""
        coded = words.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.words)
        place = np.asarray(at.fill_null(0), np.int64)
        rest = np.flatnonzero(np.asarray(at.is_null()))
        sizes, flat, begin = self.sizes, self.flat, np.cumsum(self.sizes) - self.sizes
        if len(rest):
            more = [self._rare(w) for w in coded.dictionary.take(pa.array(rest)).to_pylist()]
            place[rest] = len(sizes) + np.arange(len(rest))
            sizes = np.concatenate([sizes, np.fromiter(map(len, more), np.int64, len(more))])
            flat = np.concatenate([flat, np.fromiter((i for ids in more for i in ids), np.int64)])
            begin = np.cumsum(sizes) - sizes
        place = place[np.asarray(coded.indices)]
        count = sizes[place]
        first = np.repeat(begin[place] - (np.cumsum(count) - count), count)
        return flat[first + np.arange(len(first))], count

    def _rare(self, word: str) -> array:
        found = self.rare.get(word)
        if found is None:
            found = array("H", merge(word.encode(), self.ranks))
            if len(self.rare) >= REMEMBERED:
                self.rare.clear()
            if len(word) <= 64:
                self.rare[word] = found
        return found

    def text(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Decimal ids joined by commas, of each run of ids."""
        return [t[:-1] for t in _joined(self.names, ids, ends)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids: their pieces, one after the other."""
        return _joined(self.pieces, ids, ends)


def _joined(table: pa.Array, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    found = table.take(pa.array(ids))
    if not len(found):
        return [b""] * len(ends)
    offsets = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    data = memoryview(found.buffers()[2])
    cuts = offsets[np.append(0, ends)].tolist()
    return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Rows of a batch by about STRIP words: the rows, their words, and where each row's words end."""
    lists = batch.column(1)
    ends = np.cumsum(np.asarray(lists.value_lengths(), np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + STRIP, "right")))
        yield batch.slice(start, stop - start), lists.slice(start, stop - start).flatten(), ends[start:stop] - before
        start = stop


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, words: int = FREQUENT_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, then decoded from the ids.

    Spark splits the texts and folds the merges over the frequent distinct words; tasks look these up, merge the
    rare rest themselves, and join ids and pieces. Rows are treated as by `encode`, which does all in expressions.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.of(ranks)
    split = java_pattern(spark, pattern)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tokens, frequent = token_words(ranks), frequent_table(rows, split, vocabulary, words)
    lists = frequent["ids"].combine_chunks()
    names = pa.concat_arrays([pa.array(list(tokens), pa.string()), *frequent["word"].chunks])
    sizes = np.concatenate([np.ones(len(tokens), np.int64), np.asarray(lists.value_lengths(), np.int64)])
    flat = np.concatenate([np.fromiter((r for [r] in tokens.values()), np.int64, len(tokens)), np.asarray(lists.flatten(), np.int64)])
    # at most `words` words of up to 64 bytes and the tokens, ranks of 16 bits; the dict is the worker's own
    shared = spark.sparkContext.broadcast((ranks, names, sizes.astype(np.uint8), flat.astype(np.uint16), {}))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *known, kept = shared.value
        encoder = kept.get("encoder") or kept.setdefault("encoder", Encoder(*known))
        sha = lambda texts: pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
        for batch in batches:
            for part, found, word_ends in _runs(batch):
                ids, count = encoder.ids(found)
                ends = np.append(0, np.cumsum(count))[word_ends]
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(ends, prepend=0)), sha(encoder.text(ids, ends)), sha(encoder.decode(ids, ends))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = rows.select("doc_id", F.regexp_extract_all("text", F.lit(split), F.lit(0)).alias("words"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

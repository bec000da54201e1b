"""Token counts and byte-level BPE against the tokenizers' own libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from grainledger.llm import byte_bpe, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.load_pieces(MODEL))


def random_texts(n, alphabet, most, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def test_counts_equal_the_library(counter, library):
    texts = random_texts(3000, "abcdethion  rns.,\n\t▁é日本語漢😀　<s>/0A'\x00", 40)
    pieces = [p.replace("▁", " ") for p in counter.machine.pieces]
    texts += ["".join(t) for t in random_texts(3000, pieces, 7)] + ["", " ", "a" * 50_000, " " * 3000, "<s></s><unk><0x0A>"]
    assert [counter.count(t) for t in texts] == [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("size", [1, 5, 17])
def test_chunk_maps_compose(counter, library, monkeypatch, size):
    monkeypatch.setattr(token_counts, "CHUNK", size)
    for text in random_texts(300, "abc  the é漢\n", 80, size):
        assert counter.count(text) == len(library.encode(text))


def test_pairs_apart_as_merging_says(counter):
    rnd, machine = random.Random(3), counter.machine
    whole = [p for p in machine.pieces if machine._whole(p)]
    for _ in range(5000):
        a, b = rnd.choice(whole), rnd.choice(whole)
        assert machine._apart(a, b) == (machine.merge(a + b) == [a, b])


def test_texts_read_together(library, counter):
    """Side by side they give what each gives alone, and what they begin alike is read once."""
    texts = random_texts(500, "abthe▁é😀\x00", 9) + ["a\x00", "a", "a\x00\x00", "a", "", "th" * 30, "th" * 30 + "e"]
    machine = counter.machine
    alone = [machine.run(machine.start, t)[1] for t in texts]
    machine.clear()
    assert machine.run_all(texts).tolist() == alone
    assert machine.run_all(texts[::-1]).tolist() == alone[::-1]
    alike = ["the" * 15 + c for c in "abcdefgh"]
    machine.clear()
    made = []
    move, machine._move = machine._move, lambda *x: made.append(x) or move(*x)
    try:
        assert len(machine.run_all(alike)) == 8 and len(made) <= 45 + 8
    finally:
        del machine._move
    assert [counter.count(t) for t in alike] == [len(library.encode(t)) for t in alike]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 50)
    monkeypatch.setattr(token_counts, "WORDS", 20)
    small = token_counts.Counter(token_counts.load_pieces(MODEL))
    for text in random_texts(200, "abcdethion  rns.,é", 90):
        assert small.count(text) == len(library.encode(text))


def test_counts_of_documents(spark, awkward, no_docs, library):
    pieces = token_counts.load_pieces(MODEL)
    rows = token_counts.token_counts(awkward, pieces, limit=50).collect()
    key = lambda r: (r[0] or -1, r[1])
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in awkward.collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 50) for r in rows)
    assert token_counts.token_counts(no_docs, pieces).count() == 0


def test_perfect_hash():
    import numpy as np

    rng = np.random.default_rng(1)
    first, second = rng.integers(0, 64, 200), rng.integers(0, 512, 200)
    first[7], second[7] = first[3], second[3]
    shift, place = byte_bpe.displace(first, second, 64, 512)
    assert (place == -1).sum() == 1 and len(set(place.tolist())) == 200
    used = place >= 0
    assert ((second + shift[first]) % 512 == place)[used].all()


@pytest.mark.parametrize("words", [1000, 0])
def test_byte_bpe_equals_the_library(spark, awkward, no_docs, words, monkeypatch):
    ranks = byte_bpe.load_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = random_texts(400, "abcdethion  rns.,\n\té日本語漢😀　'sll1२\u0085 \U00033400ࡰ", 40)
    texts += ["a" * 300, "don't we'll I'VE", "   x  \n\n y ", "<|endoftext|>", "\x00\x1c\x1f "]
    extra = spark.createDataFrame([(100 + i, t, "", 0) for i, t in enumerate(texts)], awkward.schema)
    docs = awkward.union(extra)
    monkeypatch.setattr(byte_bpe, "FREQUENT_WORDS", words)
    vocabulary = byte_bpe.Vocabulary.of(ranks)
    encoded = byte_bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, words)
    key = lambda r: (r[0] or -1, repr(r[1]))
    rows = byte_bpe.decode(encoded, vocabulary).collect()
    want = [(r.doc_id, own.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in rows), key=key) == sorted(want, key=key)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    sha = lambda b: hashlib.sha256(b).hexdigest()
    digests = [(i, len(ids), sha(",".join(map(str, ids)).encode()), sha(t)) for i, ids, t in want]
    assert sorted(map(tuple, byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, words).collect()), key=repr) == sorted(digests, key=repr)
    assert byte_bpe.round_trip(no_docs, ranks, public_tokenizers.PATTERN).count() == 0


def test_frequent_words_are_those_of_all_documents(spark):
    """The word of most texts, whatever their hashes: a share of texts taken by hash would show the other one more often."""
    docs = spark.range(160_000).selectExpr("CAST(id AS STRING) AS tail")
    docs = docs.selectExpr("concat('qqzzx ', tail) AS some", "concat('zzqqx ', tail) AS rest")
    docs = docs.selectExpr("IF(pmod(xxhash64(some), 2) = 0 AND pmod(xxhash64(some), 3) = 0, some, rest) AS text")
    docs = docs.where("text LIKE 'qq%' OR pmod(xxhash64(text), 2) = 1")
    vocabulary = byte_bpe.Vocabulary.of(byte_bpe.load_ranks(RANKS))
    split = byte_bpe.java_pattern(spark, public_tokenizers.PATTERN)
    assert list(byte_bpe.frequent_words(docs, split, vocabulary, 1)) == ["zzqqx"]


def test_frequent_words_stay_in_arrow(spark, monkeypatch):
    ranks = byte_bpe.load_ranks(RANKS)
    monkeypatch.setattr(byte_bpe, "frequent_words", None)  # the driver makes no Python lists of them
    docs = spark.createDataFrame([(1, "zzqqx zzqqx qqzzv, the"), (2, "zzqqx")], "doc_id long, text string")
    encoding = tiktoken.Encoding("one", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for words in (0, 1, 100):
        rows = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, words).collect()
        want = {r.doc_id: encoding.encode_ordinary(r.text) for r in docs.collect()}
        assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in rows} == {
            k: (len(v), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for k, v in want.items()
        }


def test_frequent_words_are_not_handed_back(spark, monkeypatch):
    """They come to the driver once, with their ids, and are not made into a local frame there."""
    docs = spark.createDataFrame([(1, "zzqqx zzqqx qqzzv, the"), (2, "zzqqx")], "doc_id long, text string")
    vocabulary = byte_bpe.Vocabulary.of(byte_bpe.load_ranks(RANKS))
    split = byte_bpe.java_pattern(spark, public_tokenizers.PATTERN)
    local, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: local.append(data) or make(self, data, *a, **b))
    found = byte_bpe.frequent_table(docs, split, vocabulary, 1)
    assert found["word"].to_pylist() == ["zzqqx"]
    given = [t["word"].to_pylist() for t in local if "word" in t.column_names]
    assert given and all("zzqqx" not in w and " zzqqx" not in w for w in given)


def test_long_words_merge_alike(monkeypatch):
    ranks = byte_bpe.load_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for text in random_texts(300, "aabbcdethion é漢", 200, 4) + ["a" * 5000, "ab" * 999, "é" * 700]:
        if text:
            assert byte_bpe.merge(text.encode(), ranks) == own.encode_ordinary(text) == byte_bpe._merge_long(text.encode(), ranks)


def test_digests(spark):
    ranks = byte_bpe.load_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    row = byte_bpe.round_trip(spark.createDataFrame([(1, "some text, é")], "doc_id long, text string"), ranks, public_tokenizers.PATTERN).first()
    ids = own.encode_ordinary("some text, é")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert tuple(row) == (1, len(ids), sha(",".join(map(str, ids)).encode()), sha("some text, é".encode()))

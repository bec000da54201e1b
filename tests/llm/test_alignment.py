"""Cross-tokenizer alignment against the tokenizers' libraries and a plain alignment of byte ranges."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from grainledger.llm import alignment
from grainledger.llm.queries import QUERIES

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies.load(*FILES)


@pytest.fixture(scope="module")
def tokenizers(vocabularies):
    return alignment.Tokenizers(vocabularies.first, vocabularies.second, vocabularies.moving)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def brute(libraries, texts):
    """Numbers of every text, by listing all links of all texts."""
    first, second = libraries
    alphabet = alignment.byte_alphabet()
    linked, rows = [], []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False) if text else None
        a_ids, b_ids = (a.ids, second.encode(text)) if text else ([], [])
        a_bytes = [bytes(alphabet[c] for c in first.id_to_token(i)) for i in a_ids]
        names = [second.id_to_piece(i) for i in b_ids]
        b_bytes = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, names)]
        if not text or {b"".join(a_bytes), b"".join(b_bytes)} != {b" " + text.encode()}:
            rows.append((0, 0, []))
            linked.append(Counter())
            continue
        ends = [set(accumulate(map(len, side))) for side in (a_bytes, b_bytes)]
        shared = sorted(ends[0] & ends[1])
        groups, at = [], [0, 0, 0, 0]
        for end in shared:
            group = []
            for s, (ids, parts) in enumerate(((a_ids, a_bytes), (b_ids, b_bytes))):
                start = at[s]
                while at[2 + s] < end:
                    at[2 + s] += len(parts[at[s]])
                    at[s] += 1
                group.append(ids[start : at[s]])
            groups.append(group)
        rows.append((len(a_ids), len(b_ids), groups))
        linked.append(Counter((x, y) for a, b in groups for x in a for y in b))
    counts = Counter(pair for found in linked for pair in found)
    top = Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = []
    for (n_a, n_b, groups), found in zip(rows, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(n for pair, n in found.items() if counts[pair] == top[pair[0]])
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((n_a, n_b, len(groups), sum(found.values()), best, sum(n * counts[p] for p, n in found.items()), digest))
    return out


def odd_texts(n=400):
    rnd = random.Random(5)
    stock = ["the", " ", "  ", "\n", "\t", "é", "日本", "😀", "👩‍👩‍👧", "Ünï", "123", "<s>", "<|endoftext|>", "<0x41>", "▁", "'s", "...", "ing", "\x1c", "\x85", " ", " ", "𞤀", "\U0001fae8", "ꟑ", "x" * 30]
    return ["".join(rnd.choice(stock) for _ in range(rnd.randint(1, 25))) for _ in range(n)]


def test_first_ids_equal_the_library(tokenizers, libraries):
    texts = odd_texts(1500) + ["a" * 30_000, " " * 30_000, "\n" * 5_000 + "x"]
    found, _ = tokenizers.ids([t.replace("▁", "") or "x" for t in texts])
    for text, ids in zip(texts, found):
        text = text.replace("▁", "") or "x"
        assert ids.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids


def test_same_as_brute_force(spark, vocabularies, libraries, monkeypatch):
    texts = odd_texts() + ["a ▁ b", "", "word " * 500]
    want = brute(libraries, texts)
    monkeypatch.setattr(alignment, "STRIP_BYTES", 700)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in NUMBERS) for r in alignment.alignment_counts(docs, vocabularies).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert 0 < sum(w[0] == 0 for w in want) < len(want) / 2  # some are not spelt out


def test_query_on_whole_texts(spark, sf_dir, libraries):
    rows = {r.doc_id: r for r in QUERIES["op12_token_alignment"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute(libraries, [d.text or "" for d in docs])
    assert len(rows) == len(docs)
    assert [tuple(rows[d.doc_id][c] for c in NUMBERS) for d in docs] == want


def test_groups_are_read_back(spark, vocabularies, libraries):
    docs = spark.createDataFrame([(1, "Unbelievable weather, isn't it?"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.alignments(docs, vocabularies).collect()}
    ids = [[int(i) for g in found[1].groups.split(";") for i in g.split("|")[s].split(",")] for s in (0, 1)]
    assert ids[0] == libraries[0].encode(" Unbelievable weather, isn't it?", add_special_tokens=False).ids
    assert ids[1] == libraries[1].encode("Unbelievable weather, isn't it?")
    assert (found[2].n_a, found[2].groups) == (0, "")


def test_equal_hashes_do_no_harm(vocabularies, tokenizers, monkeypatch):
    texts = ["one two three one two", "four five six"]
    want = alignment.Aligner(tokenizers).align(texts)
    monkeypatch.setattr(alignment, "span_hashes", lambda data, starts, ends: (ends * 0).astype("uint64"))
    got = alignment.Aligner(tokenizers).align(texts)
    assert got.texts == want.texts and got.pairs.tolist() == want.pairs.tolist()


def test_equal_windows_are_aligned_once(tokenizers, monkeypatch):
    aligner, seen = alignment.Aligner(tokenizers), []
    monkeypatch.setattr(alignment.Aligner, "windows", lambda self, ids, cuts, of=alignment.Aligner.windows: seen.append(len(cuts[0])) or of(self, ids, cuts))
    found = aligner.align(["more words and more words"] * 50 + ["more and more"])
    assert seen == [3 + 0] and found.n_groups.tolist() == [5] * 50 + [3]


def test_large_groups(tokenizers, libraries, monkeypatch):
    texts = ["🧑🏽 " * 3 + "x" * 400, "the 日本語 end"]
    whole = alignment.Aligner(tokenizers).align(texts)
    monkeypatch.setattr(alignment, "PAIRED", 0)
    counted = alignment.Aligner(tokenizers).align(texts)
    key = lambda f: sorted(zip(f.pairs.tolist(), f.times.tolist()))
    assert key(whole) == key(counted) and whole.n_links.tolist() == counted.n_links.tolist() == [b[3] for b in brute(libraries, texts)]


def test_awkward_rows(spark, vocabularies, libraries, awkward, no_docs):
    rows = awkward.select("doc_id", "text").collect()
    got = alignment.alignment_counts(awkward, vocabularies).collect()
    want = brute(libraries, [r.text or "" for r in rows])
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(((r.doc_id, *(r[c] for c in NUMBERS)) for r in got), key=key) == sorted(((r.doc_id, *w) for r, w in zip(rows, want)), key=key)
    assert alignment.alignment_counts(no_docs, vocabularies).collect() == [] == alignment.alignments(no_docs, vocabularies).collect()

"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from grainledger.llm import spelling
from grainledger.llm.queries import QUERIES

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    rows = {}
    for w in n:
        near = [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, []) if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 5 * n[w] else None
        rows[w] = (n[w], len(near), form, n[form] if form else None)
    out = []
    for w, row in rows.items():
        root = w
        while rows[root][2]:
            root = rows[root][2]
        out.append((w, *row, root))
    return sorted(out)


def variants(seed, n, words=120):
    """Texts of words and their misspellings, some of which are misspelt again."""
    rnd = random.Random(seed)
    stock = ["".join(rnd.choice("abeinrstéÉÿ÷×") for _ in range(rnd.randint(5, 11))) for _ in range(words)]
    def slip(w):
        i = rnd.randrange(len(w))
        return rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice("abé") + w[i:], w[:i] + rnd.choice("xyz") + w[i + 1 :]])
    stock += [slip(w) for w in stock for _ in range(2)]
    stock += [slip(w) for w in stock[words:]]
    weight = [1 / (i + 1) for i in range(len(stock))]
    texts = [" ".join(w.upper() if rnd.random() < 0.1 else w for w in rnd.choices(stock, weight, k=300)) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [40, 16_384])
def test_same_as_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    docs = variants(1, 60) + [(900 + i, f"{'a' * 700} {'a' * 699}b {'a' * 701}") for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    near = spelling.near_words(spelling.word_counts(df), tile).collect()
    want = brute(docs)
    assert sorted((r.word, r.n, r.n_near) for r in near) == sorted(w[:3] for w in want)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in spelling.spelling_variants(df).collect()) == want
    assert any(w[5] != (w[3] or w[0]) for w in want)  # some chains have two steps


def test_query_on_whole_texts(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_spelling_variants"](spark, sf_dir).collect())
    assert got == brute(docs)


def test_counted_pairs_equal_all_pairs():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 8))) for _ in range(900)}, key=lambda w: (len(w), w))
    arrow = pa.array(words)
    counts = spelling.letter_counts(arrow)
    order = sorted(range(len(words)), key=lambda i: (len(words[i]), counts[i].tobytes()))
    words = [words[i] for i in order]
    p, q = spelling.near_pairs(pa.array(words), counts[order])
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and one_edit(a, b)}
    assert len(p) == len(set(zip(p.tolist(), q.tolist()))) and set(zip(p.tolist(), q.tolist())) == want
    p, q = spelling.near_pairs(pa.array(words), counts[order], 333)
    assert set(zip(p.tolist(), q.tolist())) == {(i, j) for i, j in want if i < 333 <= j}
    assert np.array_equal(spelling.letter_counts(pa.array(["zéz"]))[0].nonzero()[0], [25, 26 + 0xE9 % 6])


def test_awkward_rows(spark, awkward, no_docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in spelling.spelling_variants(awkward).collect())
    assert got == brute(rows) and got
    assert spelling.spelling_variants(no_docs).collect() == []

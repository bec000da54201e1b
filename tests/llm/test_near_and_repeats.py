"""SimHash near-duplicates, components, and substring dedup against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from grainledger.llm import graph, simhash, storage, substrings


def slow_fingerprint(text):
    found = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([b" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(pairs, most=3):
    fps = sorted({f for _, f in pairs})
    label = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= most:
                    label[a] = label[b] = min(label[a], label[b])
    first = {}
    for i, f in pairs:
        if i is not None:
            first[label[f]] = min(i, first.get(label[f], i))
    return sorted(((i, f"{f:016x}", first.get(label[f])) for i, f in pairs), key=repr)


def found(df):
    return sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in df.collect()), key=repr)


def test_components_of_awkward_documents(awkward, no_docs):
    pairs = [(r.doc_id, slow_fingerprint(r.text)) for r in awkward.collect()]
    assert found(simhash.near_duplicates(awkward)) == slow_components(pairs)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(awkward)
    # empty texts (2, 3, 4 and a null id) are one group, as are both rows with id 1
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.select("doc_id", "text").collect() if r.doc_id != 5) == sorted(
        [(1, "a b"), (2, ""), (-1, "lost id"), (6, "é 漢字 😀"), (6, "other text")]
    )
    assert kept.columns == awkward.columns


@pytest.mark.parametrize("group", [4096, 8])
@pytest.mark.parametrize("most", [3, 2, 1])
def test_links_connect_all_close_fingerprints(spark, monkeypatch, group, most):
    monkeypatch.setattr(simhash, "GROUP", group)  # 8: most anchors go by neighbouring values
    rng = np.random.default_rng(group + most)
    fps = []
    for base in rng.integers(0, 2**63, 12).tolist():
        for _ in range(8):
            fps.append(base)
            for bit in rng.integers(0, 64, int(rng.integers(1, 4))).tolist():
                base ^= 1 << bit
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(f,) for f in set(signed)], "fp long")
    links = simhash.links(rows, most).where("b IS NOT NULL")
    root = {r.node: r.root for r in graph.components(links).collect()}
    groups = {}
    for f in set(signed):
        groups.setdefault(root.get(f, f), set()).add(f % 2**64)
    label = {h: c for _, h, c in slow_components([(i, f % 2**64) for i, f in enumerate(sorted(set(signed)))], most)}
    want = {}
    for h, c in label.items():
        want.setdefault(c, set()).add(int(h, 16))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7), (None, 3)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 300: 100, **{1000 + i: 1000 for i in range(1, 50)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch, prose):
    text = prose(3, 500).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE_BYTES", 64)
    assert simhash.fingerprint(text) == whole == slow_fingerprint(text.decode())


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(b"some bytes that are longer than the window of 32 bytes", np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = (2 * h + int(substrings.GEAR[b])) % 2**32
        want.append(h)
    assert substrings.gear(data)[31:].tolist() == want[31:]


def test_planted_passages(spark, prose):
    passages = [prose(900 + i, 51 + i % 40) for i in range(30)]
    shorter = [prose(700 + i, 30) for i in range(10)]
    docs, planted, clean = [], {}, set()
    for i in range(240):
        a, b = prose(2 * i, 20 + i % 150), prose(2 * i + 1, 20 + i % 90)
        if i % 3 == 0:
            docs.append((i, f"{a} {passages[i // 3 % 30]} {b}"))
            planted[i] = i // 3 % 30
        else:
            docs.append((i, f"{a} {shorter[i % 10]} {b}" if i % 3 == 1 else f"{a} {b}"))
            clean.add(i)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    rows = substrings.repeated_passages(df).collect()
    assert {r.doc_id for r in rows} == set(planted)
    text = dict(docs)
    for r in rows:
        own = text[r.doc_id].encode()[r.start : r.end]
        size = r.end - r.start
        assert own.strip() == text[r.kept_doc_id].encode()[r.kept_start : r.kept_start + size].strip()
        assert len(own.split()) == r.n_words >= 50 and passages[planted[r.doc_id]] in own.decode()
        assert r.kept == (r.doc_id == r.kept_doc_id)
    after = {r.doc_id: r.text for r in substrings.drop_repeats(df).collect()}
    assert all(after[i] == text[i] for i in clean)
    assert sorted(k for i, k in planted.items() if passages[k] in after[i]) == sorted(set(planted.values()))


def test_repeats_in_awkward_documents(spark, awkward, no_docs, prose):
    assert substrings.repeated_passages(no_docs).count() == 0
    assert substrings.drop_repeats(no_docs).count() == 0
    copy = spark.createDataFrame([(50, prose(1, 60_000), "c", 1), (None, prose(1, 100), "n", 2), (60, "x" * 9000, "", 0), (61, "x" * 9000, "", 0)], awkward.schema)
    both = awkward.union(copy)
    rows = substrings.repeated_passages(both).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in rows} == {(5, 5), (50, 5), (5, None), (50, None), (None, None)}
    out = substrings.drop_repeats(both)
    assert out.columns == both.columns and out.count() == both.count()
    left = {r.doc_id: r.text for r in out.where("doc_id IN (5, 50, 60)").collect()}
    assert len((left[5] or "").split()) >= 59_000 and not left[50].split() and left[60] == "x" * 9000


def test_copy_whose_parts_stand_in_earlier_documents(spark, prose):
    docs, pairs = [], []
    for k in range(20):
        parts = [prose(3000 + 10 * k + i, 40, 4000) for i in range(3 if k % 2 else 2)]
        at = 100 * k
        docs += [(at + i, f"{prose(at + i, 60, 4000)} {p} {prose(at + i + 50, 60, 4000)}") for i, p in enumerate(parts)]
        docs += [(at + i, f"{prose(at + i, 30, 4000)} {' '.join(parts)} {prose(at + i + 50, 30, 4000)}") for i in (10, 20, 30)]
        pairs.append((at, " ".join(parts)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows, text = substrings.repeated_passages(df).collect(), dict(docs)
    spans = {(r.doc_id, r.kept_doc_id, text[r.doc_id].encode()[r.start : r.end].decode()) for r in rows}
    for at, whole in pairs:
        for i in (20, 30):
            assert any(whole in t for d, first, t in spans if (d, first) == (at + i, at + 10))
        assert not any(d in (at, at + 1, at + 2) for d, _, _ in spans)
    after = {r.doc_id: r.text for r in substrings.drop_repeats(df).collect()}
    assert all(whole in after[at + 10] and whole[100:200] not in after[at + 20] + after[at + 30] for at, whole in pairs)


def test_texts_that_share_an_id_keep_what_they_alone_have(spark, prose):
    a, b, c = prose(1, 120), prose(2, 90), prose(3, 220)
    rows = [(1, a), (5, f"{b} {a}"), (5, c), (None, f"{prose(4, 80)} {a}"), (None, prose(5, 300)), (7, prose(6, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sorted((r.text for r in substrings.drop_repeats(df).collect()), key=len)
    kept = {t for _, t in rows} - {rows[1][1], rows[3][1]}
    assert kept < set(out) and len(out) == len(rows)
    cut = [t for t in out if t not in kept]
    assert all(a not in t for t in cut) and sorted(len(t.split()) for t in cut) == [80, 90]


def test_passages_read_texts_in_small_batches(spark, prose, monkeypatch):
    """Tasks that are handed whole texts get few of them at once."""
    handed, settle = {}, substrings.settle

    def note(df, name, batch=None):
        handed[name] = batch
        return settle(df, name, batch)

    monkeypatch.setattr(substrings, "settle", note)
    docs = spark.createDataFrame([(i, prose(i, 30) + " " + prose(99, 80)) for i in range(4)], "doc_id long, text string")
    assert substrings.repeated_passages(docs).where("NOT kept").count() == 3
    assert (handed["repeated"], handed["contexts"]) == (storage.TEXTS, storage.TEXTS)


def test_batches_hold_for_what_runs_inside(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    most = lambda: spark.range(0, 5_000, 1, 1).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
    with storage.batches(spark, 700):
        assert most() == 700
    assert most() == 5_000

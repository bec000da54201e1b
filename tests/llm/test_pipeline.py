"""The corpus pipeline against a brute-force version of each stage."""

import hashlib

import public_tokenizers
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline
from grainledger.llm import byte_bpe, quality, simhash, substrings

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark_leaks", "byte_bpe"]
    (_, good), (_, one), (_, cut), (_, clean), (_, last) = corpus_pipeline.STAGES
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = good(spark, docs, SF)
    scores = {r.doc_id: r.predicted for r in quality.quality_scores(docs, labels).collect()}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and ids == {i for i, p in scores.items() if p}

    single = one(spark, kept, SF)
    fps = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in kept.collect()}
    label = dict(zip(fps, fps))
    for a in sorted(fps):
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                label[a] = label[b] = min(label[a], label[b])
    for _ in range(5):
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    first = {}
    for i in sorted(fps):
        first.setdefault(label[i], i)
    assert single.columns == docs.columns and {r.doc_id for r in single.select("doc_id").collect()} == set(first.values())

    less = cut(spark, single, SF)
    gone = {}
    for r in substrings.repeated_passages(single).where("NOT kept").collect():
        gone.setdefault(r.doc_id, []).append((r.start, r.end))
    texts = {r.doc_id: r.text for r in single.collect()}
    for r in less.collect():
        data = bytearray(texts[r.doc_id].encode())
        for a, b in sorted(gone.get(r.doc_id, []), reverse=True):
            for i in range(a, b):
                data[i] = 0
        assert r.text.encode() == bytes(data).replace(b"\0", b"") and r.n_chars == len(r.text)

    rest = clean(spark, less, SF)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in less.collect() if any(i in " ".join(r.text.lower().split()) for i in items)}
    left = {r.doc_id for r in rest.select("doc_id").collect()}
    assert not left & holds and len(left | holds) >= 0.99 * less.count()

    out = {r.doc_id: r for r in last(spark, rest, SF).collect()}
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in rest.collect():
        ids = own.encode_ordinary(r.text)
        assert tuple(out[r.doc_id]) == (r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(r.text.encode()))

    whole = entry_points.queries()["pipeline"](spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, out.values()))


def test_stages_take_awkward_documents(spark, awkward, no_docs):
    for docs in (awkward, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "byte_bpe" or out.columns == docs.columns
            assert out.count() <= docs.count()


def test_every_operator_has_its_query():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names

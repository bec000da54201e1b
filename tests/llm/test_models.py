"""Language-model scores, quality, toxicity and leaks: brute force and held-out accuracy."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from grainledger.llm import decontam, linear, lm_score, quality, queries, toxicity


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_losses(target, texts):
    """[(words, target loss, background loss)] of texts, from counts of words in dictionaries."""

    def split(text):
        return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())

    def counts(some):
        single, first, pair = Counter(), Counter(), Counter()
        for own in map(split, some):
            single.update(own)
            first.update(["<s>", *own][: len(own)])
            pair.update(zip(["<s>", *own], own))
        return single, first, pair

    models = counts(target), counts(texts)
    vocabulary = len(set(models[0][0]) | set(models[1][0]))

    def loss(model, own):
        single, first, pair = model
        size = sum(single.values()) + vocabulary
        return sum(-math.log((pair[v, w] + 32 * (single[w] + 1) / size) / (first[v] + 32)) for v, w in zip(["<s>", *own], own)) / max(len(own), 1)

    return [(len(own), *(loss(m, own) for m in models)) for own in map(split, texts)]


@pytest.mark.parametrize("pairs", [1 << 17, 1000])
def test_losses_of_a_bucket_in_parts(monkeypatch, pairs):
    """The same sums, and working arrays that do not grow with the bucket."""
    rng = np.random.default_rng(1)
    size = 400_000
    columns = [rng.integers(-30_000, 0, size), rng.integers(-30_000, 3, size), rng.integers(0, 200, size), rng.integers(1, 3, size)]
    model = lm_score.Model(np.zeros(0, np.int64), np.zeros((2, 3)), np.ones((2, 3)), np.full((2, 1), 1e6), np.zeros(0, np.int64), np.zeros((2, 0)), 1)
    rows = pa.Table.from_batches([lm_score._rows(np.zeros(1), 7, False, [*columns, None, None], np.array([0, size]))])

    def sums(most):
        monkeypatch.setattr(lm_score, "PART_PAIRS", most)
        tracemalloc.start()
        (out,) = lm_score._bucket_losses(model, rows)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return np.array([pc.list_flatten(out.column(i)) for i in (5, 6)]), peak

    (whole, large), (parts, small) = sums(10 * size), sums(pairs)
    assert np.allclose(whole, parts, rtol=1e-9)
    assert small < 0.75 * large


@pytest.mark.parametrize("common, bucket, ids", [(lm_score.COMMON, lm_score.BUCKET_WORDS, lm_score.BROADCAST_IDS), (2.0, 100, 0), (0.02, 37, 3)])
def test_language_models_equal_brute_force(spark, awkward, no_docs, prose, monkeypatch, common, bucket, ids):
    """Whichever words and pairs are common, with one bucket or many, with the target's ids joined either way."""
    for name, value in (("COMMON", common), ("BUCKET_WORDS", bucket), ("BROADCAST_IDS", ids), ("STRIP_BYTES", 3000), ("ROW_PAIRS", 50)):
        monkeypatch.setattr(lm_score, name, value)
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame([(i, prose(i, 40, 60)) for i in range(20, 40)], "doc_id long, text string"))
    target = spark.range(20, 25).selectExpr("id AS doc_id")
    texts = [(r.doc_id, r.text) for r in docs.collect()]

    def check(own, marks):
        plain = plain_losses([t for i, t in texts if i in marks], [t for _, t in texts])
        want = sorted((-1 if i is None else i, n, round(t, 6), round(b, 6)) for (i, _), (n, t, b) in zip(texts, plain))
        got = lm_score.cross_entropy_difference(own).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, round(r.target_loss, 6), round(r.background_loss, 6)) for r in got) == want
        assert all(abs(r.difference - (r.target_loss - r.background_loss)) < 1e-12 for r in got)

    check(lm_score.marked(docs, target.union(target)), range(20, 25))
    check(docs.withColumn("target", F.lit(None).cast("boolean")), [])
    assert lm_score.cross_entropy_difference(lm_score.marked(no_docs, target)).count() == 0


def test_repeated_strips_keep_their_rows(spark, prose):
    """Whole strips that are equal: every row has its line, and counts."""
    rows = [(i % 3, prose(i % 3, 20, 30)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("target", F.col("doc_id") == 0)
    plain = plain_losses([t for i, t in rows if i == 0], [t for _, t in rows])
    want = sorted((i, n, round(t, 6), round(b, 6)) for (i, _), (n, t, b) in zip(rows, plain))
    for size in (1, 1 << 22):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lm_score, "STRIP_BYTES", size)
            got = lm_score.cross_entropy_difference(docs).collect()
        assert sorted((r.doc_id, r.n_words, round(r.target_loss, 6), round(r.background_loss, 6)) for r in got) == want


@pytest.mark.parametrize("rows", [1, 7, 40])
def test_strips_do_not_depend_on_batches(prose, rows):
    """Small batches make no smaller strips, and keep every row in its place."""
    texts = [None if i % 9 == 4 else prose(i, 400 if i == 20 else i) for i in range(40)]
    table = pa.table({"n": list(range(40)), "text": pa.array(texts, pa.string())})
    none = pa.RecordBatch.from_pylist([], schema=table.schema)
    parts = list(lm_score.strips(iter([none, *table.to_batches(max_chunksize=rows), none]), 300))
    assert [n for part in parts for n in part["n"].to_pylist()] == list(range(40))
    size = [sum(len((t or "").encode()) for t in part["text"].to_pylist()) for part in parts]
    assert all(n <= 300 or part.num_rows == 1 for n, part in zip(size, parts))
    whole = list(lm_score.strips(iter(table.combine_chunks().to_batches()), 300))
    assert [part["n"].to_pylist() for part in parts] == [part["n"].to_pylist() for part in whole]
    assert not list(lm_score.strips(iter([]), 300))


def test_language_models_take_few_wide_rows_at_once(spark, awkward, monkeypatch):
    """Every written step reads texts and packed pairs by small batches; the session's own number is back afterwards."""
    taken, real = {}, lm_score.settle

    def settle(df, name, batch=None):
        taken[name] = batch
        return real(df, name, batch)

    monkeypatch.setattr(lm_score, "settle", settle)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    lm_score.cross_entropy_difference(awkward.withColumn("target", F.col("doc_id") == 1)).collect()
    assert set(taken) == {"words", "losses"} and all(n and n <= 1000 for n in taken.values())
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_language_models_count_all_of_a_table(spark):
    """Exact on a whole table: nothing is folded, hashed together or left out."""
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = docs.select("doc_id", "text").collect()
    plain = plain_losses([r.text for r in rows if r.doc_id in good], [r.text for r in rows])
    want = sorted((r.doc_id, n, round(t, 6), round(b, 6)) for r, (n, t, b) in zip(rows, plain))
    got = queries.QUERIES["op2_lm_scoring"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_words, round(r.target_loss, 6), round(r.background_loss, 6)) for r in got) == want


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    known = [(rows[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in rows]
    held = [(r, y) for r, y in known if r.held_out]
    assert len(rows) == docs.count() and len(held) > 80
    assert sum(r.predicted == y for r, y in held) / len(held) >= 0.97
    flipped = labels.withColumn("quality", labels.quality * 0 + 1).where(quality.held_out(labels.doc_id)).union(
        labels.where(~quality.held_out(labels.doc_id)))
    again = {r.doc_id: r.score for r in quality.quality_scores(docs, flipped).collect()}
    assert all(again[i] == r.score for i, r in rows.items())  # held-out labels change nothing
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in rows.items() if r.predicted}


def test_quality_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, 0), (3, 1, 0), (None, 0, 0), (4, None, 0), (5, 0, 1), (6, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1 and not any(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in quality.quality_scores(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(no_docs, labels).count() == 0


def test_rows_are_held_once():
    """Columns keep their type, values are taken one row at a time: the driver holds a sample once."""
    columns = [np.arange(i % 5, 1000, dtype="<i4") for i in range(1000)]
    tracemalloc.start()
    rows = linear.Rows.of(columns, (1.0 / (c + 1) for c in columns))
    size, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows.columns.dtype == np.int32 and rows.values.dtype == float and rows.start[-1] == len(rows.values) == sum(map(len, columns))
    assert (rows.columns == np.concatenate(columns)).all() and np.array_equal(rows.values, 1.0 / (rows.columns + 1))
    assert peak < 1.3 * size < 1.3 * 13 * len(rows.values)
    assert len(linear.Rows.of([])) == 0 and linear.Rows.of([np.zeros(0, "<i4"), columns[0]]).values.sum() == 1000


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    x = [np.unique(rng.integers(0, 40, 6) + (40 if i % 2 else 0)) for i in range(200)]
    sign = np.where(np.arange(200) % 2, 1.0, -1.0)
    w, b = linear.hinge_by_dual_descent(linear.Rows.of(x), sign, np.ones(200), 80)
    assert (np.sign(linear.Rows.of(x).dot(w) + b) == sign).all()


def test_chain_feeds_earlier_categories(spark):
    rnd = random.Random(4)
    stock = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        a, b = rnd.random() < 0.2, rnd.random() < 0.2
        text = rnd.choices(stock, k=60) + ["badaxe"] * a + ["vilebus"] * b
        rnd.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, int(a), int(b), int(a and b)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, a int, b int, both int")
    rows = {r.doc_id: r for r in toxicity.toxicity_scores(df, known.where("doc_id < 600"), ["a", "b", "both"]).collect()}
    wrong = sum((rows[i].a_predicted, rows[i].b_predicted, rows[i].both_predicted) != y for i, *y in [(l[0], *l[1:]) for l in labels] if i >= 600 for y in [tuple(y)])
    assert len(rows) == 900 and wrong <= 6
    chain = toxicity.train(df, known, ["a", "b", "both"])
    assert (chain.links[2, :2] > 0.1).all() and not np.triu(chain.links).any()


def test_toxicity_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(awkward, labels, ["toxic"]).collect()
    assert len(rows) == awkward.count() and all(0 <= r.toxic <= 1 for r in rows)
    assert toxicity.toxicity_scores(awkward, labels.limit(0), ["toxic"]).count() == awkward.count()
    assert toxicity.toxicity_scores(no_docs, labels, ["toxic"]).count() == 0


def test_toxic_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    names = toxicity.by_language(docs, labels, ["de", "en", "es", "fr"])
    rows = {r.doc_id: r for r in toxicity.toxicity_scores(docs, names.where("doc_id % 3 <> 0"), names.columns[1:]).collect()}
    held = [(rows[r.doc_id].toxic_predicted, r.toxic) for r in labels.where("doc_id % 3 = 0").collect()]
    caught = [p for p, y in held if y]
    assert sum(caught) / len(caught) > 0.82 and sum(p for p, y in held if not y) / len(held) < 0.01


def slow_infix(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_infix_distance():
    rnd = random.Random(5)
    some = lambda n: bytes(rnd.choice(b"abc ") for _ in range(rnd.randint(0, n)))
    for _ in range(400):
        item, text = some(12), some(30)
        assert decontam.infix_distance(item, text) == slow_infix(item, text)


@pytest.mark.parametrize("share, least", [(0.0, 1.0), (0.05, 0.97), (0.1, 0.9)])
def test_recall_of_edited_items(spark, sf_dir, share, least):
    rnd = random.Random(6)
    bench = read(spark, "/root/testdata/sf0.01", "benchmark")
    items = [(r.item_id, r.text) for r in bench.collect()]
    base = [r.text for r in read(spark, sf_dir, "documents").limit(80).collect()]
    docs, truth = [], set()
    for k in range(400):
        item, text = items[k % len(items)]
        own = list(text)
        for _ in range(int(share * len(own))):
            at = rnd.randrange(len(own))
            own[at : at + rnd.choice([0, 1])] = rnd.choice(["x", "e", " ", ""])
        host = base[k % len(base)].split()
        at = rnd.randrange(len(host) + 1)
        docs.append((k, " ".join([*host[:at], "".join(own).upper() if k % 2 else "".join(own), *host[at:]])))
        truth.add((k, item))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    rows = decontam.leaks(df, bench).collect()
    assert len(truth & {(r.doc_id, r.item_id) for r in rows}) / len(truth) >= least
    text, normal = dict(docs), {i: decontam.normal(t).encode() for i, t in items}
    for r in rows[:60]:
        assert r.edits <= 0.15 * r.item_bytes and r.edits >= slow_infix(normal[r.item_id], decontam.normal(text[r.doc_id]).encode())


def test_leaks_in_awkward_rows(spark, awkward, no_docs, prose):
    items = spark.createDataFrame([(1, prose(1, 30)), (1, prose(1, 30)), (2, None), (3, ""), (None, "lost id"), (4, "!!"), (5, "lost   ID")], "item_id long, text string")
    rows = sorted(((r.doc_id, r.item_id) for r in decontam.leaks(awkward, items).collect()), key=repr)
    assert rows == [(5, 1), (None, 5)]
    left = decontam.drop_leaked(awkward, items)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 2
    assert decontam.leaks(no_docs, items).count() == 0 and decontam.leaks(awkward, items.limit(0)).count() == 0


def test_copies_with_wide_gaps_are_exact(spark, prose):
    items = [(i, prose(4000 + i, 20 + 10 * i, 4000)) for i in range(12)]
    gaps = ["  ", "\r\n", "\n    ", " \u00a0 ", "\u3000", "\u2003\t"]
    docs = [
        (100 * i + k, f"{prose(5000 + i, 30)}\n {gap.join(text.split())} \n{prose(6000 + i, 30)}")
        for i, text in items for k, gap in enumerate(gaps)
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.edits) for r in rows if r.item_id == r.doc_id // 100) == [(d, 0) for d, _ in docs]


def test_normal_text_is_the_same_rule_everywhere():
    texts = [" A\u00a0\u2003b\x1f c\u3000", "", "\n", "é  \u0085\u00c2\u2019 x ", "a", " ", "漢\u3000\u2028字", "b "]
    assert [decontam.normal(t) for t in texts] == [" ".join(t.lower().split()) for t in texts]
    data, offsets = decontam.squeezed(pa.array(texts))
    rows = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
    assert rows == [decontam.normal(t) for t in texts]


def at_the_limit(rnd, text):
    """A copy with exactly as many edits as are allowed, in its normal form."""
    most, own = int(0.15 * len(text.encode())), text
    while decontam.infix_distance(text.encode(), own.encode()) < most:
        x = list(own)
        at = rnd.randrange(1, len(x) - 1)
        x[at : at + rnd.choice([0, 1])] = rnd.choice(["q", "e", "z", "", "a"])
        x = decontam.normal("".join(x))
        own = x if decontam.infix_distance(text.encode(), x.encode()) <= most else own
    return own


def test_recall_at_the_limit_of_edits(spark):
    rnd = random.Random(11)
    bench = read(spark, "/root/testdata/sf0.01", "benchmark")
    items = [(r.item_id, decontam.normal(r.text)) for r in bench.collect()] * 8
    docs = [(k, f"so it went on {at_the_limit(rnd, t)} and then no more") for k, (_, t) in enumerate(items)]
    rows = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), bench).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert sum((k, i) in found for k, (i, _) in enumerate(items)) >= decontam.RECALL * len(items)


def test_copies_without_blanks_or_beside_other_signs(spark, prose):
    rnd = random.Random(12)
    signs = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    line = lambda n: "".join(rnd.choices(signs, k=n))
    items = [(i, line(30 + 5 * i)) for i in range(8)] + [(8, prose(1, 30)), (9, "ab cd"), (10, "7 c")]
    docs = [(i, f"{line(40)}{t}{line(40)}") for i, t in items] + [(20 + i, f"\u201c{t.replace(' ', '\u2014')}\u201d") for i, t in items[:8]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id % 20, r.edits) for r in rows if r.doc_id % 20 == r.item_id} == {(i, 0) for i, _ in items}
    assert {r.doc_id for r in rows if r.doc_id % 20 == r.item_id} == {i for i, _ in docs}


def test_quality_learns_from_labels_of_documents_at_hand(spark, prose):
    docs = [(i, prose(i, 60) if i % 2 else "zq 9# " * (20 + i % 7)) for i in range(300)]
    labels = [(i, i % 2) for i in range(300)] + [(i, i % 2) for i in range(10_000, 40_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = quality.quality_scores(df, spark.createDataFrame(labels, "doc_id long, quality int"), fit_rows=60).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in found) > 290

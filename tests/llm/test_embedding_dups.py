"""Embedding near-duplicates against brute force: links, classes, recall at the threshold, hot groups."""

import numpy as np
import pyarrow as pa
import pytest

from grainledger.llm import embedding_dups


def brute(rows, threshold):
    """[vec_id, n_links, component_id, kept] by all pairs of rows."""
    ok = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [(i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())) for i, v in ok]
    label = list(range(len(unit)))
    links = [0] * len(unit)
    for a in range(len(unit)):
        for b in range(a):
            if len(unit[a][1]) == len(unit[b][1]) and (unit[a][1] @ unit[b][1] >= threshold or np.array_equal(ok[a][1], ok[b][1])):
                links[a] += 1
                links[b] += 1
                x, y = label[a], label[b]
                label = [min(x, y) if z in (x, y) else z for z in label]
    least = {z: min(unit[k][0] for k in range(len(unit)) if label[k] == z) for z in set(label)}
    out = [(unit[k][0], links[k], least[label[k]], unit[k][0] == least[label[k]]) for k in range(len(unit))]
    left = list(rows)
    for i, v in ok:
        left.remove(next(r for r in left if r[0] == i and r[1] is not None and np.array_equal(np.asarray(r[1], object), v)))
    return sorted(out + [(i, 0, i, i is not None) for i, _ in left], key=repr)


def partner(rng, v, cosine):
    v = v / np.linalg.norm(v)
    other = rng.normal(size=len(v))
    other -= (other @ v) * v
    return (cosine * v + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)).tolist()


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    return sorted((tuple(r) for r in embedding_dups.near_duplicates(df, **options).collect()), key=repr)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        v = rng.normal(size=48) + 0.4  # a common direction, as embeddings have
        rows += [(2 * i, v.tolist()), (2 * i + 1, partner(rng, v, 0.9005 + 0.03 * (i % 2)))]
    got = run(spark, rows)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = (x @ x.T >= 0.9).sum(1) - 1
    found = np.array([n for _, n, _, _ in sorted(got)])
    assert (found <= true).all() and found.sum() >= 0.93 * true.sum() and true.sum() >= 3000


def test_hot_groups_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.05).tolist()) for i in range(300)]  # near copies: a third of all
    rows += [(1000 + i, rows[3][1]) for i in range(50)] + [(2000 + i, rng.normal(size=16).tolist()) for i in range(550)]
    want = brute(rows, 0.9)
    assert run(spark, rows) == want
    monkeypatch.setattr(embedding_dups, "CODES", 500)
    monkeypatch.setattr(embedding_dups, "COMPONENTS", 800)
    assert run(spark, rows, part=25) == want


def test_every_pair_meets_in_one_bucket():
    rng = np.random.default_rng(6)
    unit = embedding_dups.unit_rows(pa.array(rng.normal(size=(400, 8)).tolist()), 8)
    codes = embedding_dups.Codes.learn(unit, 400, 0.9, 0.97)
    words = codes.words(unit)
    apart = np.bitwise_count(words[:, None] ^ words[None])
    near = (apart <= embedding_dups.REACH).any(2) & (apart.sum(2, dtype=int) <= codes.reach)
    want = {(i, j) for i in range(400) for j in range(i) if near[i, j]}
    flips = np.append(np.uint32(0), np.uint32(1) << np.arange(codes.bits, dtype=np.uint32))
    listed = sorted((t, int(w ^ f), i) for i in range(400) for t, w in enumerate(words[i]) for f in flips)

    table = pa.table({
        "size": pa.array([8] * len(listed), pa.int32()), "tab": pa.array([x[0] for x in listed], pa.int32()),
        "word": pa.array([x[1] for x in listed], pa.int32()), "i": pa.array([0] * len(listed), pa.int32()),
        "j": pa.array([0] * len(listed), pa.int32()), "part": pa.array([0] * len(listed), pa.int32()),
        "node": [x[2] for x in listed], "code": [words[x[2]].tobytes() for x in listed],
    })
    node = np.asarray(table["node"])
    got = [(max(node[a], node[b]), min(node[a], node[b])) for p, q in embedding_dups._pairs(table, embedding_dups._starts(table), codes) for a, b in zip(p, q)]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("size", [1, 2, 5])
def test_short_vectors_and_chains(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(size=size).round(1).tolist()) for i in range(60)]
    want = brute(rows, 0.9)
    got = run(spark, rows, target=1.0)
    assert sum(g[1] for g in got) >= 0.95 * sum(w[1] for w in want)
    if size == 1:
        assert got == want


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1e300, 0.0]), (3, [1e-300, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]),
        (9, [float("inf"), 1.0]), (10, [1.0]), (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, None), (12, [-0.0, 1.0]), (13, [0.0, 1.0]),
        (1, [0.0, 1.0]), (14, [-1.0, 0.0]),
    ]
    assert run(spark, rows) == brute(rows, 0.9)
    clash = spark.createDataFrame([(1, [1.0, 0.0], 2, 3, 4), (2, [1.0, 0.1], 2, 3, 4)], "vec_id int, embedding array<float>, node int, size int, copies int")
    assert sorted(map(tuple, embedding_dups.near_duplicates(clash).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert embedding_dups.near_duplicates(clash.limit(0)).collect() == []
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_all_vectors_close_together(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=24)
    rows = [(i, (centre + rng.normal(size=24) * 0.33).tolist()) for i in range(1200)]
    got, x = run(spark, rows), np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = (x @ x.T >= 0.9).sum() - 1200
    assert true > 100_000 and 0.93 * true <= sum(g[1] for g in got) <= true

"""Chat formatting and exact top-k search against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from grainledger.llm import chat, topk

CHAT = "conv_id long, turn long, role string, text string"


def expected(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    chats = {}
    for r in rows:
        chats.setdefault(r[0], []).append(r)
    out = {}
    for conv, turns in chats.items():
        turns = [(t[2] or "", t[3] or "") for t in sorted(turns, key=key)]
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(whole), len(loss), sha(loss))
    return out


def test_turns_come_back_from_the_format(spark):
    rnd = random.Random(2)
    bits = [*chat.Template().marks, "\\", "\\\\", "<", "|", "é", "漢😀", "\n", " ok ", "<\\s>", "$1", ""]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))
    roles = ["user", "assistant", "system", "assistant", "<|end|>", None]
    rows = [(c, rnd.randint(0, 30), rnd.choice(roles), text() if rnd.random() > 0.1 else None) for c in range(25) for _ in range(rnd.randint(1, 12))]
    rows += [(None, 1, "user", "no id"), (90, None, "user", "no turn"), (90, 0, "user", "b"), (90, 0, "user", "a"), (90, 0, "user", "a")]
    rows += [(91, i, "assistant" if i % 3 else "user", f"t{i} [INST]") for i in range(700)]
    made = chat.format_chats(spark.createDataFrame(rows, CHAT).repartition(5))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_digests(made).collect()}
    assert got == expected(rows)


def test_neighbours_of_one_role_share_a_turn(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "</s>")]
    out = chat.format_chats(spark.createDataFrame(rows, CHAT)).first()
    assert out.formatted == "<|turn|>user<|text|>a<|next|>b<|next|>c<|end|><|turn|>assistant<|text|><\\/s><|end|>"
    assert out.n_merged == 2 and [out.formatted.encode()[s.start : s.start + s.length] for s in out.loss_spans] == [b"<\\/s>"]


def test_chat_plan_is_native_and_empty_input_is_empty(spark):
    df = chat.chat_digests(chat.format_chats(spark.createDataFrame([], CHAT + ", merged int, pieces int")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 0 and "Python" not in plan and "Arrow" not in plan


def test_overlapping_marks_are_refused():
    with pytest.raises(ValueError):
        chat.Template(close="<|turn")


def brute(rows, k, every):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in ok]
    out = []
    for at, (q, v) in enumerate(ints):
        if q % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, w)), c) for n, (c, w) in enumerate(ints) if n != at and len(w) == len(v)]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rnd = np.random.default_rng(1)
    rows = [(i, np.round(rnd.normal(size=6), 1).tolist()) for i in range(200)]
    rows += [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(400 + i, [0.5] * 6) for i in range(40)] + [(7, [9.0] * 6), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (-10, [1e5] * 6), (-20, [3e5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, 5, 10).collect()))
    assert got == brute(rows, 5, 10)
    assert topk.top_k(df.limit(0)).count() == 0
    monkeypatch.setattr(topk, "SHARD_BYTES", 48 * 9)
    assert sorted(map(tuple, topk.top_k(df, 5, 10).collect())) == got


def test_rows_that_share_an_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0]), (2, [0.0, 1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 4, 100)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 100)


def test_large_scores_are_exact():
    q = np.array([[2**30, 1]])
    shard = np.array([[2**30, 1], [2**30, 2], [2**30, 2], [1, 1]])
    scores = topk.products(q, shard)
    assert scores.tolist() == [[2**60 + 1, 2**60 + 2, 2**60 + 2, 2**30 + 1]]
    assert sorted(topk.best(scores, 2)[0].tolist()) == [1, 2]
    with pytest.raises(OverflowError):
        topk.products(np.array([[2**40]]), np.array([[2**40]]))

"""Chat windows and exact top-k: round trips and brute force."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import chat, topk

TURNS = "conv_id long, turn long, role string, text string, loss_chars int"
ODD = [
    (1, 0, "system", "be \\ # < kind"), (1, 1, "user", "</turn>\n### User:\nx"), (1, 2, "assistant", "\\h\\b\\l ### </turn>"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "w " * 900), (1, 6, "user", "q " * 300), (1, 7, "assistant", "é😀 " * 90),
    (2, None, None, "lost"), (2, 3, "assistant", "a"), (2, 3, "assistant", "a"), (None, 1, "odd:\n role", "text"),
    (3, 0, "system", "only"), (4, 1, "User", "case"), (4, 2, "system", "late"),
]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_chat(spark, rows, **sizes):
    given = spark.createDataFrame([(*r, 1) for r in rows], TURNS)
    formatted = chat.windows(given, **sizes)
    made = formatted.collect()
    back = defaultdict(list)
    for r in chat.read_turns(formatted).collect():
        back[r["conv_id"]].append((r["window"], r["turns"], r["targets"]))
    want = defaultdict(list)
    none_first = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=none_first):
        want[r[0]].append((r[2] or "", r[3] or ""))
    assert set(back) == set(want)
    for conv, turns in want.items():
        parts = sorted(back[conv], key=lambda p: p[0])
        assert [tuple(t) for p in parts for t in p[1]] == turns
        assert "".join(x for p in parts for x in p[2]) == "".join(t for role, t in turns if role == "assistant")
    return made, want


def test_chat_round_trip_and_masks(spark):
    made, want = check_chat(spark, ODD, budget=256, history=64)
    tokens = lambda role, text: len(text.split()) + chat.OVERHEAD
    for r in made:
        turns = want[r["conv_id"]]
        large = any(tokens(*t) > (256 - 64) // 2 for t in turns)
        if not large:
            assert r["tokens"] <= 256
        assert r["text"].count("</turn>") == r["context_turns"] + r["new_turns"]
        if turns[0][0] == "system":
            assert r["text"].startswith("### System:\n")


@pytest.mark.parametrize("budget,history", [(40, 8), (100_000, 10), (64, 1)])
def test_chat_budgets(spark, budget, history):
    check_chat(spark, ODD, budget=budget, history=history)


def test_chat_system_turn_is_within_the_budget(spark):
    say = lambda n: " ".join(["word"] * n)
    rows = [(8, 0, "system", say(600))] + [(8, i, ("user", "assistant")[i % 2], say(20)) for i in range(1, 60)]
    made, _ = check_chat(spark, rows)
    assert len(made) > 3 and max(r["tokens"] for r in made) <= 1024
    # A system turn that leaves no room: a window for every turn.
    made, want = check_chat(spark, rows, budget=700, history=100)
    assert len(made) == len(want[8])


def test_chat_empty(spark):
    assert chat.windows(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    from millrace.llm.chat import op6

    got = {r["conv_id"]: r for r in op6(spark, sf).collect()}
    want = defaultdict(list)
    said = r"\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    for conv, _, role, text in sorted([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)]):
        want[conv].append((role, text))
    assert set(got) == set(want)
    for conv, turns in want.items():
        r = got[conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss) and r["loss_sha256"] == digest(loss)
        assert r["turns_sha256"] == digest("".join(f"{role}\n{t}\n" for role, t in turns))


def brute_top_k(rows, asked, k):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if asked(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("kind", ["normal", "ties", "sparse", "few", "huge"])
def test_top_k_against_brute_force(spark, kind):
    draw = np.random.default_rng(4)
    n = 3 if kind == "few" else 400
    values = draw.normal(0, 0.3, (n, 16))
    if kind == "ties":
        values = np.round(values)
    if kind == "sparse":
        values *= draw.random((n, 16)) < 0.2
    if kind == "huge":
        values *= 1e6
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(values)]
    rows += [(-50, None), (1000, [None] * 16), (1050, [float("nan")] * 16), (1100, [float("inf")] * 16), (None, [0.5] * 16)]
    frame = vectors(spark, rows)
    got = topk.top_k_inner(frame, frame.filter("vec_id % 50 = 0"), block_rows=64, query_rows=4).collect()
    assert sorted(map(tuple, got)) == brute_top_k(rows, lambda i: i % 50 == 0, 5)


def test_top_k_lengths_and_repeats(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, [0.5, 0.5, 9.0]), (2, [0.5, 0.5, 9.0]), (3, [])]
    frame = vectors(spark, rows)
    got = topk.top_k_inner(frame, frame.filter("vec_id = 0")).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2, 98304), (0, 2, 2, 98304), (0, 3, 1, 65536), (0, 4, 3, 0)]


def test_top_k_empty(spark):
    frame = vectors(spark, [])
    assert topk.top_k_inner(frame, frame).count() == 0


def test_bounds_hold():
    draw = np.random.default_rng(8)
    block, asks = draw.integers(-50, 50, (300, 12)).astype(float), draw.integers(-50, 50, (20, 12)).astype(float)
    exact = block @ asks.T
    lists = topk.SortedLists(block)
    for depth in (1, 10, 100, 250):
        lower, upper, outside = lists.bounds(asks, depth)
        assert (lower <= exact).all() and (upper >= exact).all()
        unseen = ~((lists.place < depth) | (lists.place >= 300 - depth)).any(axis=1)
        assert (exact[unseen] <= outside).all()


def test_blocks_go_on_with_the_best_so_far(monkeypatch):
    """A query's best scores leave vectors of later blocks out, and lists are read on where they cannot stop."""
    rounds, bounds = [], topk.SortedLists.bounds
    monkeypatch.setattr(topk.SortedLists, "bounds", lambda *a: rounds.append(a[2]) or bounds(*a))
    draw = np.random.default_rng(3)
    values, asks = np.floor(256 * draw.normal(0, 0.1, (4_000, 32))), np.floor(256 * draw.normal(0, 0.1, (20, 32)))
    held, found = np.full((20, 5), -np.inf), []
    for start in range(0, 4_000, 500):
        ids = np.arange(start, start + 500)
        which, who, scores = topk.block_top_k(topk.SortedLists(values[start : start + 500]), ids, asks, -np.ones(20), 5, held[:, 0])
        assert (scores >= held[which, 0]).all()
        held = topk.better(held, which, scores)
        found.append(len(which))
    assert (np.sort(held, axis=1) == np.sort(values @ asks.T, axis=0)[-5:].T).all()
    assert sum(found) < 8 * 5 * 20 / 2 and len(rounds) < 8 * len(topk.DEPTHS) / 2


def test_top_k_of_mixed_blocks(spark):
    """Blocks of single, double and whole precision, lengths, nulls and rows that come twice."""
    draw = np.random.default_rng(5)
    rows = [(i, (10.0 ** draw.integers(-1, 6) * draw.normal(0, 1, draw.integers(0, 9))).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, None) for i in range(300, 400, 10)] + [(None, [1.0, 2.0]), (400, [1.0, None]), (401, [0.5] * 8), (401, [0.5] * 8)]
    asked = lambda i: i % 50 == 0
    padded = [(i, None if v is None else [*v, *[0.0] * (9 - len(v))]) for i, v in rows]
    frame = vectors(spark, rows).repartition(3)
    for sizes in ((16, 2), (64, 4)):
        got = topk.top_k_inner(frame, frame.filter("vec_id % 50 = 0"), block_rows=sizes[0], query_rows=sizes[1]).collect()
        assert sorted(map(tuple, got)) == brute_top_k(padded, asked, 5)


def test_queries_are_sent_to_blocks_of_vectors(spark):
    """The smaller blocks of queries are repeated for each block of vectors, and not the other way round."""
    frame = vectors(spark, [(i, [1.0, 2.0]) for i in range(200)])
    made = topk.top_k_inner(frame, frame.filter("vec_id % 50 = 0"), block_rows=16)._jdf.queryExecution()
    plan = made.optimizedPlan().toString()
    dealt = plan[plan.index("Generate") :].split("\n")[1]
    assert "query_values" in dealt and "block_values" not in dealt
    assert "Broadcast" not in made.executedPlan().toString()

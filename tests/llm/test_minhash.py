"""Near duplicates: brute force, large groups, and odd rows."""

import itertools
import random
import re

import pytest

from millrace.llm import minhash
from millrace.operators import joins
from millrace.llm.components import components

SCHEMA = "doc_id long, text string, kept string"


def sets_of(rows, size):
    out = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        k = min(size, len(words))
        out[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set()
    return out


def brute(rows, size, percent=80):
    sets = sets_of(rows, size)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def run(spark, rows, size):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    return {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(frame, size=size).collect()}


def mutate(draw, words, share):
    return [draw.choice("klmnopq") * 3 + str(draw.randint(0, 999)) if draw.random() < share else w for w in words]


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, size):
    """Copies, chains of small changes, and a passage that many documents share."""
    draw = random.Random(size)
    fresh = lambda n: [f"w{draw.randint(0, 400)}" for _ in range(n)]
    rows, passage = [], fresh(30)
    for _ in range(8):
        words = fresh(80)
        for _ in range(12):
            rows.append(" ".join(words))
            words = mutate(draw, words, 0.03)
    base = fresh(120)
    rows += [" ".join(mutate(draw, base, 0.03)) for _ in range(60)]
    rows += [" ".join(passage + fresh(draw.randint(0, 30))) for _ in range(80)]
    rows += ["One TWO", "one two", "one", "ONE", "", None, " \n", "é é", "É é", "a b c", "x " * 20_000]
    rows = list(enumerate(rows, 5))
    draw.shuffle(rows)
    assert run(spark, rows, size) == brute(rows, size)


def test_group_at_the_edge_of_similarity(spark):
    """Copies of which many are just too different from each other and from their source; small blocks."""
    draw = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(mutate(draw, base, draw.choice([0.02, 0.06, 0.09, 0.12])))) for i in range(150)]
    minhash.BLOCK, old = 16, minhash.BLOCK
    try:
        assert run(spark, rows, 2) == brute(rows, 2)
    finally:
        minhash.BLOCK = old


def test_many_near_copies_need_few_pairs(spark):
    """A group of near copies is worked off by leaders, not by pairs."""
    draw = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(mutate(draw, base, 0.01))) for i in range(400)]
    got = run(spark, rows, 2)
    assert {r[1] for r in got.values()} == {0} and sum(r[2] for r in got.values()) == 1


def test_null_and_repeated_ids(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (None, "alone with no id"), (9, "another one"), (9, "another one"), (4, text)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = sorted(map(str, minhash.near_duplicates(frame, size=2).select("doc_id", "component_id", "kept").collect()))
    want = [(None, 4, False), (None, 4, False), (None, None, True), (9, 9, True), (9, 9, True), (4, 4, True)]
    assert got == sorted(f"Row(doc_id={a}, component_id={b}, kept={c})" for a, b, c in want)
    left = minhash.without_near_duplicates(frame, size=2).select("doc_id", "text").collect()
    assert sorted(map(tuple, left), key=str) == sorted([(None, rows[2][1]), (9, rows[3][1]), (4, text)], key=str)


def test_empty(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_and_hubs(spark):
    draw = random.Random(3)
    path = list(range(100, 160))
    draw.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1, k) for k in range(2, 50)] + [(7, 200), (300, 301), (300, 301), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).filter("node != root").collect()))
    want = {n: 100 for n in path if n != 100} | {k: 1 for k in range(2, 50)} | {200: 1, 301: 300}
    assert got == want


def test_most_central_members_lead(spark):
    rows = [(1, n, 5, [0], n % 4) for n in range(10)] + [(2, 5, 5, [0], 1)]
    frame = spark.createDataFrame(rows, "bucket long, node long, n_shingles long, bits array<long>, degree long")
    assert {(r["bucket"], r["leader"]) for r in minhash._leaders(frame).collect()} == {(1, 3), (2, 5)}


def test_bits_of_signatures():
    hasher = minhash.MinHasher(4, 5)
    signature = hasher.signature(minhash.shingles(b"a b c d", minhash.WordHash()))
    assert len(signature) == 20 and len(hasher.bits(signature)) == 1


@pytest.mark.parametrize("most_bits", [64, 1 << 28])
def test_screened_semi_join(spark, most_bits):
    """All wanted rows stay and no others; unless the bitmap is full it lets few others pass."""
    rows = spark.range(20_000).selectExpr("(id % 10000) * 7919 - 40000000 AS k", "id")
    wanted = spark.range(300).selectExpr("id * 7919 * 30 - 40000000 AS k")
    flagged = joins.with_maybe(rows, wanted, "k", "maybe", most_bits)
    assert flagged.columns == ["k", "id", "maybe"] and flagged.count() == 20_000
    assert flagged.join(wanted, "k", "left_semi").filter("NOT maybe").isEmpty()
    assert most_bits == 64 or flagged.filter("maybe").count() < 0.15 * 20_000
    got, want = joins.only_wanted(rows, wanted, "k", most_bits), rows.join(wanted, "k", "left_semi")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() == 600
    assert joins.only_wanted(rows, wanted.limit(0), "k").isEmpty()


def test_texts_that_stay_are_not_shuffled(spark, monkeypatch):
    """Only documents in question meet an exact join, and intermediate tables are gone once roots are stored."""
    seen = []
    plain = minhash.shingle_sets

    def watched(docs, size):
        seen.append(docs._jdf.queryExecution().toString())
        return plain(docs, size)

    monkeypatch.setattr(minhash, "shingle_sets", watched)
    draw = random.Random(1)
    texts = [" ".join(f"w{draw.randint(0, 10**6)}" for _ in range(40)) for _ in range(300)]
    rows = [*enumerate(texts), (900, texts[3]), (901, texts[4] + " x"), (5, texts[5]), (902, "other"), (902, texts[6])]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    kept = sorted(r["doc_id"] for r in minhash.without_near_duplicates(frame).collect())
    assert kept == list(range(300))
    assert seen and "bitmap_construct_agg" in seen[0]


def test_settled_drops_what_was_made_on_the_way(spark):
    import os

    from millrace.session import materialize, settled, shared_dir

    outside = materialize(spark.range(3), "outside")
    result = settled(lambda: settled(lambda: materialize(outside, "deep"), "inner").join(outside, "id"), "result")
    folder = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}".removeprefix("file:")
    left = {name.split("-")[0] for name in os.listdir(folder)}
    assert result.count() == outside.count() == 3 and "result" in left and not left & {"deep", "inner"}

"""Boosted trees on histograms against a plain exact booster."""

import math
import pickle
import random

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from millrace.operators import boosting
from millrace.operators.boosting import BoostedTrees, boost


def softmax(margins):
    top = max(margins)
    raised = [math.exp(m - top) for m in margins]
    return [r / sum(raised) for r in raised]


def plain_tree(rows, g, h, members, depth, rate, penalty=1.0, least=1.0):
    """Every cut of every feature between distinct values, missing values on either side."""
    G, H = sum(g[i] for i in members), sum(h[i] for i in members)
    leaf = -rate * G / (H + penalty)
    best = (1e-6, None)
    if depth:
        for side in (True, False):
            for f in range(len(rows[0])):
                for cut in sorted({rows[i][f] for i in members if rows[i][f] is not None}):
                    left = [i for i in members if (side if rows[i][f] is None else rows[i][f] <= cut)]
                    GL, HL = sum(g[i] for i in left), sum(h[i] for i in left)
                    GR, HR = G - GL, H - HL
                    if HL < least or HR < least:
                        continue
                    gain = 0.5 * (GL**2 / (HL + penalty) + GR**2 / (HR + penalty) - G**2 / (H + penalty))
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, side, set(left)))
    if best[1] is None:
        return lambda row: leaf
    f, cut, side, left = best[1]
    low = plain_tree(rows, g, h, [i for i in members if i in left], depth - 1, rate, penalty, least)
    high = plain_tree(rows, g, h, [i for i in members if i not in left], depth - 1, rate, penalty, least)
    return lambda row: (low if (side if row[f] is None else row[f] <= cut) else high)(row)


def plain_boost(rows, labels, classes, rounds, depth, rate):
    count = 1 if classes == 2 else classes
    margins = [[0.0] * count for _ in rows]
    for _ in range(rounds):
        grown = []
        for c in range(count):
            if count == 1:
                p = [1 / (1 + math.exp(-m[0])) for m in margins]
                g, h = [x - y for x, y in zip(p, labels)], [x * (1 - x) for x in p]
            else:
                p = [softmax(m)[c] for m in margins]
                g, h = [x - (y == c) for x, y in zip(p, labels)], [2 * x * (1 - x) for x in p]
            grown.append(plain_tree(rows, g, h, list(range(len(rows))), depth, rate))
        for row, margin in zip(rows, margins):
            for c, tree in enumerate(grown):
                margin[c] += tree(row)
    return [softmax(m) if count > 1 else [1 - 1 / (1 + math.exp(-m[0])), 1 / (1 + math.exp(-m[0]))] for m in margins]


def sample(classes, n=90):
    rng = random.Random(classes)
    rows = []
    for i in range(n):
        a, b = rng.randrange(12), rng.choice([None, 1.5, 2.5, rng.randrange(8) / 2])
        y = min(classes - 1, max(0, (a + int(2 * (b or 3)) + rng.randrange(3)) * classes // 24))
        rows.append((i, float(a), b if b is None else float(b), rng.randrange(3), y))
    return rows


@pytest.mark.parametrize("classes", [2, 3])
@pytest.mark.parametrize("parts", [1, 5])
def test_trees_equal_a_plain_booster(spark, monkeypatch, classes, parts):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100 // parts)
    rows = sample(classes)
    df = spark.createDataFrame(rows, "id int, a double, b double, c int, y int")
    model = boost(df, ["a", "b", "c"], "y", classes, rounds=4, depth=3, rate=0.3)
    scored = {r["id"]: list(r["probability"]) for r in model.transform(df).collect()}
    want = plain_boost([r[1:4] for r in rows], [r[4] for r in rows], classes, 4, 3, 0.3)
    for r, p in zip(rows, want):
        assert scored[r[0]] == pytest.approx(p, abs=1e-5)


def test_partitions_do_not_change_the_trees(spark, monkeypatch):
    df = spark.createDataFrame(sample(3, 400), "id int, a double, b double, c int, y int")
    models = []
    for rows, parts in ((400, 32), (30, 2), (7, 2)):
        monkeypatch.setattr(boosting, "BLOCK_ROWS", rows)
        monkeypatch.setattr(boosting, "DRIVER_PARTS", parts)  # few: sums are added up in a tree of tasks
        models.append(boost(df, ["a", "b", "c"], "y", 3, rounds=5, depth=4))
    for other in models[1:]:
        for mine, theirs in zip(models[0].rounds, other.rounds, strict=True):
            for a, b in zip(mine, theirs, strict=True):
                assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.array_equal(a.value, b.value)


def test_only_cuts_reach_the_driver(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    sent, cores = [], spark.sparkContext.defaultParallelism
    plain = RDD.collect

    def counted(self):
        rows = plain(self)
        sent.append(len(pickle.dumps(rows)))
        return rows

    monkeypatch.setattr(RDD, "collect", counted)
    rng = random.Random(4)
    rows = [(rng.random(), rng.random(), rng.random(), rng.randrange(3)) for _ in range(100 * cores)]
    boost(spark.createDataFrame(rows, "a double, b double, c double, y int"), ["a", "b", "c"], "y", 3, rounds=2, depth=5, least_hessian=0.1)
    sums = 3 * 2 * 3 * boosting.BINS * 8  # of one node, from one task
    assert len(sent) >= 10 and max(sent) < sums


def test_patience_and_checkpoints(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CUT_AFTER", 2)
    rng = random.Random(1)
    rows = [(float(i % 10), int((i % 10 > 4) != (rng.random() < 0.2)), i % 3 == 0) for i in range(600)]
    df = spark.createDataFrame(rows, "x double, y int, held boolean")
    model = boost(df, ["x"], "y", validation="held", rounds=200, depth=2, rate=0.5, patience=3)
    best = min(range(len(model.losses)), key=model.losses.__getitem__)
    assert 0 < len(model.rounds) == best and len(model.losses) == best + 4
    assert model.losses[0] == pytest.approx(math.log(2), abs=1e-6)
    right = model.transform(df).filter(F.col("prediction") == F.col("y")).count() / 600
    assert right == pytest.approx(0.8, abs=0.03)


def test_odd_tables(spark, tmp_path):
    df = spark.createDataFrame(sample(3), "id int, a double, b double, c int, y int")
    model = boost(df, ["a", "b", "c"], "y", 3, rounds=3, depth=2)
    model.save(spark, str(tmp_path))
    again = BoostedTrees.load(spark, str(tmp_path))
    assert model.transform(df).exceptAll(again.transform(df)).isEmpty()
    empty = boost(df.limit(0), ["a", "b"], "y", 3, rounds=3)
    assert empty.rounds == [] and empty.transform(df).first()["probability"] == pytest.approx([1 / 3] * 3)
    nothing = df.select("id", "y", F.lit(None).cast("double").alias("a"), F.lit(2.0).alias("b"))
    flat = boost(nothing, ["a", "b"], "y", 3, rounds=2, depth=2)
    assert flat.transform(nothing).select("probability").distinct().count() == 1
    with pytest.raises(ValueError, match="gone"):
        boost(df, ["gone"], "y")

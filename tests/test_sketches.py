"""Mergeable sketches against exact figures, and paths inside variants against plain recursion."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.operators.sketches import DISTINCT_ERROR, RANK_ERROR, daily_sketches, range_summary
from millrace.sources.landing import variant_paths


def test_ranges_from_sketches(spark):
    rng = random.Random(1)
    rows = [(f"d{i % 9}", rng.randrange(3000), rng.expovariate(0.1)) for i in range(12_000)] + [(None, 1, None)]
    df = spark.createDataFrame(rows, "day string, k int, v double").repartition(6)
    sketches = daily_sketches(df, F.col("day"), "k", "v")
    assert sketches.count() == 10
    ranges = spark.createDataFrame([("one", "d2", "d2"), ("some", "d1", "d6"), ("none", "x", "y")], "range string, first string, last string")
    found = {r["range"]: r for r in range_summary(sketches, ranges, (0.1, 0.5, 0.99)).collect()}
    assert set(found) == {"one", "some"}
    for name, low, high in (("one", "d2", "d2"), ("some", "d1", "d6")):
        mine = [r for r in rows if r[0] and low <= r[0] <= high]
        assert found[name]["rows"] == len(mine)
        exact = len({r[1] for r in mine})
        assert abs(found[name]["distinct"] - exact) <= 4 * DISTINCT_ERROR * exact
        values = sorted(r[2] for r in mine)
        for share, value in zip((0.1, 0.5, 0.99), found[name]["quantiles"]):
            assert abs(sum(v <= value for v in values) / len(values) - share) <= 2 * RANK_ERROR
    assert range_summary(daily_sketches(df.limit(0), F.col("day"), "k", "v"), ranges).count() == 0


def walk(value, path, into):
    kinds = {dict: "object", list: "array", str: "text", bool: "boolean", int: "number", float: "number", type(None): "null"}
    into[path, kinds[type(value)]] += 1
    if isinstance(value, dict):
        for key, inner in value.items():
            walk(inner, f"{path}.{key}", into)
    elif isinstance(value, list):
        for inner in value:
            walk(inner, f"{path}[*]", into)


def test_variant_paths(spark):
    given = [{"a": 1, "b": [1.5, None, {"c": "x", "d": []}]}, {"a": "1", "b": None}, [[1, 2], [True]], 7, "text", {}, None]
    texts = [(json.dumps(x),) for x in given] + [(None,), ("not json",)]
    landing = spark.createDataFrame(texts, "t string").select(F.try_parse_json("t").alias("src"))
    want = Counter()
    for x in given:
        walk(x, "$", want)
    assert {(r["path"], r["type"]): r["rows"] for r in variant_paths(landing).collect()} == want
    assert variant_paths(landing.limit(0)).count() == 0

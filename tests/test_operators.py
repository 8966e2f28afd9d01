import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.dedup import key_counts, latest_per_key
from millrace.operators.encode import category_codes, encode_categories
from millrace.operators.joins import count_difference, enrich
from millrace.operators.merge import (
    current_version,
    incremental_build,
    merge_by_key,
    merge_touched_partitions,
    newer_rows,
    read_current,
    run_incremental,
)
from millrace.operators.profile import dataset_rows, profile, profile_alerts, rows_per_month, table_inventory
from millrace.operators.quality import (
    PRODUCTS,
    DataTestFailure,
    assert_contract,
    column_tests,
    combine,
    contract,
    enforce,
    expected_count_test,
    freshness_test,
    key_share_test,
    not_empty_test,
    row_count_test,
    unique_test,
)
from millrace.operators.ranking import running_totals, value_ranks, with_rank
from millrace.operators.resync import index_manifest, sync_report, sync_status, to_index
from millrace.operators.sampling import first_rows, hash_sample, stratified_split
from millrace.operators.windows import top_per_key, with_group_values
from millrace.session import shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, null keys, many equal values."""
    rng = random.Random(5)
    rows = [
        (i, "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rng.randrange(20)}"), float(rng.randrange(9)))
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id long, k string, v double").repartition(7).cache()


def test_rank_equals_window(skewed):
    ranked = with_rank(skewed, ["v", "id"], "r", ["k"])
    window = F.row_number().over(Window.partitionBy("k").orderBy("v", "id"))
    assert ranked.withColumn("w", window).filter("r <> w").count() == 0
    assert ranked.count() == 3000
    whole = with_rank(skewed, ["v", "id"])
    assert whole.withColumn("w", F.row_number().over(Window.orderBy("v", "id"))).filter("rank <> w").count() == 0


def test_running_totals_equal_window(skewed):
    counts = skewed.groupBy("k", "v").agg(F.count("*").alias("n"))
    summed = running_totals(counts, ["v"], {"upto": "n"}, ["k"])
    window = F.sum("n").over(Window.partitionBy("k").orderBy("v"))
    assert summed.count() == counts.count()
    assert summed.withColumn("w", window).filter("upto <> w").count() == 0


def test_value_ranks_skip_null(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (None,), (3.0,)], "v double")
    assert sorted((r.v, r.n, r.upto) for r in value_ranks(df, "v").collect()) == [(1.0, 1, 1), (3.0, 2, 3)]


def test_group_values_equal_window(skewed):
    mine = with_group_values(skewed, ["k"], {"n": F.count(F.lit(1)), "top": F.max("v")})
    w = Window.partitionBy("k")
    both = mine.withColumns({"wn": F.count(F.lit(1)).over(w), "wt": F.max("v").over(w)})
    assert both.count() == 3000 and both.filter("n <> wn or top <> wt").count() == 0
    assert both.filter("k is null and n is null").count() == 0


def test_top_per_key(skewed):
    top = top_per_key(skewed, ["k"], [F.col("v").desc(), F.col("id")], 2)
    assert top.groupBy("k").count().filter("count > 2").count() == 0
    assert top.filter("k = 'hot' and position = 1").first().v == 8.0


def test_latest_is_unique_and_idempotent(spark):
    rows = [("a", 1, "f1"), ("a", 2, "f2"), ("a", 2, "f1"), ("b", 1, "f1"), ("b", 1, "f1"), (None, 1, "x"), (None, 1, "y")]
    df = spark.createDataFrame(rows, "k string, loaded int, file string")
    order = [F.col("loaded").desc(), F.col("file")]
    latest = latest_per_key(df, ["k"], order)
    assert sorted(latest.collect(), key=str) == sorted([("a", 2, "f1"), ("b", 1, "f1"), (None, 1, "x")], key=str)
    assert sorted(latest_per_key(latest, ["k"], order).collect(), key=str) == sorted(latest.collect(), key=str)
    assert key_counts(df, "k").first()[:] == (7, 2)


def test_incremental_runs(spark, tmp_path):
    schema = "k string, v int, at timestamp"
    at = lambda day: f"2024-01-{day:02d} 00:00:00"
    rows = lambda *r: spark.createDataFrame([(k, v, at(d)) for k, v, d in r], "k string, v int, at string").select(
        "k", "v", F.col("at").cast("timestamp").alias("at")
    )
    root = str(tmp_path / "table")
    assert current_version(spark, root) == 0 and read_current(spark, root) is None
    first = rows(("a", 1, 1), ("b", 1, 1))
    run_incremental(first, root, ["k"], "at")
    run_incremental(first, root, ["k"], "at")
    assert {(r.k, r.v) for r in read_current(spark, root).collect()} == {("a", 1), ("b", 1)}
    second = first.unionByName(rows(("b", 2, 2), ("b", 3, 3), ("c", 1, 3))).withColumn("extra", F.lit("x"))
    assert run_incremental(second, root, ["k"], "at") == 3
    stored = {r.k: (r.v, r.extra) for r in read_current(spark, root).collect()}
    assert stored == {"a": (1, None), "b": (3, "x"), "c": (1, "x")}
    run_incremental(second, root, ["k"], "at")
    assert {r.k: (r.v, r.extra) for r in read_current(spark, root).collect()} == stored
    assert newer_rows(second, spark.createDataFrame([], schema), "at").count() == 5
    assert incremental_build(first, None, ["k"], "at") is first


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    old=st.dictionaries(st.integers(0, 6), st.integers(0, 3), max_size=6),
    new=st.dictionaries(st.integers(0, 6), st.integers(0, 3), max_size=6),
)
def test_merge_is_a_dictionary_update(spark, old, new):
    frame = lambda d: spark.createDataFrame(list(d.items()), "k int, v int")
    merged = merge_by_key(frame(old), frame(new), ["k"])
    assert dict(tuple(r) for r in merged.collect()) == {**old, **new}
    again = merge_by_key(merged, frame(new), ["k"])
    assert dict(tuple(r) for r in again.collect()) == {**old, **new}


def test_merge_of_touched_partitions(spark):
    target = spark.createDataFrame([(1, "p", 0), (2, "p", 0), (3, "q", 0)], "k int, part string, v int")
    updates = spark.createDataFrame([(2, "p", 9), (4, "p", 9)], "k int, part string, v int")
    changed = merge_touched_partitions(target, updates, ["k"], "part")
    assert sorted(tuple(r) for r in changed.collect()) == [(1, "p", 0), (2, "p", 9), (4, "p", 9)]
    unknown = updates.withColumn("part", F.lit(None).cast("string"))
    merged = merge_touched_partitions(target.union(unknown.limit(0)), unknown, ["k"], "part")
    assert sorted(r.k for r in merged.collect()) == [2, 4]


def test_enrich_and_difference(spark, skewed):
    items = spark.createDataFrame([("hot", 1)], "k string, price int")
    assert enrich(skewed, items, "k").count() == 3000
    with pytest.raises(ValueError):
        enrich(skewed, items, "nope")
    assert count_difference(skewed, skewed, ["k"]).count() == 0
    assert count_difference(skewed, skewed.filter("k = 'hot'").limit(10), ["k"]).filter("k = 'hot'").count() == 1


def test_codes_are_first_seen(spark):
    rows = [(0, "b", 5), (1, None, 5), (2, "a", 6), (3, "b", 6)]
    df = spark.createDataFrame(rows, "id int, c string, n int")
    coded = encode_categories(df, ["c", "n"], ["id"]).orderBy("id")
    assert [(r.c_idx, r.n_idx) for r in coded.collect()] == [(0, 0), (-1, 0), (1, 1), (0, 1)]
    assert coded.columns == ["id", "c_idx", "n_idx"]
    assert category_codes(df, ["c"], ["n", "id"]).count() == 2


def test_split_sizes_are_exact_and_stable(spark, skewed):
    split = stratified_split(skewed, "k", ["id"], 0.2, 42)
    shares = split.groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"))
    assert shares.filter("t <> floor(n * 0.2 + 0.5)").count() == 0
    again = stratified_split(skewed.repartition(3), "k", ["id"], 0.2, 42)
    assert split.exceptAll(again).count() == 0 and split.count() == 3000


def test_samples(skewed):
    sample = hash_sample(skewed, ["id"], 0.3, 7)
    assert 800 < sample.count() < 1000
    assert sample.exceptAll(hash_sample(skewed.repartition(2), ["id"], 0.3, 7)).count() == 0
    assert hash_sample(skewed, ["id"], 1.0, 7).count() == 3000
    assert hash_sample(skewed, ["id"], 0.0, 7).count() == 0
    with pytest.raises(ValueError):
        hash_sample(skewed, ["id"], 1.5, 7)
    for n in (10, 20_000):
        ids = sorted(r.id for r in first_rows(skewed.select("id"), ["id"], n).collect())
        assert ids == list(range(min(n, 3000)))


def _status(result):
    return {(r.test, r.column): (r.failures, r.status) for r in result.collect()}


def test_column_tests(spark):
    rows = [("a", PRODUCTS[0]), ("a", None), (None, "Other"), ("b", "Other"), (None, "Else")]
    df = spark.createDataFrame(rows, "k string, product string")
    results = combine(column_tests(df, ["k"], {"product": PRODUCTS}), unique_test(df, "k"))
    assert _status(results) == {
        ("not_null", "k"): (2, "fail"),
        ("accepted_values", "product"): (2, "warn"),
        ("unique", "k"): (1, "fail"),
    }
    with pytest.raises(DataTestFailure, match="not_null"):
        enforce(results)
    enforce(column_tests(df, [], {"product": PRODUCTS}))


def test_count_tests(spark):
    df, none = spark.range(10), spark.range(0)
    assert _status(row_count_test(df, "d", 11)) == {("min_rows", "d"): (1, "fail")}
    assert _status(row_count_test(df, "d", 10)) == {("min_rows", "d"): (0, "pass")}
    assert _status(not_empty_test(none, "d")) == {("not_empty", "d"): (1, "fail")}
    assert _status(expected_count_test(df, "d", 9)) == {("expected_count", "d"): (1, "warn")}
    assert _status(expected_count_test(none, "d", 9)) == {("expected_count", "d"): (9, "fail")}
    keyed = lambda blanks: spark.range(100).select(F.when(F.col("id") >= blanks, "x").otherwise(" ").alias("k"))
    assert _status(key_share_test(keyed(1), "k"))[("key_share", "k")] == (1, "pass")
    assert _status(key_share_test(keyed(2), "k"))[("key_share", "k")] == (2, "fail")
    assert _status(key_share_test(keyed(0).limit(0), "k"))[("key_share", "k")] == (0, "fail")


@pytest.mark.parametrize("day,status", [("2024-01-31", "pass"), ("2024-02-01", "warn"), ("2024-03-31", "warn"), ("2024-04-01", "fail")])
def test_freshness_limits(spark, day, status):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert freshness_test(df, "t", F.lit(day).cast("timestamp")).first().status == status
    assert freshness_test(df.limit(0), "t", F.lit(day).cast("timestamp")).first().status == "fail"


def test_contracts(spark):
    same, other = contract("d", spark.range(3), spark.range(3)), contract("d", spark.range(3), spark.range(2))
    alone = contract("d", spark.range(3), None)
    assert [c.first().status for c in (same, other, alone)] == ["PASS", "FAIL", "LOCAL_ONLY"]
    assert_contract(combine(same, alone))
    with pytest.raises(DataTestFailure):
        assert_contract(combine(same, other))


def test_profile(spark, tmp_path):
    rows = [(1, "a", "2024-01-02"), (1, "a", "2024-01-02"), (None, "b", "2024-01-01"), (None, "b", "2024-01-01")]
    df = spark.createDataFrame(rows, "u int, i string, d string")
    profiled = profile(df, ["u", "i"], "d")
    assert profiled.first().asDict() == {
        "total_rows": 4, "null_u": 2, "null_i": 0, "duplicate_rows": 2,
        "first_day": "2024-01-01", "last_day": "2024-01-02",
    }
    assert [tuple(r) for r in profile_alerts(profiled).collect()] == [("u", 2)]
    assert rows_per_month(df, "d").first()[:] == ("2024", "01", 4)
    df.write.partitionBy("u").parquet(str(tmp_path / "t"))
    assert dataset_rows(spark, str(tmp_path / "t")) == 4
    with pytest.raises(Exception):
        dataset_rows(spark, str(tmp_path / "missing"))
    df.createOrReplaceTempView("inventory_a")
    df.limit(1).createOrReplaceTempView("inventory_b")
    inventory = table_inventory(spark, "inventory_*")
    assert [tuple(r) for r in inventory.collect()] == [("inventory_a", 4), ("inventory_b", 1)]
    assert table_inventory(spark, "nothing_*").count() == 0


def test_resync(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, t string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, t string")
    manifest = index_manifest(old, "k", "t")
    status = sync_status(new, manifest, "k", "t")
    assert dict(tuple(r) for r in status.collect()) == {1: "unchanged", 2: "modified", 3: "deleted", 4: "new"}
    assert sync_report(status).first()[:] == (3, 1, 1, 1, 1)
    assert sorted(r.k for r in to_index(new, manifest, "k", "t").collect()) == [2, 4]
    assert to_index(new, index_manifest(new, "k", "t"), "k", "t").count() == 0


def test_resync_of_null_texts_and_keys(spark):
    old = spark.createDataFrame([(1, None), (2, "b"), (None, "n")], "k int, t string")
    new = spark.createDataFrame([(1, None), (2, None), (3, None), (None, "n")], "k int, t string")
    manifest = index_manifest(old, "k", "t")
    status = dict(tuple(r) for r in sync_status(new, manifest, "k", "t").collect())
    assert status == {1: "unchanged", 2: "modified", 3: "new", None: "unchanged"}
    assert sorted(r.k for r in to_index(new, manifest, "k", "t").collect()) == [2, 3]
    assert to_index(new, index_manifest(new, "k", "t"), "k", "t").count() == 0


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert shared_dir(spark)

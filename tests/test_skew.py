"""One key with a large share of the rows, on plans that must split it."""

import contextlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.encode import encode_categories
from millrace.operators.joins import enrich
from millrace.operators.merge import merge_by_key
from millrace.operators.windows import with_group_values
from millrace.session import materialize

ROWS = 200_000

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Half of the rows carry one key; the rest is spread over 5,000 keys."""
    path = str(tmp_path_factory.mktemp("facts") / "rows")
    hot = F.col("id") % 2 == 0
    spark.range(0, ROWS, 1, 8).select(
        "id",
        F.when(hot, F.lit(-1)).otherwise(F.col("id") % 5000).alias("k"),
        (F.col("id") % 100).cast("double").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def executed(df):
    """Run the frame and return its final plan."""
    df.write.format("noop").mode("overwrite").save()
    frame = df._jdf
    frame.queryExecution().executedPlan().execute().count()
    return frame.queryExecution().executedPlan().toString()


def test_group_values(spark, facts):
    with settings(spark, SHUFFLED):
        joined = with_group_values(facts, ["k"], {"n": F.count(F.lit(1)), "mean": F.avg("v")})
        assert "skew=true" in executed(joined)
        window = F.count(F.lit(1)).over(Window.partitionBy("k"))
        assert joined.withColumn("w", window).filter("n <> w").count() == 0
        assert joined.count() == ROWS


def test_enrich(spark, facts):
    items = materialize(facts.select("k").distinct().withColumn("name", F.concat(F.lit("item"), "k")))
    with settings(spark, SHUFFLED):
        joined = enrich(facts, items, "k")
        assert "skew=true" in executed(joined)
        assert joined.filter("name is not null").count() == ROWS


def test_merge(spark, facts):
    changed = {"id": F.lit(0).cast("long"), "v": F.lit(0.0), "pad": F.lit("")}
    updates = materialize(facts.filter("k between 0 and 9").select("k").distinct().withColumns(changed))
    with settings(spark, SHUFFLED):
        merged = merge_by_key(facts, updates, ["k"])
        assert "skew=true" in executed(merged)
        replaced = facts.filter("k between 0 and 9").count()
        assert merged.count() == ROWS - replaced + updates.count()


def test_codes(spark, facts):
    with settings(spark, SHUFFLED):
        coded = encode_categories(facts.drop("v"), ["k"], ["id"])
        assert "skew=true" in executed(coded)
        assert coded.agg(F.count_distinct("k_idx")).first()[0] == facts.select("k").distinct().count()
        assert coded.count() == ROWS

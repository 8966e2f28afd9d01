"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import top_per_key


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``; rows with a null key form one group.

    ``order`` should be total, so that equal runs keep equal rows.
    """
    return top_per_key(df, keys, order, 1).drop("position")


def key_counts(df: DataFrame, *keys: str) -> DataFrame:
    """One row: all rows, and distinct non-null keys."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*keys).alias("distinct_keys"))


def dedup_landing(landing: DataFrame, key: Column) -> DataFrame:
    """Landing rows reduced to the latest one per key, if there is anything to reduce.

    Rows of one load share their load time, so file name and file row number break ties.
    """
    keyed = landing.withColumn("_key", key)
    counts = key_counts(keyed, "_key").first()
    if counts.distinct_keys == 0 or counts.rows == counts.distinct_keys:
        return landing
    order = [F.col("loaded_at").desc(), F.col("filename"), F.col("file_row_number")]
    return latest_per_key(keyed, ["_key"], order).drop("_key")

"""Whole-partition window values by aggregation and join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import attach_by
from millrace.session import stored_side

WINDOW_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def with_group_values(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Add aggregates of each row's group, as an unordered window would. Null keys form a group.

    A window shuffles and sorts all rows by key and gives a hot key to one task. Here the aggregate
    combines before its shuffle, and its result (one row per group) is stored, so its size in bytes is
    known. A small one is broadcast and the rows are not shuffled at all; otherwise adaptive execution
    splits the partition of a hot group in the join.
    """
    grouped = df.groupBy(*keys).agg(*[value.alias(name) for name, value in values.items()])
    return attach_by(df, stored_side(grouped), list(keys)).select(*df.columns, *values)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark drops surplus rows before the shuffle while ``n`` is within the session's window-group limit,
    so that a task keeps at most ``n`` rows of a hot key. Beyond it the call raises rather than gather
    a hot key in one task.
    """
    limit = df.sparkSession.conf.get(WINDOW_GROUP_LIMIT)
    if int(limit) < n:
        raise ValueError(f"set {WINDOW_GROUP_LIMIT} to at least {n}, or surplus rows of a hot key meet in one task")
    numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("_n") <= n).withColumnRenamed("_n", "position")

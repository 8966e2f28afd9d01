"""Latency summaries by exact rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.measures import average
from millrace.operators.ranking import value_ranks
from millrace.session import materialize


def latency_summary(
    df: DataFrame,
    latency: str,
    elapsed_seconds: Column | float,
    floored: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """One row: requests, throughput, mean, p50, p95 and maximum.

    Of n sorted values, p50 is the one at 1-based rank n // 2 + 1 and p95 the one at rank
    int(0.95 n); where that is 0 it is the last value. ``floored`` rounds 0.95 n to the nearest
    whole number (halves to even) and takes at least rank 1. ``elapsed_seconds`` may be an aggregate
    over ``df``.
    """
    elapsed = elapsed_seconds if isinstance(elapsed_seconds, Column) else F.lit(float(elapsed_seconds))
    stats = df.filter(F.col(latency).isNotNull()).agg(
        F.count(F.lit(1)).alias("requests"),
        elapsed.cast("double").alias("_elapsed"),
        average(latency, scale).alias("_mean"),
        F.max(latency).alias("_max"),
    )
    ranks = materialize(value_ranks(df, latency), "ranks")
    n = ranks.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0]
    p50_rank = n // 2 + 1
    p95_rank = max(1, round(0.95 * n)) if floored else int(0.95 * n) or n
    picks = ranks.agg(
        *[
            F.min(F.when(F.col("upto") >= rank, F.col(latency))).alias(name)
            for name, rank in (("p50", p50_rank), ("p95", p95_rank))
        ]
    )
    # Two one-row tables side by side, by scalar subqueries.
    return stats.select(
        "requests",
        F.round(F.try_divide(F.col("requests"), F.col("_elapsed")), 1).alias("throughput_rps"),
        F.round("_mean", 2).alias("latency_mean"),
        F.round(picks.select("p50").scalar(), 2).alias("latency_p50"),
        F.round(picks.select("p95").scalar(), 2).alias("latency_p95"),
        F.round("_max", 2).alias("latency_max"),
    )

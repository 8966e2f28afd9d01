"""Connected components of an undirected graph by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored_with


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least"))
    least = least.select(F.col("a").alias("_a"), F.least("a", "_least").alias("_least"))
    joined = both.join(least, F.col("a") == F.col("_a")).filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("_least")).withColumnRenamed("a", "_a")
    joined = down.join(least, F.col("a") == F.col("_a"))
    linked = joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a != b")
    return linked.unionByName(least.select(F.col("_a").alias("a"), F.col("_least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link to another; ``root`` is the least node of its component.

    ``links``: columns ``a`` and ``b``. Minima are aggregated before the joins, so a hub with very many
    links is one row per task. Each step is written out, with a digest of its edges taken on the way, and
    the loop ends when that no longer changes.
    """
    digest = {
        "edges": F.count(F.lit(1)),
        "sum": F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")),
    }
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    edges, before = stored_with(ordered.distinct(), "links", digest)
    while before["edges"]:
        edges, now = stored_with(_small_star(_large_star(edges)), "stars", digest)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))

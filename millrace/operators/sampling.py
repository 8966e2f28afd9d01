"""Samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import attach_by, with_rank
from millrace.session import stored_side


def hash_key(keys: Sequence[str], seed: int) -> Column:
    """Hex digest of the key columns and a seed: an order that looks random but never changes."""
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def in_share(keys: Sequence[str], fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the keys, judged by the first eight hex digits of their digest."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"a share lies between 0 and 1: {fraction}")
    draw = F.conv(F.substring(hash_key(keys, seed), 1, 8), 16, 10).cast("long")
    return draw < int(fraction * 16**8)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """A sample that depends only on keys and seed, not on partitioning. A plain filter: no shuffle."""
    return df.filter(in_share(keys, fraction, seed))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 200_000) -> DataFrame:
    """The first ``n`` rows by an explicit total order, ranked in range partitions: no task sorts them all."""
    return with_rank(df, order, "_rank").filter(F.col("_rank") <= n).drop("_rank")


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: exactly the rounded share of each class is ``test``, the rest ``train``.

    Which rows depends on the digest of key and seed only. ``keys`` must identify a row.
    """
    ranked = with_rank(
        df.withColumn("_digest", hash_key(keys, seed)), ["_digest", *keys], "_rank", groups=[label]
    )
    # The last rank of a class is its size. The ranked rows are stored, so the input runs only once.
    sizes = ranked.groupBy(label).agg(F.max("_rank").alias("_size"))
    cut = F.floor(F.col("_size") * test_share + 0.5)
    split = F.when(F.col("_rank") <= cut, F.lit("test")).otherwise(F.lit("train"))
    return attach_by(ranked, stored_side(sizes), [label]).withColumn("split", split).select(*df.columns, "split")

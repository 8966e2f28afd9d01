"""Document re-sync: only new and changed documents are indexed again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def index_manifest(docs: DataFrame, key: str, text: str) -> DataFrame:
    """What an index holds: key and content hash. The hash is long enough to stand for the text."""
    return docs.select(key, F.sha2(F.col(text), 256).alias("content_hash"))


def _compared(docs: DataFrame, manifest: DataFrame, key: str, text: str) -> DataFrame:
    """Keys of both sides with a status. Only keys and hashes are shuffled, not the texts.

    A null text has a null hash, and a key may be null: presence is marked, and nulls are equal.
    """
    now = index_manifest(docs, key, text).select(
        F.col(key).alias("_now"), F.col("content_hash").alias("_now_hash"), F.lit(True).alias("_here")
    )
    before = manifest.select(
        F.col(key).alias("_old"), F.col("content_hash").alias("_old_hash"), F.lit(True).alias("_there")
    )
    status = (
        F.when(F.col("_there").isNull(), "new")
        .when(F.col("_here").isNull(), "deleted")
        .when(F.col("_now_hash").eqNullSafe(F.col("_old_hash")), "unchanged")
        .otherwise("modified")
    )
    both = now.join(before, F.col("_now").eqNullSafe(F.col("_old")), "full_outer")
    return both.select(F.coalesce("_now", "_old").alias(key), status.alias("status"))


def sync_status(docs: DataFrame, manifest: DataFrame, key: str, text: str) -> DataFrame:
    """Rows ``(key, status)`` with status new, modified, unchanged or deleted."""
    return _compared(docs, manifest, key, text)


def to_index(docs: DataFrame, manifest: DataFrame, key: str, text: str) -> DataFrame:
    """The documents to index now: keys are found first, and only then are their texts read."""
    pending = _compared(docs, manifest, key, text).filter(F.col("status").isin("new", "modified"))
    keys = pending.select(F.col(key).alias("_pending")).distinct()
    found = docs.join(keys, F.col(key).eqNullSafe(F.col("_pending")), "left_semi")
    return found.withColumn("content_hash", F.sha2(F.col(text), 256))


def sync_report(status: DataFrame) -> DataFrame:
    """One row of counters."""
    return status.agg(
        F.count_if(F.col("status") != "deleted").alias("scanned"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("new", "modified", "unchanged", "deleted")],
    )

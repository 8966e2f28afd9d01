"""Incremental builds: high-water mark, keyed merge, versioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import latest_per_key
from millrace.session import materialize

# Fixed value: the mark of an empty target.
EARLIEST = "1900-01-01"


def newer_rows(source: DataFrame, target: DataFrame, mark: str) -> DataFrame:
    """Source rows past the target's highest mark, which stays a scalar subquery inside the plan."""
    high = target.select(F.coalesce(F.max(mark), F.lit(EARLIEST).cast(target.schema[mark].dataType)))
    return source.filter(F.col(mark) > high.scalar())


def merge_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with matching rows replaced and new rows added. ``updates`` must have unique keys.

    Columns only the updates have are appended, and are null on untouched rows. A null key never
    matches.
    """
    untouched = target.join(updates.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(updates, allowMissingColumns=True)


def merge_touched_partitions(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], partition: str
) -> DataFrame:
    """New contents of just the partitions the updates fall into.

    Only the values of the partition column are fetched, so that the scan of the target skips all
    other partitions. Valid only if a key never moves to another partition. Write the result with
    ``spark.sql.sources.partitionOverwriteMode=dynamic`` to leave the other partitions alone.
    """
    values = [row[0] for row in updates.select(partition).distinct().collect()]
    touched = F.col(partition).isin([v for v in values if v is not None])
    if None in values:
        touched = touched | F.col(partition).isNull()
    return merge_by_key(target.filter(touched), updates, keys)


def incremental_build(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    mark: str,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """The whole source on the first run; later the newer rows, one per key, merged into the target."""
    if target is None:
        return source
    order = [F.col(mark).desc(), *tie_break]
    # The batch is used twice (to remove, to add). Stored, it is computed once, and the join knows its
    # size: small ones are broadcast, and a join with a large one can still be split by key.
    batch = materialize(latest_per_key(newer_rows(source, target, mark), keys, order), "batch")
    return merge_by_key(target, batch, keys)


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the last published version; 0 if there is none."""
    try:
        log = spark.read.schema("version int").json(f"{root}/published")
    except AnalysisException:
        return 0
    return log.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The last published version of a table, or None."""
    version = current_version(spark, root)
    return spark.read.parquet(f"{root}/data/v{version}") if version else None


def publish(df: DataFrame, root: str) -> int:
    """Write the next version beside the current one, then announce it.

    A Parquet table cannot be rewritten while it is read. Readers see the new version only after the
    last step, so a job that dies half-way leaves the old one in place.
    """
    spark = df.sparkSession
    version = current_version(spark, root) + 1
    df.write.mode("overwrite").parquet(f"{root}/data/v{version}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").json(f"{root}/published")
    return version


def run_incremental(
    source: DataFrame, root: str, keys: Sequence[str], mark: str, tie_break: Sequence[Column] = ()
) -> int:
    """One incremental run against a versioned table. Running it again changes no row."""
    target = read_current(source.sparkSession, root)
    return publish(incremental_build(source, target, keys, mark, tie_break), root)

"""Incremental tables of which a run rewrites only the partitions that it touches.

Plain Parquet: each version writes the partitions that it changes into a folder of its own, and a manifest
that says for every partition in which version's folder its rows are. Files of untouched partitions
stay as they are, under their names. A writer first claims the next version by creating a file that must not
exist, so that two writers cannot work on one version; readers see a version once it is announced.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import latest_per_key
from millrace.operators.merge import current_version, merge_by_key, newer_rows
from millrace.session import materialize

PART = "_part"
NO_VALUE = "__null__"


class VersionClaimed(RuntimeError):
    """Another writer works on the next version, or died at it (then see ``release``)."""


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def claim(spark: SparkSession, root: str) -> int:
    """Claim the version after the current one, as atomically as the file system creates a new file."""
    version = current_version(spark, root) + 1
    files, place = _file_system(spark, f"{root}/claims/v{version}")
    try:
        files.create(place, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise VersionClaimed(f"version {version} of {root} is claimed") from error
        raise
    return version


def release(spark: SparkSession, root: str, version: int) -> None:
    """Give up the claim of a writer that died before it announced its version."""
    if version <= current_version(spark, root):
        raise ValueError(f"version {version} is announced")
    files, place = _file_system(spark, f"{root}/claims/v{version}")
    files.delete(place, False)


def manifest(spark: SparkSession, root: str, version: int) -> dict[str, int]:
    """For each partition the version whose folder holds it. One entry per partition."""
    rows = spark.read.schema(f"{PART} string, version int").json(f"{root}/manifests/v{version}")
    return {row[PART]: row["version"] for row in rows.collect()}


def read_partitions(spark: SparkSession, root: str, only: Sequence[str] | None = None) -> DataFrame | None:
    """The current version with the columns ``_part`` and ``_version``, or None; ``only`` some partitions."""
    version = current_version(spark, root)
    if not version:
        return None
    places = manifest(spark, root, version)
    merged = None
    for folder in sorted(set(places.values())):
        wanted = [p for p, v in places.items() if v == folder and (only is None or p in only)]
        data = spark.read.schema(_schema(spark, root, folder)).parquet(f"{root}/data/v{folder}")
        part = data.filter(F.col(PART).isin(wanted)).withColumn("_version", F.lit(folder))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged


def _schema(spark: SparkSession, root: str, folder: int):
    """A folder's own schema, with the partition as text whatever its values look like."""
    found = spark.read.parquet(f"{root}/data/v{folder}").drop(PART).schema
    return found.add(PART, "string")


def merge_partitions(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    mark: str,
    partition: Column,
    tie_break: Sequence[Column] = (),
) -> int:
    """One incremental run: rows past the highest mark, one per key, merged into the partitions they touch.

    A key may move: the partition that held it is rewritten as well. Running again without new rows announces
    a version that writes no partition.
    """
    spark = source.sparkSession
    version = claim(spark, root)
    source = source.withColumn(PART, F.coalesce(partition.cast("string"), F.lit(NO_VALUE)))
    old = read_partitions(spark, root)
    places = manifest(spark, root, version - 1) if old is not None else {}
    if old is None:
        touched, merged = None, source
    else:
        batch = materialize(latest_per_key(newer_rows(source, old, mark), keys, [F.col(mark).desc(), *tie_break]), "batch")
        left = old.join(batch.select(*keys), list(keys), "left_semi").select(PART)  # partitions that keys are in now
        # One value per partition that is rewritten.
        touched = sorted(row[0] for row in batch.select(PART).unionByName(left).distinct().collect())
        before = read_partitions(spark, root, touched).drop("_version")
        merged = merge_by_key(before, batch, keys)
    if touched is None or touched:
        # Rebalanced on the partition: a large one is written by several tasks, a small one by one.
        merged.hint("rebalance", PART).write.partitionBy(PART).mode("overwrite").parquet(f"{root}/data/v{version}")
        written = spark.read.parquet(f"{root}/data/v{version}").select(F.col(PART).cast("string")).distinct()
        places = {p: v for p, v in places.items() if p not in (touched or ())}
        places |= {row[0]: version for row in written.collect()}
    rows = spark.createDataFrame(sorted(places.items()), f"{PART} string, version int")
    rows.coalesce(1).write.mode("overwrite").json(f"{root}/manifests/v{version}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").json(f"{root}/published")
    return version


def forget_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete partitions that none of the last ``keep`` versions refers to; returns their folders."""
    last = current_version(spark, root)
    used = {(v, p) for n in range(max(1, last - keep + 1), last + 1) for p, v in manifest(spark, root, n).items()}
    gone = []
    for folder in range(1, last + 1):
        files, place = _file_system(spark, f"{root}/data/v{folder}")
        if not files.exists(place):
            continue
        for entry in files.listStatus(place):
            name = entry.getPath().getName()
            if name.startswith(f"{PART}=") and (folder, unquote(name[len(PART) + 1 :])) not in used:
                files.delete(entry.getPath(), True)
                gone.append(f"v{folder}/{name}")
    return gone

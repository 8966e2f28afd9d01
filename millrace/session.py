"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)  # paths of the innermost ``settled``


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; extra settings override them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one in ``spark.checkpoint.dir``, else one in the warehouse.

    The warehouse (``spark.sql.warehouse.dir``) is on the default file system, which executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/intermediate").rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and freezes values that depend on how rows were partitioned, so that a lost
    executor cannot change them. Unlike ``checkpoint()`` the result is columnar: later stages read
    only the columns they use.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(build: Callable[[], DataFrame], label: str = "step") -> DataFrame:
    """``build()`` written to the shared folder; the intermediate tables that it made on the way are deleted.

    No other frame may depend on these.
    """
    made: list[str] = []
    outer = _made.set(made)
    try:
        df = build()
    finally:
        _made.reset(outer)
    result = materialize(df, label)
    for path in made:
        _delete(df.sparkSession, path)
    return result


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. Call it once no frame built on them is needed."""
    _delete(spark, f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}")


def stored_side(df: DataFrame) -> DataFrame:
    """Store a side of a join, so that its size in bytes is known: Catalyst broadcasts it if it is small."""
    return materialize(df, "side")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly for work that is heavy per row: a file with one row group is one task."""
    return df.hint("rebalance")

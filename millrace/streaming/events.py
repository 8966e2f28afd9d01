"""Streams: arriving event files, windowed metrics."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from millrace.functions.measures import average
from millrace.plans.features import event_rows

# Fixed value: length of a metric window.
METRIC_WINDOW = "5 minutes"


def arriving_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream over the ``.parquet`` files of a folder; other files are passed over."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_events(stream: DataFrame, out: str, checkpoint: str, **columns: Any) -> StreamingQuery:
    """Append new interactions to the event table, by day. Starting it again adds each file once."""
    return (
        event_rows(stream, **columns)
        .writeStream.format("parquet")
        .partitionBy("date")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def metric_windows(
    df: DataFrame,
    ts: str,
    metric: str,
    value: str,
    window: str = METRIC_WINDOW,
    late: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Average per metric and time window, for tables and (with ``late``) for streams."""
    zoned = df.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = zoned.withWatermark(ts, late) if late else zoned
    grouped = timed.groupBy(F.window(ts, window).alias("_w"), metric)
    return grouped.agg(average(value, scale).alias("average"), F.count(F.lit(1)).alias("samples")).select(
        F.col("_w.start").alias("window_start"), metric, "average", "samples"
    )


def write_windows(windows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append finished metric windows to a table."""
    return (
        windows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


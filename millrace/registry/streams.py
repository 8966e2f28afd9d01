"""Streams over the event file, run to completion, with the equal batch result as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.registry import query, table
from millrace.session import new_path
from millrace.streaming.events import append_events, arriving_files, metric_windows, write_windows

WINDOWS = """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE) / count(*) AS average,
       count(*) AS samples
FROM events GROUP BY 1, 2
"""


def _window_text(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("metric_5min", WINDOWS)
def metric_5min(spark: SparkSession, sf: str) -> DataFrame:
    return _window_text(metric_windows(table(spark, sf, "events"), "ts", "event_type", "value", scale=2))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event file, found by its name, as a stream of arriving files."""
    return arriving_files(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query(
    "stream_events",
    """
SELECT user_id, event_id AS item_id, value AS rating,
       CASE WHEN value >= 4 THEN 'positive_rating' WHEN value >= 3 THEN 'neutral_rating' ELSE 'negative_rating' END
         AS event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS date
FROM events
""",
)
def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving event files appended to the event table; started twice, each row is there once."""
    out, checkpoint = new_path(spark, "events"), new_path(spark, "checkpoint")
    columns = dict(user="user_id", item="event_id", rating="value", timestamp="ts")
    for _ in range(2):
        append_events(event_stream(spark, sf), out, checkpoint, **columns).awaitTermination()
    stored = spark.read.parquet(out)
    return stored.withColumn("date", F.col("date").cast("string")).drop("timestamp")


@query(
    "stream_metric_5min",
    f"""
SELECT * FROM ({WINDOWS}) WHERE CAST(window_start AS TIMESTAMP) + INTERVAL 5 MINUTE
  <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)
""",
)
def stream_metric_5min(spark: SparkSession, sf: str) -> DataFrame:
    """Metric windows of the stream that are closed: their end lies ten minutes behind the newest event."""
    out, checkpoint = new_path(spark, "windows"), new_path(spark, "checkpoint")
    windows = metric_windows(
        event_stream(spark, sf), "ts", "event_type", "value", late="10 minutes", scale=2
    )
    write_windows(windows, out, checkpoint).awaitTermination()
    return _window_text(spark.read.schema(windows.schema).parquet(out))

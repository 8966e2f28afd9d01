"""Sinks: partitioned Parquet with run metrics, tables and views, JSON reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import normalize_names


def write_parquet(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (),
    dataset: str = "",
    source: str = "",
    observe: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Overwrite a Parquet table and return its run metrics, counted during the write itself.

    Rows are rebalanced on the partition columns first: small partitions get few files, and a
    partition that holds a large share of the rows is still written by many tasks. ``observe`` adds
    aggregates to the metrics. ``partitions`` are counted in the stored table, from its folders' names.
    """
    run = Observation()
    metrics = [F.count(F.lit(1)).alias("row_count")]
    metrics += [value.alias(name) for name, value in (observe or {}).items()]
    # Observed behind the shuffle, in the writing tasks: a map task that runs again after a lost
    # executor must not be counted twice.
    rows = df.hint("rebalance", *by) if by else df
    writer = rows.observe(run, *metrics).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    found = {"dataset": dataset, "input_path": source, "output_path": path, **run.get}
    if by and found["row_count"]:
        # Partition columns are read from the listing; files are not opened for them.
        found["partitions"] = df.sparkSession.read.schema(df.schema).parquet(path).select(*by).distinct().count()
    elif by:
        found["partitions"] = 0
    return found


def write_splits(splits: Mapping[str, DataFrame], path: str) -> dict[str, Any]:
    """Write named splits as one table partitioned by ``split``."""
    tagged = [frame.withColumn("split", F.lit(name)) for name, frame in splits.items()]
    merged = tagged[0]
    for frame in tagged[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return write_parquet(merged, path, by=["split"])


def write_table(df: DataFrame, name: str, path: str | None = None, format: str = "parquet") -> None:
    """Create or replace a catalog table, its schema included. Use any table format the session knows."""
    writer = df.write.mode("overwrite").format(format).option("overwriteSchema", True)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def table_from_query(spark: SparkSession, sql: str, name: str, rule: str = "landing", path: str | None = None) -> None:
    """Create or replace a table from a query, its column names mapped by a name rule."""
    write_table(normalize_names(spark.sql(sql), rule), name, path)


def publish_layer(df: DataFrame, name: str, layer: str) -> None:
    """Staging models become views, marts become tables."""
    if layer == "staging":
        df.createOrReplaceTempView(name)
    elif layer == "marts":
        write_table(df, name)
    else:
        raise ValueError(f"unknown layer: {layer}")


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines: small ones are one file, large ones as many as they need."""
    report.hint("rebalance").write.mode("overwrite").json(path)


def write_metrics(spark: SparkSession, metrics: Mapping[str, Any], path: str) -> None:
    """Run metrics as a one-row JSON report. All values must be scalars or lists of scalars."""
    names = list(metrics)
    write_report(spark.createDataFrame([tuple(metrics[name] for name in names)], names), path)

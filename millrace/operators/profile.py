"""Table profiles."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import is_blank
from millrace.functions.timeparts import month_part, year_part


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """One row: all rows, and the distinct non-null values of each column as ``distinct_<column>``."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in columns],
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row with the number of rows that repeat an earlier one.

    Two 64-bit hashes of a row are shuffled instead of its columns. Rows are compared in full only among
    those whose hashes occur more than once, so equal hashes of unequal rows do no harm.
    """
    whole = F.struct(*[F.col(c) for c in df.columns])
    empty = [F.isnull(c) for c in df.columns]
    hashed = df.withColumns({"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit(1), *df.columns, *empty)})
    often = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    alike = hashed.join(often, ["_h1", "_h2"], "left_semi").groupBy("_h1", "_h2", whole.alias("_row"))
    counted = alike.agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def profile(df: DataFrame, null_checks: Sequence[str], day: str) -> DataFrame:
    """One row: rows, nulls per column, duplicate rows, first and last day.

    All but the duplicates is one pass that shuffles a row per task.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_checks],
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    ).select(
        "total_rows", *[f"null_{c}" for c in null_checks], duplicate_rows(df).scalar().alias("duplicate_rows"), "first_day", "last_day"
    )


def profile_alerts(profiled: DataFrame) -> DataFrame:
    """The profile's non-zero null counts as rows ``(column, rows)``."""
    nulls = [c for c in profiled.columns if c.startswith("null_")]
    pairs = [F.struct(F.lit(c[5:]).alias("column"), F.col(c).alias("rows")) for c in nulls]
    return profiled.select(F.inline(F.array(*pairs))).filter("rows > 0")


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def ingest_aggregates(key: str, date_text: str) -> dict[str, Column]:
    """Null or blank keys, and the sorted years (a set bounded by the calendar), as aggregates."""
    return {
        "null_or_blank_keys": F.count_if(is_blank(key)),
        "years": F.array_sort(F.collect_set(year_part(date_text))),
    }


def ingest_stats(df: DataFrame, key: str, date_text: str) -> DataFrame:
    """One row: rows and the ingest aggregates."""
    stats = ingest_aggregates(key, date_text)
    return df.agg(F.count(F.lit(1)).alias("rows"), *[value.alias(name) for name, value in stats.items()])


def rows_per_month(df: DataFrame, date_text: str) -> DataFrame:
    """Rows per year and month part; dates that do not parse form a part of their own."""
    parts = df.select(year_part(date_text).alias("year"), month_part(date_text).alias("month"))
    return parts.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


def dataset_rows(spark: SparkSession, path: str) -> int:
    """Row count of a Parquet folder from its footers; a missing or empty folder is an error."""
    scan = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return scan.parquet(path).count()


def table_inventory(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """Rows ``(table, rows)`` for the catalog's tables and views that match a pattern, by name."""
    names = sorted(t.name for t in spark.catalog.listTables(pattern=pattern))
    if not names:
        return spark.createDataFrame([], "table string, rows long")
    counts = [
        spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name in names
    ]
    merged = counts[0]
    for one in counts[1:]:
        merged = merged.unionByName(one)
    return merged.orderBy("table")


def _like(pattern: str) -> re.Pattern:
    """A case-blind name pattern where ``%`` stands for any text and ``_`` for one character."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(c, re.escape(c)) for c in pattern), re.IGNORECASE | re.DOTALL)


def schema_inventory(spark: SparkSession, schema_pattern: str, name_pattern: str) -> DataFrame:
    """Rows ``(schema, table, rows)``, by schema and name, of the tables and views whose schema or name matches.

    All schemas of the catalog are searched. Temporary views have the empty schema.
    """
    listed = [(d.name, t) for d in spark.catalog.listDatabases() for t in spark.catalog.listTables(d.name)]
    found = {("" if t.isTemporary else schema, t.name) for schema, t in listed}
    schema_fits, name_fits = _like(schema_pattern).fullmatch, _like(name_pattern).fullmatch
    merged = spark.createDataFrame([], "schema string, table string, rows long")
    for schema, name in sorted(found):
        if schema_fits(schema) or name_fits(name):
            rows = spark.table(f"`{schema}`.`{name}`" if schema else f"`{name}`").agg(F.count(F.lit(1)).alias("rows"))
            merged = merged.unionByName(rows.select(F.lit(schema).alias("schema"), F.lit(name).alias("table"), "rows"))
    return merged.orderBy("schema", "table")

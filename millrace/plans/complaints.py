"""Complaints: staging, marts, incremental fact, ingest."""

from __future__ import annotations

import time
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import blank_to_null, safe_date, safe_timestamp, yes_no_flag
from millrace.functions.measures import rate
from millrace.functions.timeparts import month_part, month_start, year_part
from millrace.operators.merge import run_incremental
from millrace.operators.profile import ingest_aggregates
from millrace.operators.quality import MAX_NULL_KEY_SHARE, DataTestFailure
from millrace.sources.writers import write_metrics, write_parquet

# Staged columns by treatment, and the columns of the incremental fact.
CLEANED = [
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "company",
    "state",
    "zip_code",
    "submitted_via",
    "company_response_to_consumer",
]
DATES = ["date_received", "date_sent_to_company"]
UNTOUCHED = ["consumer_complaint_narrative"]
FLAGS = {"timely_response": "timely_response_flag", "consumer_disputed": "consumer_disputed_flag"}
LINEAGE_NAMES = {"filename": "_source_file", "loaded_at": "_loaded_at"}
FACT_COLUMNS = [
    "complaint_id",
    "date_received",
    "product",
    "sub_product",
    "issue",
    "company",
    "state",
    "submitted_via",
    "timely_response_flag",
    "consumer_disputed_flag",
    "_loaded_at",
]


def stage(
    typed: DataFrame,
    key: str = "complaint_id",
    cleaned: list[str] = CLEANED,
    dates: list[str] = DATES,
    flags: Mapping[str, str] = FLAGS,
    untouched: list[str] = UNTOUCHED,
    lineage: Mapping[str, str] = LINEAGE_NAMES,
) -> DataFrame:
    """Typed, cleaned rows with a key. Listed columns the input lacks are left out."""
    have = set(typed.columns)
    chosen: dict[str, Column] = {key: F.col(key)}
    chosen |= {c: safe_date(c) for c in dates if c in have}
    chosen |= {c: blank_to_null(c) for c in cleaned if c in have}
    chosen |= {c: F.col(c) for c in untouched if c in have}
    chosen |= {flag: yes_no_flag(c) for c, flag in flags.items() if c in have}
    chosen |= {new: F.col(c) for c, new in lineage.items() if c in have}
    return typed.filter(F.col(key).isNotNull()).select(*[value.alias(n) for n, value in chosen.items()])


def product_month_mart(
    staged: DataFrame,
    day: str = "date_received",
    product: str = "product",
    company: str = "company",
    timely: str = "timely_response_flag",
    disputed: str = "consumer_disputed_flag",
) -> DataFrame:
    """Volume, companies, untimely and disputed complaints per month and product."""
    return (
        staged.filter(F.col(day).isNotNull() & F.col(product).isNotNull())
        .groupBy(month_start(day).alias("month_start"), F.col(product).alias("product"))
        .agg(
            F.count(F.lit(1)).alias("complaint_count"),
            F.count_distinct(company).alias("company_count"),
            F.count_if(~F.col(timely)).alias("untimely_count"),
            F.count_if(disputed).alias("disputed_count"),
            rate(F.count_if(disputed), F.count(F.lit(1))).alias("dispute_rate"),
        )
    )


def company_product_mart(
    staged: DataFrame,
    day: str = "date_received",
    product: str = "product",
    company: str = "company",
    timely: str = "timely_response_flag",
    disputed: str = "consumer_disputed_flag",
) -> DataFrame:
    """Volume, flags and first and last day per company and product. A null flag counts nowhere."""
    return (
        staged.filter(F.col(company).isNotNull() & F.col(product).isNotNull())
        .groupBy(F.col(company).alias("company"), F.col(product).alias("product"))
        .agg(
            F.count(F.lit(1)).alias("complaint_count"),
            F.count_if(timely).alias("timely_yes"),
            F.count_if(~F.col(timely)).alias("timely_no"),
            F.count_if(disputed).alias("disputed"),
            F.min(day).alias("first_complaint_date"),
            F.max(day).alias("last_complaint_date"),
        )
    )


def ranked_counts(
    df: DataFrame, day: str, product: str, keep_null_keys: bool = True, rows: int | None = None
) -> DataFrame:
    """Complaints per product and month, largest first; ties by product and month.

    ``keep_null_keys`` keeps rows without product or date text as groups of their own. ``rows`` makes
    it a preview of the largest groups.
    """
    kept = df if keep_null_keys else df.filter(F.col(day).isNotNull() & F.col(product).isNotNull())
    counts = kept.groupBy(
        F.col(product).alias("product"),
        F.date_trunc("month", safe_timestamp(day)).alias("month_start"),
    ).agg(F.count(F.lit(1)).alias("complaint_count"))
    ranked = counts.orderBy(
        F.desc("complaint_count"), F.asc_nulls_last("product"), F.asc_nulls_last("month_start")
    )
    return ranked if rows is None else ranked.limit(rows)


def optional_counts(df: DataFrame, day: str, product: str) -> DataFrame | None:
    """``ranked_counts``, or None where the input lacks a column it needs."""
    if {day, product} - set(df.columns):
        return None
    return ranked_counts(df, day, product)


def fact_rows(staged: DataFrame) -> DataFrame:
    """Rows of the incremental fact, stamped with the build time."""
    return staged.select(*FACT_COLUMNS, F.current_timestamp().alias("_built_at"))


def build_fact(staged: DataFrame, root: str) -> int:
    """Build or update the incremental fact under ``root``; returns the published version."""
    return run_incremental(
        fact_rows(staged), root, ["complaint_id"], "_loaded_at", [F.col(c) for c in FACT_COLUMNS]
    )


def ingest(
    rows: DataFrame,
    out: str,
    key: str = "Complaint ID",
    date_text: str = "Date received",
    skip_existing: bool = False,
    manifest_path: str | None = None,
) -> dict[str, Any] | None:
    """Write text rows as a Hive-style ``year=/month=`` table and its manifest beside it; return the manifest.

    Everything the manifest says is observed during the one write. An empty table or too many rows
    without a key is an error. With ``skip_existing`` nothing is written, but the table must be
    there: None is returned.
    """
    if skip_existing:
        if rows.sparkSession.read.parquet(out).isEmpty():
            raise DataTestFailure(f"ingest is to be skipped but there is no data under {out}")
        return None
    started = time.time()
    parts = rows.withColumns({"year": year_part(date_text), "month": month_part(date_text)})
    stats = ingest_aggregates(key, date_text)
    manifest = write_parquet(parts, out, ["year", "month"], "complaints", observe=stats)
    keyless = manifest["null_or_blank_keys"]
    if manifest["row_count"] == 0 or keyless > manifest["row_count"] * MAX_NULL_KEY_SHARE:
        raise DataTestFailure(f"{keyless} of {manifest['row_count']} rows written have no key")
    manifest["elapsed_sec"] = round(time.time() - started, 1)
    write_metrics(rows.sparkSession, manifest, manifest_path or f"{out.rstrip('/')}.manifest")
    return manifest

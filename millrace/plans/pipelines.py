"""Step sequences: raw files to tested tables, and features to a saved model. A scheduler may call them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import variant_text
from millrace.operators.dedup import dedup_landing
from millrace.operators.quality import (
    PRODUCTS,
    assert_contract,
    column_tests,
    combine,
    contract,
    enforce,
    not_empty_test,
    unique_test,
)
from millrace.operators.ranking import with_rank
from millrace.plans.complaints import build_fact, company_product_mart, ingest, product_month_mart, stage
from millrace.plans.features import MIN_WINE_ROWS, gate_features, run_wine
from millrace.plans.training import save_model, settings_used, train_and_evaluate
from millrace.session import materialize
from millrace.sources.landing import COMPLAINT_SPELLINGS, land_parquet, typed_view
from millrace.sources.readers import apply_null_tokens, read_text_csv, split_malformed
from millrace.sources.writers import publish_layer, write_report


def staging_tests(staged: DataFrame) -> DataFrame:
    """Key present and unique, day present; an unknown product is a warning."""
    return combine(
        column_tests(staged, ["complaint_id", "date_received"], {"product": PRODUCTS}),
        unique_test(staged, "complaint_id"),
    )


def mart_tests(by_month: DataFrame, by_company: DataFrame) -> DataFrame:
    """Group keys and counts present; the monthly mart is not empty."""
    return combine(
        column_tests(by_month, ["month_start", "product", "complaint_count"]),
        column_tests(by_company, ["company", "product", "complaint_count"]),
        not_empty_test(by_month, "product_month"),
    )


def complaints_pipeline(
    spark: SparkSession, csv_path: str, root: str, loaded_at: Column | None = None
) -> dict[str, Any]:
    """CSV to Parquet, landing, contract, staging view, two mart tables, incremental fact, and their tests.

    Stops at the first broken gate. Returns the ingest manifest, the number of malformed lines and
    the version of the fact.
    """
    # Stored, so that the lines are parsed once for the rows, the manifest and the count of bad ones.
    good, malformed = split_malformed(materialize(read_text_csv(spark, csv_path), "lines"))
    manifest = ingest(apply_null_tokens(good), f"{root}/parquet")

    landed = materialize(land_parquet(spark, f"{root}/parquet", loaded_at), "landing")
    counts = contract("complaints", spark.read.parquet(f"{root}/parquet"), landed)
    write_report(counts, f"{root}/contract")
    assert_contract(counts)

    key = variant_text("src", *COMPLAINT_SPELLINGS["complaint_id"])
    staged = materialize(stage(typed_view(dedup_landing(landed, key))), "staged")
    publish_layer(staged, "stg_complaints", "staging")
    enforce(staging_tests(staged))

    by_month, by_company = product_month_mart(staged), company_product_mart(staged)
    publish_layer(by_month, "complaints_by_product_month", "marts")
    publish_layer(by_company, "complaints_by_company_product", "marts")
    enforce(
        mart_tests(spark.table("complaints_by_product_month"), spark.table("complaints_by_company_product"))
    )
    version = build_fact(staged, f"{root}/fact")
    return {**manifest, "malformed": malformed.count(), "fact_version": version}


def wine_pipeline(
    spark: SparkSession,
    csv_path: str,
    root: str,
    name: str = "quality-tiers",
    min_rows: int = MIN_WINE_ROWS,
    **settings: Any,
) -> dict[str, Any]:
    """CSV to feature table, row-count gate, model and metadata. Returns run and model metrics."""
    metrics = run_wine(spark, csv_path, f"{root}/features")
    features = gate_features(spark.read.parquet(f"{root}/features"), "wine", min_rows)
    # Wines have no key of their own: their place in the order of all columns is one. Equal rows are
    # alike whichever of them comes first, so files and cores do not change the split.
    keyed = materialize(with_rank(features, features.columns, "row_id"), "wines")
    model, quality, report = train_and_evaluate(keyed, ["row_id"], **settings)
    write_report(report, f"{root}/classification_report")
    save_model(spark, model, f"{root}/model", name, quality, settings_used(**settings))
    return {**metrics, **quality}

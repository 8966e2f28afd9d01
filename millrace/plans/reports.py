"""Report jobs: drift of a table, evaluation of recorded answers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import require_columns
from millrace.functions.text import CITATION_TYPE
from millrace.plans.documents import evaluate_cases, evaluation_report, report_cases
from millrace.plans.drift import drift_report, drift_summary
from millrace.plans.training import WINE_FEATURES
from millrace.session import materialize
from millrace.sources.readers import read_cases, read_current
from millrace.sources.writers import write_report

ANSWER_SCHEMA = (
    f"id string, answer string, guardrail_action string, citations {CITATION_TYPE}, latency_ms double"
)


def report_drift(
    spark: SparkSession,
    reference_path: str,
    current_path: str | None,
    out: str,
    features: Sequence[str] = WINE_FEATURES,
) -> bool:
    """Write the drift per feature and a stamped summary; returns whether the table has drifted."""
    reference = require_columns(spark.read.parquet(reference_path), features)
    current = require_columns(read_current(spark, current_path, reference), features)
    report = materialize(drift_report(reference, current, features), "drift")
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    summary = drift_summary(report).withColumn("timestamp", F.lit(stamp))
    write_report(report, f"{out}/features")
    write_report(summary, f"{out}/summary")
    return summary.first().dataset_drift


def report_evaluation(spark: SparkSession, cases_path: str, answers_path: str, out: str) -> bool:
    """Judge recorded answers by their cases, write both report parts; returns whether the gate is passed.

    A case without an answer is judged as an empty answer.
    """
    answers = spark.read.json(answers_path, schema=ANSWER_SCHEMA)
    judged = materialize(evaluate_cases(read_cases(spark, cases_path).join(answers, "id", "left")), "judged")
    rates = evaluation_report(judged)
    write_report(report_cases(judged), f"{out}/cases")
    write_report(rates, f"{out}/metrics")
    return rates.first().gate

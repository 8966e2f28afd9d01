"""Jobs from the command line: ``python -m millrace JOB --input ... --output ...``.

For a cluster, package the folder and submit this module with ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from typing import Any

from pyspark.sql import SparkSession

from millrace.plans.features import run_events, run_items, run_trips, run_wine
from millrace.plans.pipelines import complaints_pipeline, wine_pipeline
from millrace.plans.reports import report_drift, report_evaluation
from millrace.session import build_session, drop_intermediates
from millrace.sources.readers import read_splits
from millrace.sources.writers import write_metrics


def _events(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    return run_events(read_splits(spark, args.input), args.output, epoch_unit=args.epoch_unit)


def _items(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    return run_items(spark.read.parquet(args.input), args.output)


def _drift(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    return {"dataset_drift": report_drift(spark, args.input, args.current, args.output)}


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    return {"failed": not report_evaluation(spark, args.input, args.answers, args.output)}


JOBS = {
    "wine": lambda spark, args: run_wine(spark, args.input, args.output),
    "taxi": lambda spark, args: run_trips(spark, args.input, args.output),
    "events": _events,
    "items": _items,
    "complaints": lambda spark, args: complaints_pipeline(spark, args.input, args.output),
    "train": lambda spark, args: wine_pipeline(spark, args.input, args.output, boosted=not args.forest),
    "drift": _drift,
    "evaluate": _evaluate,
}


def parse(argv: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace", description="Run a data job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--input", required=True, help="raw data, reference table, or evaluation cases")
    parser.add_argument("--output", required=True)
    parser.add_argument("--master", help="leave out under spark-submit")
    parser.add_argument("--metrics", help="folder for the run metrics")
    parser.add_argument("--current", help="drift: table to compare; a sample of the reference if left out")
    parser.add_argument("--answers", help="evaluate: recorded answers, JSON lines")
    parser.add_argument("--epoch-unit", choices=["s", "ms", "us"], help="events: unit of numeric timestamps")
    parser.add_argument("--forest", action="store_true", help="train: a forest instead of boosted trees")
    args = parser.parse_args(argv)
    if args.job == "evaluate" and not args.answers:
        parser.error("evaluate needs --answers")
    return args


def main(argv: Sequence[str], spark: SparkSession | None = None) -> int:
    """Run one job, print its metrics, and return 1 if it reports a failed gate."""
    args = parse(argv)
    session = spark or build_session(f"millrace-{args.job}", args.master)
    try:
        metrics = JOBS[args.job](session, args)
        print(json.dumps(metrics, indent=2, default=str))
        if args.metrics:
            write_metrics(session, metrics, args.metrics)
    finally:
        if spark is None:
            drop_intermediates(session)
            session.stop()
    return int(bool(metrics.get("failed")))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

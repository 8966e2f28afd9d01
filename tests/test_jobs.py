import json

import pytest
from pyspark.sql import functions as F

from millrace.__main__ import main, parse
from millrace.plans.training import WINE_FEATURES
from millrace.session import drop_intermediates, materialize, shared_dir
from millrace.sources.readers import WINE_COLUMNS


def test_wine_job_writes_metrics(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = "7.4;0.7;0;1.9;0.076;11;34;0.9978;3.51;0.56;9.4;5"
    (tmp_path / "in" / "red.csv").write_text("\n".join([";".join(WINE_COLUMNS), row, row]) + "\n")
    args = ["wine", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--metrics", str(tmp_path / "m")]
    assert main(args, spark) == 0
    stored = spark.read.json(str(tmp_path / "m")).first()
    assert stored.row_count == 2 and stored.partitions == 1 and stored.dataset == "wine"


def test_events_and_items_jobs(spark, tmp_path):
    raw = spark.createDataFrame(
        [("u", "i", 3.5, 1704067200000)], "user_id string, parent_asin string, rating double, timestamp long"
    )
    for split in ("train", "valid", "test"):
        raw.write.parquet(str(tmp_path / "in" / split))
    args = ["events", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--epoch-unit", "ms"]
    assert main(args, spark) == 0
    days = spark.read.parquet(str(tmp_path / "out")).groupBy("date", "event_type").count().collect()
    assert [(str(r.date), r.event_type, r["count"]) for r in days] == [("2024-01-01", "neutral_rating", 3)]


def test_drift_job(spark, tmp_path):
    values = spark.range(200).select(*[(F.col("id") % 50).cast("double").alias(c) for c in WINE_FEATURES])
    values.write.parquet(str(tmp_path / "ref.parquet"))
    moved = values.withColumns({c: F.col(c) + 30 for c in WINE_FEATURES})
    moved.write.parquet(str(tmp_path / "cur.parquet"))
    args = ["drift", "--input", str(tmp_path / "ref.parquet"), "--current", str(tmp_path / "cur.parquet")]
    assert main([*args, "--output", str(tmp_path / "out")], spark) == 0
    assert spark.read.json(str(tmp_path / "out" / "features")).filter("drifted").count() == 12
    summary = spark.read.json(str(tmp_path / "out" / "summary")).first()
    assert (summary.reference_rows, summary.current_rows, summary.dataset_drift) == (200, 200, True)


@pytest.mark.parametrize("answer,code", [("26 weeks", 0), ("no idea", 1)])
def test_evaluation_job(spark, tmp_path, answer, code):
    cases = [{"id": "a", "question": "?", "expected_keywords": ["26"], "category": "hr"},
             {"id": "guardrail_block", "question": "!", "expect_blocked": True, "category": "safety"}]
    uri = {"location": {"s3Location": {"uri": "s3://b/k"}}}
    answers = [{"id": "a", "answer": answer, "guardrail_action": "NONE", "latency_ms": 5.0,
                "citations": [{"retrievedReferences": [uri]}]},
               {"id": "guardrail_block", "answer": "", "guardrail_action": "INTERVENED", "latency_ms": 7.0}]
    (tmp_path / "cases.json").write_text(json.dumps(cases))
    (tmp_path / "answers.json").write_text("\n".join(json.dumps(a) for a in answers))
    args = ["evaluate", "--input", str(tmp_path / "cases.json"), "--answers", str(tmp_path / "answers.json")]
    assert main([*args, "--output", str(tmp_path / "out")], spark) == code
    metrics = spark.read.json(str(tmp_path / "out" / "metrics")).first()
    assert metrics.cases == 2 and metrics.citation_rate == 0.5 and metrics.avg_latency_ms == 6.0
    assert metrics.gate is (code == 0)


def test_arguments():
    with pytest.raises(SystemExit):
        parse(["evaluate", "--input", "x", "--output", "y"])
    with pytest.raises(SystemExit):
        parse(["unknown", "--input", "x", "--output", "y"])


def test_intermediates_can_be_dropped(spark):
    stored = materialize(spark.range(3))
    assert stored.count() == 3
    other = spark.newSession()
    assert shared_dir(other) == shared_dir(spark)
    drop_intermediates(spark)
    with pytest.raises(Exception):
        spark.read.parquet(stored.inputFiles()[0]).count()

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.merge import read_current
from millrace.operators.quality import DataTestFailure
from millrace.plans.pipelines import complaints_pipeline, wine_pipeline
from millrace.sources.landing import COMPLAINT_SPELLINGS
from millrace.sources.readers import WINE_COLUMNS

HEADER = [names[0] for names in COMPLAINT_SPELLINGS.values()]


def _line(key, product="Mortgage", day="2024-01-15"):
    values = dict.fromkeys(HEADER, "")
    values |= {"Complaint ID": key, "Product": product, "Date received": day, "Company": "Bank A",
               "Timely response?": "Yes", "Consumer disputed?": "N/A"}
    return ",".join(f'"{v}"' for v in values.values())


def _csv(path, lines):
    path.write_text("\n".join([",".join(f'"{h}"' for h in HEADER), *lines]) + "\n")
    return str(path)


def test_complaints(spark, tmp_path):
    lines = [_line(str(i), "Mortgage" if i % 2 else "Debt collection") for i in range(200)]
    path = _csv(tmp_path / "c.csv", [*lines, _line("7"), _line("300") + ",surplus"])
    loaded = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    result = complaints_pipeline(spark, path, str(tmp_path / "out"), loaded)
    assert (result["row_count"], result["malformed"], result["fact_version"]) == (201, 1, 1)
    months = {r.product: r for r in spark.table("complaints_by_product_month").collect()}
    assert months["Mortgage"].complaint_count == 100 and months["Mortgage"].company_count == 1
    assert months["Mortgage"].disputed_count == 0 and months["Mortgage"].dispute_rate == 0.0
    assert spark.table("stg_complaints").count() == 200
    assert read_current(spark, str(tmp_path / "out" / "fact")).count() == 200
    assert spark.read.json(str(tmp_path / "out" / "contract")).first().status == "PASS"


def test_complaints_without_dates_stop(spark, tmp_path):
    path = _csv(tmp_path / "c.csv", [_line("1"), _line("2", day="soon")])
    with pytest.raises(DataTestFailure, match="date_received"):
        complaints_pipeline(spark, path, str(tmp_path / "out"))


def test_wine(spark, tmp_path):
    rng = random.Random(9)
    folder = tmp_path / "wine"
    folder.mkdir()
    for color in ("red", "white"):
        rows = []
        for _ in range(120):
            alcohol = rng.uniform(8, 14)
            quality = 5 if alcohol < 10 else 7 if alcohol < 12 else 8
            rows.append(f"7.4;0.7;0.1;1.9;0.07;11;34;0.9978;3.5;0.56;{alcohol:.2f};{quality}")
        (folder / f"winequality-{color}.csv").write_text("\n".join([";".join(WINE_COLUMNS), *rows]) + "\n")
    result = wine_pipeline(spark, str(folder), str(tmp_path / "out"), min_rows=240, trees=5, depth=4)
    assert result["row_count"] == 240 and result["partitions"] == 2 and result["accuracy"] > 0.9
    assert spark.read.json(str(tmp_path / "out" / "model" / "metadata")).first().model_name == "quality-tiers"
    assert spark.read.json(str(tmp_path / "out" / "classification_report")).count() == 3
    with pytest.raises(DataTestFailure):
        wine_pipeline(spark, str(folder), str(tmp_path / "out2"), min_rows=241)

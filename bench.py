"""Time the registered queries and print one JSON line.

Settings by environment: BENCH_SF_DIR, BENCH_CPUS, and BENCH_QUERIES (comma-separated names; all by
default). Each result is fully computed and dropped (``noop`` sink). Short queries are run three times and
count with their median; intermediate tables are deleted after each query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.registry import load_all  # noqa: E402
from millrace.session import build_session, drop_intermediates  # noqa: E402

AGAIN_BELOW = 2.5  # seconds; a longer query is timed once


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            # One machine, so its own folder is shared by all tasks.
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_all()[0]
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(queries)
    run(queries["mart_product_month"](spark, sf_dir))  # start-up and first compilation are not timed
    times: dict[str, float] = {}
    for name in names:
        taken: list[float] = []
        while len(taken) < 3 and (not taken or taken[0] < AGAIN_BELOW):
            start = time.perf_counter()
            run(queries[name](spark, sf_dir))
            taken.append(time.perf_counter() - start)
            drop_intermediates(spark)
        times[name] = round(median(taken), 3)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(match.group(1)) if match else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

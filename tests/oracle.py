"""Run registered queries beside their SQL on DuckDB and compare all values.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str, query, sql: str | None) -> tuple[str, int]:
    """``("match" | "rows-only" | difference, row count)``."""
    frame = query(spark, sf_dir)
    columns = frame.columns
    mine = frame.collect()
    if sql is None:
        return "rows-only", len(mine)
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} != {sorted(expected_columns)}", len(mine)
    a, b = rows_of(columns, mine), rows_of(expected_columns, expected)
    if a == b:
        kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
        types = dict(zip(expected_columns, [str(d[1]) for d in result.description]))
        odd = {c: (kinds[c], types[c]) for c in columns if not _same_kind(kinds[c], types[c])}
        return ("match" if not odd else f"match, types differ {odd}"), len(mine)
    left, right = list((a - b).items())[:3], list((b - a).items())[:3]
    gap = f"{sum((a - b).values())} only here, {sum((b - a).values())} only in SQL"
    return f"{gap}: {str(left)[:700]} vs {str(right)[:700]}", len(mine)


PAIRS = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR", "STRING"},
    "boolean": {"BOOLEAN", "bool"},
}


def _same_kind(mine: str, theirs: str) -> bool:
    return theirs in PAIRS.get(mine, {theirs})


def main(args: list[str]) -> None:
    from millrace.registry import load_all
    from millrace.session import build_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    queries, sql = load_all()
    names = args[1:] or list(queries)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            verdict, rows = compare(spark, con, name, sf_dir, queries[name], sql.get(name))
        except Exception as error:  # noqa: BLE001
            verdict, rows = f"ERROR {type(error).__name__}: {str(error)[:1500]}", -1
        bad += not verdict.startswith(("match", "rows-only"))
        print(f"{name:28s} {rows:8d} rows {time.time() - start:6.2f} s  {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])

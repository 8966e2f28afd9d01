"""Profiles and data tests on events, orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.profile import (
    distinct_counts,
    ingest_stats,
    profile,
    profile_alerts,
    rows_per_month,
    schema_inventory,
    table_inventory,
    value_distribution,
)
from millrace.operators.quality import (
    column_tests,
    combine,
    contract,
    expected_count_test,
    freshness_test,
    key_share_test,
    not_empty_test,
    repeated_keys,
    row_count_test,
    unique_test,
)
from millrace.operators.sketches import DISTINCT_ERROR, RANK_ERROR, daily_sketches, range_summary
from millrace.registry import query, table
from millrace.session import materialize, new_path
from millrace.sources.landing import land_parquet


@query(
    "events_profile",
    """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
       count(*) FILTER (WHERE label IS NULL) AS null_label, count(*) - count(DISTINCT (user_id, label, day))
         AS duplicate_rows, min(day) AS first_day, max(day) AS last_day
FROM (SELECT user_id, nullif(event_type, 'error') AS label, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events)
""",
)
def events_profile(spark: SparkSession, sf: str) -> DataFrame:
    """User, type and day of every event; an error counts as a missing type."""
    return profile(_labelled(spark, sf), ["user_id", "label"], "day")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "user_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("label"),
        F.to_date("ts").cast("string").alias("day"),
    )


@query(
    "profile_alerts",
    """SELECT 'label' AS "column", count(*) AS rows FROM events WHERE event_type = 'error' HAVING count(*) > 0""",
)
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return profile_alerts(events_profile(spark, sf))


@query(
    "events_distinct",
    """
SELECT count(*) AS total_rows, count(DISTINCT user_id) AS distinct_user_id,
       count(DISTINCT props) AS distinct_props, count(DISTINCT CAST(ts AS DATE)) AS distinct_day FROM events
""",
)
def events_distinct(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return distinct_counts(events, "user_id", "props", "day")


@query(
    "value_distribution",
    "SELECT label, count(*) AS rows FROM (SELECT nullif(event_type, 'error') AS label FROM events) "
    "WHERE label IS NOT NULL GROUP BY 1",
)
def distribution(spark: SparkSession, sf: str) -> DataFrame:
    return value_distribution(_labelled(spark, sf), "label")


def _order_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as text rows: no date for failed orders, a blank key for unspecified priority."""
    date = F.col("o_orderdate").cast("date").cast("string")
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("  "))
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("key_text"),
        F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(date).alias("date_text"),
    )


@query(
    "ingest_stats",
    """
SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS null_or_blank_keys,
       string_agg(DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE CAST(year(o_orderdate) AS VARCHAR) END,
                  ',' ORDER BY CASE WHEN o_orderstatus = 'F' THEN 'unknown'
                                    ELSE CAST(year(o_orderdate) AS VARCHAR) END) AS years
FROM orders
""",
)
def stats(spark: SparkSession, sf: str) -> DataFrame:
    counted = ingest_stats(_order_text(spark, sf), "key_text", "date_text")
    return counted.withColumn("years", F.array_join("years", ","))


@query(
    "rows_per_month",
    """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
       CASE WHEN o_orderstatus = 'F' THEN '00' ELSE lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') END AS month,
       count(*) AS rows
FROM orders GROUP BY 1, 2
""",
)
def per_month(spark: SparkSession, sf: str) -> DataFrame:
    return rows_per_month(_order_text(spark, sf), "date_text")


NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@query(
    "table_inventory",
    " UNION ALL ".join(f"SELECT 'given_{n}' AS \"table\", count(*) AS rows FROM {n}" for n in NAMES),
)
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """All given tables as catalog views, with their row counts."""
    for name in NAMES:
        table(spark, sf, name).createOrReplaceTempView(f"given_{name}")
    return table_inventory(spark, "given_*")


@query(
    "schema_inventory",
    " UNION ALL ".join(
        f"SELECT 'inventory_marts' AS schema, '{n}' AS \"table\", count(*) AS rows FROM {n}" for n in ("nation", "region")
    )
    + " UNION ALL SELECT 'inventory_staging', 'fct_customer', count(*) FROM customer",
)
def inventory_of_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Given tables in two schemas: those of the mart schema, and fact tables elsewhere."""
    places = {"inventory_marts": ["nation", "region"], "inventory_staging": ["fct_customer", "stg_supplier"]}
    for schema, names in places.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        for name in names:
            # External tables over files that this application's ``drop_intermediates`` removes.
            path = new_path(spark, name)
            table(spark, sf, name.split("_")[-1]).write.parquet(path)
            spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
            spark.catalog.createTable(f"{schema}.{name}", path, "parquet")
    found = materialize(schema_inventory(spark, "inventory_mart%", "FCT_%"), "inventory")
    for schema in places:
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    return found.filter(F.col("schema").startswith("inventory_"))


@query(
    "sketch_ranges",
    """
WITH r AS (
  SELECT * FROM (VALUES ('day', '2024-01-03', '2024-01-03'), ('week', '2024-01-08', '2024-01-14'), ('all', '2024-01-01', '2024-12-31'))
    AS v("range", first, last)
)
SELECT "range", count(*) AS rows, count(DISTINCT user_id) AS exact_distinct, true AS distinct_within, true AS ranks_within
FROM r JOIN events e ON strftime(e.ts, '%Y-%m-%d') BETWEEN r.first AND r.last GROUP BY 1
""",
)
def sketch_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Users and value quantiles of ranges of days from stored sketches, held against the raw rows: distinct counts
    within three standard errors, the ranks of the quantiles within twice their bound."""
    events = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    rows = [("day", "2024-01-03", "2024-01-03"), ("week", "2024-01-08", "2024-01-14"), ("all", "2024-01-01", "2024-12-31")]
    ranges = spark.createDataFrame(rows, "range string, first string, last string")
    stored = materialize(daily_sketches(events, F.col("day"), "user_id", "value"), "sketches")
    shares = (0.5, 0.95)
    found = materialize(range_summary(stored, ranges, shares), "ranges")
    met = [F.when(F.col("day").between(first, last), name) for name, first, last in rows]  # a row may be in several
    raw = events.withColumn("range", F.explode(F.array_compact(F.array(*met))))
    raw = raw.join(F.broadcast(found.select("range", "quantiles")), "range")
    # A value's rank is a span where others are equal to it.
    below = [F.avg((F.col("value") < F.col("quantiles")[i]).cast("double")).alias(f"_below{i}") for i in range(len(shares))]
    upto = [F.avg((F.col("value") <= F.col("quantiles")[i]).cast("double")).alias(f"_upto{i}") for i in range(len(shares))]
    exact = raw.groupBy("range").agg(F.count_distinct("user_id").alias("exact_distinct"), *below, *upto)
    near = F.lit(True)
    for i, share in enumerate(shares):
        near = near & (F.col(f"_below{i}") - 2 * RANK_ERROR <= share) & (F.col(f"_upto{i}") + 2 * RANK_ERROR >= share)
    error = F.abs(F.col("distinct") - F.col("exact_distinct"))
    return found.join(exact, "range").select(
        "range", "rows", "exact_distinct", (error <= 3 * DISTINCT_ERROR * F.col("exact_distinct") + 1).alias("distinct_within"),
        near.alias("ranks_within"),
    )


DQ_SQL = """
SELECT 'not_null' AS test, 'o_orderkey' AS "column",
       count(*) FILTER (WHERE o_orderkey IS NULL) AS failures, 'error' AS severity, 'pass' AS status FROM orders
UNION ALL
SELECT 'not_null', 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL), 'error', 'pass' FROM orders
UNION ALL
SELECT 'accepted_values', 'o_orderpriority',
       count(DISTINCT CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority END),
       'warn', 'warn' FROM orders
UNION ALL
SELECT 'unique', 'o_orderkey', count(*), 'error', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'unique', 'l_orderkey,l_linenumber', count(*), 'error',
       CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL
SELECT 'not_empty', 'orders', CAST(count(*) = 0 AS BIGINT), 'error', 'pass' FROM orders
UNION ALL
SELECT 'min_rows', 'customer', greatest(6000 - count(*), 0), 'error',
       CASE WHEN count(*) < 6000 THEN 'fail' ELSE 'pass' END FROM customer
UNION ALL
SELECT 'expected_count', 'events', abs(count(*) - 10000), 'warn',
       CASE WHEN count(*) = 10000 THEN 'pass' ELSE 'warn' END FROM events
UNION ALL
SELECT 'key_share', 'user', count(*) FILTER (WHERE event_type = 'error'), 'error',
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0.01 * count(*) THEN 'fail' ELSE 'pass' END
FROM events
UNION ALL
SELECT 'freshness', 'ts', CAST(floor((epoch(TIMESTAMP '2024-03-05') - floor(epoch(max(ts)))) / 86400) AS BIGINT),
       'warn', 'warn' FROM events
"""


@query("dq_tests", DQ_SQL)
def dq_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of data test, with passing, warning and failing cases."""
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    keyed = events.select(F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("user"))
    return combine(
        column_tests(
            orders,
            not_null=["o_orderkey", "o_orderdate"],
            accepted={"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
        ),
        unique_test(orders, "o_orderkey"),
        unique_test(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber"),
        not_empty_test(orders, "orders"),
        row_count_test(table(spark, sf, "customer"), "customer", 6000),
        expected_count_test(events, "events", 10000),
        key_share_test(keyed, "user"),
        freshness_test(events, "ts", F.lit("2024-03-05").cast("timestamp")),
    )


@query(
    "repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "contract",
    """
SELECT 'events' AS dataset, count(*) AS local_rows, CAST(count(*) AS DOUBLE) AS copy_rows, 'PASS' AS status
FROM events
UNION ALL SELECT 'orders', count(*), (SELECT count(*) FROM lineitem), 'FAIL' FROM orders
UNION ALL SELECT 'customer', count(*), NULL, 'LOCAL_ONLY' FROM customer
""",
)
def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Events against their landed copy, orders against lines, customers without a copy."""
    orders = table(spark, sf, "orders")
    documents = [
        contract("events", table(spark, sf, "events"), land_parquet(spark, f"{sf}/events.parquet")),
        contract("orders", orders, table(spark, sf, "lineitem")),
        contract("customer", table(spark, sf, "customer"), None),
    ]
    return combine(*documents).withColumn("copy_rows", F.col("copy_rows").cast("double"))

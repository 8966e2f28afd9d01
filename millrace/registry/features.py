"""Feature jobs. Orders with their lines stand in for trips, events for interactions, parts for items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import is_present, lookup
from millrace.functions.measures import guarded_ratio, rating_class, ratio, score_tier
from millrace.functions.rules import Rule, keep_rejects, keep_valid, reject_counts, within
from millrace.functions.timeparts import day_of
from millrace.operators.joins import enrich
from millrace.plans.features import item_rows, trip_features, zone_values
from millrace.plans.training import cast_numeric
from millrace.registry import query, table
from millrace.session import materialize

DAY_MINUTES = 24 * 60.0
MAX_FARE = 60_000.0
MAX_TRIP = 400 * DAY_MINUTES


def trip_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Order date to ship date as the trip; quantity, price and line number as distance, fare and seats."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
    )


@query(
    "trip_features",
    f"""
WITH trips AS (
  SELECT l_orderkey AS trip_id, l_quantity AS trip_distance, l_extendedprice AS fare_amount,
         l_linenumber AS passenger_count, o_orderdate AS pickup, l_suppkey AS "PULocationID",
         l_partkey AS "DOLocationID", (epoch(l_shipdate) - epoch(o_orderdate)) / 60.0 AS trip_duration_min
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_quantity > 0 AND l_extendedprice > 0 AND l_extendedprice < {MAX_FARE}
    AND l_linenumber BETWEEN 1 AND 6
), kept AS (
  SELECT * FROM trips WHERE trip_duration_min > 0 AND trip_duration_min < {MAX_TRIP}
)
SELECT trip_id, CAST(hour(pickup) AS INTEGER) AS pickup_hour, CAST(dayofweek(pickup) + 1 AS INTEGER) AS pickup_dow,
       trip_distance, CAST(trip_duration_min AS DOUBLE) AS trip_duration_min, passenger_count,
       fare_amount / trip_distance AS fare_per_mile,
       CAST(sum(CAST(round(fare_amount * 100) AS BIGINT)) OVER zone AS DOUBLE) / CAST(100 AS DOUBLE)
         / count(*) OVER zone AS zone_avg_fare,
       count(*) OVER zone AS zone_trip_count,
       CAST(sum(CAST(round(trip_distance * 100) AS BIGINT)) OVER zone AS DOUBLE) / CAST(100 AS DOUBLE)
         / count(*) OVER zone AS zone_avg_distance,
       "PULocationID", "DOLocationID", fare_amount, CAST(CAST(pickup AS DATE) AS VARCHAR) AS pickup_date
FROM kept WINDOW zone AS (PARTITION BY "PULocationID", hour(pickup))
""",
)
def trips(spark: SparkSession, sf: str) -> DataFrame:
    # The raw trips are read twice (averages, rows); written once, they are joined only once.
    raw = materialize(trip_rows(spark, sf), "trips")
    features = trip_features(raw, MAX_FARE, MAX_TRIP, scale=2, keep=("trip_id",))
    return features.withColumn("pickup_date", F.col("pickup_date").cast("string"))


@query(
    "zone_hour_features",
    """
SELECT event_id, user_id AS zone, CAST(hour(ts) AS INTEGER) AS hour, value,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS DOUBLE) / CAST(100 AS DOUBLE) / count(*) OVER w
         AS zone_avg_fare,
       count(*) OVER w AS zone_trip_count,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS DOUBLE) / CAST(100 AS DOUBLE) / count(*) OVER w
         AS zone_avg_distance
FROM events WINDOW w AS (PARTITION BY user_id, hour(ts))
""",
)
def zone_hour(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("zone"), F.hour("ts").alias("hour"), "value"
    )
    return zone_values(events, "zone", "hour", "value", "value", scale=2)


@query(
    "measure_features",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + l_discount + l_tax AS total,
       l_discount / greatest(l_quantity, CAST(10 AS DOUBLE)) AS guarded,
       l_extendedprice / l_quantity AS unit_price,
       CAST(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END AS DOUBLE) AS class_code,
       CASE WHEN l_quantity <= 5 THEN 0 WHEN l_quantity <= 7 THEN 1 ELSE 2 END AS tier
FROM lineitem
""",
)
def measure_features(spark: SparkSession, sf: str) -> DataFrame:
    """Sum, guarded ratio, ratio, class code and tier of every line."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_quantity") + F.col("l_discount") + F.col("l_tax")).alias("total"),
        guarded_ratio("l_discount", "l_quantity", 10.0).alias("guarded"),
        ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        lookup("l_returnflag", {"R": 0, "A": 1}).cast("double").alias("class_code"),
        score_tier("l_quantity").alias("tier"),
    )


LINE_BOUNDS = {"l_quantity": (5.0, 45.0), "l_discount": (0.01, 0.09), "l_extendedprice": (1000.0, 80000.0)}


@query(
    "bounds_filter",
    """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_extendedprice FROM lineitem
WHERE l_quantity BETWEEN 5 AND 45 AND l_discount BETWEEN 0.01 AND 0.09
  AND l_extendedprice BETWEEN 1000 AND 80000
""",
)
def bounds_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_BOUNDS)
    return keep_valid(lines, within(LINE_BOUNDS))


def _line_rules() -> list[Rule]:
    return [
        *within(LINE_BOUNDS),
        Rule("not_null", F.col("l_shipdate").isNotNull()),
        Rule("tax_positive", F.col("l_tax") > 0),
    ]


@query(
    "reject_counts",
    """
WITH c AS (
  SELECT count(*) FILTER (WHERE NOT l_quantity BETWEEN 5 AND 45) AS a,
         count(*) FILTER (WHERE NOT l_discount BETWEEN 0.01 AND 0.09) AS b,
         count(*) FILTER (WHERE NOT l_extendedprice BETWEEN 1000 AND 80000) AS d,
         count(*) FILTER (WHERE l_shipdate IS NULL) AS e,
         count(*) FILTER (WHERE NOT l_tax > 0) AS f
  FROM lineitem
)
SELECT 'l_quantity' AS rule, a AS rejected FROM c UNION ALL SELECT 'l_discount', b FROM c
UNION ALL SELECT 'l_extendedprice', d FROM c UNION ALL SELECT 'not_null', e FROM c
UNION ALL SELECT 'tax_positive', f FROM c
""",
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return reject_counts(table(spark, sf, "lineitem"), _line_rules())


@query(
    "reject_rows",
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       concat_ws(',', CASE WHEN NOT l_quantity BETWEEN 5 AND 45 THEN 'l_quantity' END,
                 CASE WHEN NOT l_discount BETWEEN 0.01 AND 0.09 THEN 'l_discount' END,
                 CASE WHEN NOT l_extendedprice BETWEEN 1000 AND 80000 THEN 'l_extendedprice' END,
                 CASE WHEN NOT l_tax > 0 THEN 'tax_positive' END) AS failed_rules
FROM lineitem
WHERE NOT (l_quantity BETWEEN 5 AND 45 AND l_discount BETWEEN 0.01 AND 0.09
           AND l_extendedprice BETWEEN 1000 AND 80000 AND l_tax > 0)
""",
)
def reject_rows(spark: SparkSession, sf: str) -> DataFrame:
    broken = keep_rejects(table(spark, sf, "lineitem"), _line_rules())
    return broken.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query(
    "rating_classes",
    """
SELECT CASE WHEN value >= 50 THEN 'positive_rating' WHEN value >= 10 THEN 'neutral_rating'
            ELSE 'negative_rating' END AS event_class,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS rows
FROM events GROUP BY 1, 2
""",
)
def rating_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Events by value class and day."""
    limits = [(50.0, "positive_rating"), (10.0, "neutral_rating")]
    return (
        table(spark, sf, "events")
        .groupBy(rating_class("value", limits).alias("event_class"), day_of("ts").cast("string").alias("date"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


PART_PRICES = [(925.0, "low"), (950.0, "medium"), (975.0, "high")]


@query(
    "item_rows",
    """
SELECT p_partkey AS item_id, p_name AS title, p_retailprice AS price_raw, p_type AS main_category,
       CASE WHEN p_retailprice < 925 THEN 'low' WHEN p_retailprice < 950 THEN 'medium'
            WHEN p_retailprice < 975 THEN 'high' ELSE 'premium' END AS price_bucket,
       p_size > 10 AS has_brand
FROM part
""",
)
def items(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as items; a small part has no store."""
    parts = table(spark, sf, "part").withColumn("store", F.when(F.col("p_size") > 10, F.col("p_brand")))
    rows = item_rows(
        parts,
        item="p_partkey",
        title="p_name",
        categories="p_type",
        price="p_retailprice",
        main_category="p_type",
        author="p_brand",
        limits=PART_PRICES,
    )
    return rows.drop("category_raw", "store", "author")


@query(
    "presence_flag",
    """
SELECT c_custkey, count(o_orderkey) > 0 AS has_orders, count(o_orderkey) AS orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1
""",
)
def presence_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a flag for having orders. Orders are counted per customer before the join."""
    counts = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = enrich(table(spark, sf, "customer").select("c_custkey"), counts, "c_custkey")
    return joined.select(
        "c_custkey", is_present("n").alias("has_orders"), F.coalesce("n", F.lit(0)).alias("orders")
    )


@query(
    "training_rows",
    """
SELECT o_custkey AS user_id, l_partkey AS item_id, l_linenumber, l_orderkey,
       CAST(l_quantity AS DOUBLE) AS rating, p_type AS main_category,
       CASE WHEN p_retailprice < 925 THEN 'low' WHEN p_retailprice < 950 THEN 'medium'
            WHEN p_retailprice < 975 THEN 'high' ELSE 'premium' END AS price_bucket,
       p_retailprice AS price_raw, CAST(p_size > 10 AS INTEGER) AS has_brand,
       CAST(l_returnflag <> 'R' AS INTEGER) AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
""",
)
def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as interactions of the ordering customer, with item attributes and a returned-or-not label."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("rating"),
        (F.col("l_returnflag") != "R").cast("int").alias("label"),
    )
    facts = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    columns = ["main_category", "price_bucket", "price_raw", "has_brand"]
    return cast_numeric(enrich(facts, items(spark, sf), "item_id", columns))

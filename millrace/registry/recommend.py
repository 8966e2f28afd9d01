"""Recommendation features and metrics. Events and order lines are the interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.inner_product import top_inner_products
from millrace.plans.recommend import (
    assign_variant,
    business_metrics,
    compare_variants,
    daily_volume,
    event_checks,
    factorize,
    interaction_weights,
    item_features,
    last_items,
    model_ids,
    model_top_n,
    negative_samples,
    ranking_metrics,
    top_n,
    user_features,
)
from millrace.registry import query, table
from millrace.registry.features import items
from millrace.session import materialize


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the number in their properties as the item."""
    item = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return table(spark, sf, "events").withColumn("item_id", item).drop("props")


ACTED = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS item_id FROM events
)
"""


@query(
    "user_features",
    """
SELECT user_id, count(*) AS events,
       CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-01') AS INTEGER) AS recency_days,
       CASE WHEN count(*) < 5 THEN 'light' WHEN count(*) < 50 THEN 'regular' ELSE 'heavy' END AS segment
FROM events GROUP BY 1
""",
)
def users(spark: SparkSession, sf: str) -> DataFrame:
    return user_features(table(spark, sf, "events"), "user_id", "ts", F.lit("2024-02-01"))


@query(
    "item_features",
    """
SELECT p_partkey AS item_id, p_type AS main_category,
       CASE WHEN p_retailprice < 925 THEN 'low' WHEN p_retailprice < 950 THEN 'medium'
            WHEN p_retailprice < 975 THEN 'high' ELSE 'premium' END AS price_bucket,
       count(l_partkey) AS popularity
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2, 3
""",
)
def item_table(spark: SparkSession, sf: str) -> DataFrame:
    sold = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item_id"))
    return item_features(sold, items(spark, sf), "item_id", ["main_category", "price_bucket"])


@query(
    "last_clicks",
    ACTED
    + """
SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY n) AS last_items FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n
  FROM e WHERE event_type = 'click'
) WHERE n <= 10 GROUP BY 1
""",
)
def last_clicks(spark: SparkSession, sf: str) -> DataFrame:
    clicks = interactions(spark, sf).filter("event_type = 'click'")
    recent = last_items(clicks, "user_id", "item_id", [F.col("ts").desc(), F.col("event_id")])
    return recent.withColumn("last_items", F.array_join("last_items", ","))


@query(
    "daily_volume",
    """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1), w AS (
  SELECT day, events, count(*) OVER p AS seen, avg(events) OVER p AS usual, stddev_samp(events) OVER p AS spread
  FROM d WINDOW p AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)
SELECT CAST(day AS VARCHAR) AS day, events, round(usual, 6) AS usual,
       CASE WHEN NOT coalesce(seen = 7 AND abs(events - usual) > 3 * spread, false) THEN 'normal'
            WHEN events > usual THEN 'spike' ELSE 'drop' END AS verdict
FROM w
""",
)
def volume(spark: SparkSession, sf: str) -> DataFrame:
    daily = daily_volume(table(spark, sf, "events"), "ts")
    return daily.withColumns({"day": F.col("day").cast("string"), "usual": F.round("usual", 6)})


@query(
    "event_checks",
    """
SELECT 'user_id_present' AS rule, count(*) FILTER (WHERE user_id IS NULL) AS rejected FROM events
UNION ALL SELECT 'ts_present', count(*) FILTER (WHERE ts IS NULL) FROM events
UNION ALL SELECT 'rating_range', count(*) FILTER (WHERE NOT value BETWEEN 0 AND 5) FROM events
""",
)
def checks(spark: SparkSession, sf: str) -> DataFrame:
    return event_checks(table(spark, sf, "events"), ["user_id", "ts"], "value")


WEIGHTS = (
    ACTED
    + """
, weights AS (
  SELECT user_id, item_id, sum(CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 ELSE 5.0 END)::DOUBLE
    AS weight
  FROM e WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2
)
"""
)


@query("interaction_weights", WEIGHTS + "SELECT * FROM weights")
def weights(spark: SparkSession, sf: str) -> DataFrame:
    return interaction_weights(interactions(spark, sf), "user_id", "item_id", "event_type")


TOP = (
    WEIGHTS
    + """
, top AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, item_id) AS INTEGER) AS position
  FROM weights QUALIFY position <= 5
)
"""
)


@query("top_n_per_user", TOP + "SELECT * FROM top")
def top_items(spark: SparkSession, sf: str) -> DataFrame:
    """Five heaviest items per user (the operator's purpose)."""
    return top_n(weights(spark, sf), "user_id", "item_id", "weight", 5)


@query("factor_top_n")
def factor_top_n(spark: SparkSession, sf: str) -> DataFrame:
    """Five best items per user by implicit-feedback factors."""
    coded = materialize(model_ids(interactions(spark, sf), "user_id", "item_id", ["event_id"]), "coded")
    weighted = interaction_weights(coded, "user_id_idx", "item_id_idx", "event_type")
    return model_top_n(factorize(weighted, "user_id_idx", "item_id_idx"), "user_id_idx", "item_id_idx", 5)


@query(
    "factor_top_n_fixed",
    """
WITH u AS (SELECT vec_id AS user_id, embedding AS v FROM embeddings WHERE label < 5),
i AS (SELECT vec_id AS item_id, list_transform(embedding, lambda x: x * (1 + vec_id % 10)) AS v FROM embeddings WHERE label >= 5),
s AS (
  SELECT user_id, item_id, round(list_inner_product(CAST(u.v AS DOUBLE[]), CAST(i.v AS DOUBLE[])), 9) AS score FROM u CROSS JOIN i
)
SELECT user_id, item_id, round(score, 6) AS score, CAST(row_number() OVER w AS INTEGER) AS position
FROM s WINDOW w AS (PARTITION BY user_id ORDER BY score DESC, item_id) QUALIFY row_number() OVER w <= 5
""",
)
def factor_top_n_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Given vectors as factors: half of the labels are users, the others items of different lengths."""
    vectors = table(spark, sf, "embeddings")
    users = vectors.filter("label < 5").select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("factors"))
    longer = F.transform("embedding", lambda x: (x * (1 + F.col("vec_id") % 10)).cast("float"))
    items = vectors.filter("label >= 5").select(F.col("vec_id").alias("item_id"), longer.alias("factors"))
    return top_inner_products(users, items, 5, item_rows=128).withColumn("score", F.round("score", 6))


@query(
    "negative_samples",
    ACTED
    + """
, pairs AS (SELECT DISTINCT user_id, item_id FROM e WHERE event_type = 'purchase'),
numbered AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS place FROM (SELECT DISTINCT item_id FROM e)),
asked AS (
  SELECT user_id, size - count(*) AS untouched, least(3 * count(*), size - count(*)) AS asked
  FROM pairs CROSS JOIN (SELECT count(*) AS size FROM numbered) GROUP BY user_id, size
), draws AS (
  SELECT *, (d - 1) * untouched // asked AS low, d * untouched // asked AS high
  FROM (SELECT *, unnest(range(1, asked + 1)) AS d FROM asked)
), wanted AS (
  SELECT user_id, low + ('0x' || substr(md5(user_id || '-' || d || '-42'), 1, 8))::BIGINT % (high - low) + 1 AS nth FROM draws
), untouched AS (
  SELECT u.user_id, n.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY place) AS nth
  FROM (SELECT DISTINCT user_id FROM pairs) u CROSS JOIN numbered n
  WHERE (u.user_id, n.item_id) NOT IN (SELECT (user_id, item_id) FROM pairs)
)
SELECT user_id, item_id FROM wanted JOIN untouched USING (user_id, nth)
""",
)
def negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Three untouched items for each item that a user has bought."""
    acted = interactions(spark, sf)
    return negative_samples(acted.filter("event_type = 'purchase'"), acted, "user_id", "item_id", 3)


METRICS = (
    TOP
    + """
, truth AS (SELECT DISTINCT user_id, item_id FROM e WHERE event_type = 'purchase'),
wanted AS (SELECT user_id, count(*) AS wanted FROM truth GROUP BY 1),
hits AS (
  SELECT user_id, position, row_number() OVER (PARTITION BY user_id ORDER BY position) AS nth
  FROM top JOIN truth USING (user_id, item_id)
), per_user AS (
  SELECT user_id, count(*) AS hits, sum(1 / log2(position + 1)) AS gain, sum(nth / position) AS prec
  FROM hits GROUP BY 1
), rated AS (
  SELECT wanted, coalesce(hits, 0) AS hits, coalesce(gain, 0) AS gain, coalesce(prec, 0) AS prec,
         least(wanted, 5) AS possible,
         list_sum(list_transform(range(1, least(wanted, 5) + 1), lambda i: 1 / log2(i + 1))) AS best
  FROM wanted LEFT JOIN per_user USING (user_id)
)
"""
)


@query(
    "ranking_metrics",
    METRICS
    + """
SELECT count(*) AS users, round(avg(hits / wanted), 6) AS recall, round(avg(gain / best), 6) AS ndcg,
       round(avg(prec / possible), 6) AS map, round(avg(CAST(hits > 0 AS INTEGER)), 6) AS hit_rate FROM rated
""",
)
def rank_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Heaviest items as recommendations, purchases as truth."""
    bought = interactions(spark, sf).filter("event_type = 'purchase'")
    metrics = ranking_metrics(top_items(spark, sf), bought, "user_id", "item_id", 5)
    return metrics.withColumns({c: F.round(c, 6) for c in ("recall", "ndcg", "map", "hit_rate")})


@query(
    "business_metrics",
    TOP
    + """
, judged AS (
  SELECT e.user_id, e.value, t.item_id IS NOT NULL AS taken FROM e LEFT JOIN top t
    ON e.user_id = t.user_id AND e.item_id = t.item_id WHERE e.event_type = 'purchase'
), per_user AS (
  SELECT user_id, count(*) AS n, count(*) FILTER (WHERE taken) AS taken,
         sum(CASE WHEN taken THEN value ELSE 0 END) AS revenue FROM judged GROUP BY 1
)
SELECT CAST(sum(n) AS BIGINT) AS interactions, round(sum(taken) / sum(n), 6) AS ctr_proxy,
       round(avg(revenue), 4) AS revenue_per_user FROM per_user
""",
)
def business(spark: SparkSession, sf: str) -> DataFrame:
    bought = interactions(spark, sf).filter("event_type = 'purchase'")
    metrics = business_metrics(top_items(spark, sf), bought, "user_id", "item_id", "value")
    return metrics.withColumns(
        {"ctr_proxy": F.round("ctr_proxy", 6), "revenue_per_user": F.round("revenue_per_user", 4)}
    )


@query(
    "variant_comparison",
    """
WITH v AS (
  SELECT *, CASE WHEN ('0x' || substr(md5(user_id || '-0'), 1, 8))::BIGINT < floor(0.8 * 4294967296) THEN 'A' ELSE 'B' END AS variant
  FROM events
)
SELECT variant, count(*) AS rows, round(count(*) FILTER (WHERE event_type = 'click') / count(*), 4) AS ctr,
       round(count(*) FILTER (WHERE event_type = 'purchase') / count(*), 4) AS conversion_rate,
       round(count(*) FILTER (WHERE event_type = 'error') / count(*), 4) AS error_rate,
       round(avg(value), 4) AS avg_latency
FROM v GROUP BY 1
""",
)
def variants(spark: SparkSession, sf: str) -> DataFrame:
    assigned = assign_variant(table(spark, sf, "events"), "user_id")
    compared = compare_variants(assigned, "event_type", "value", "click", "purchase", "error")
    return compared.withColumn("avg_latency", F.round("avg_latency", 4))

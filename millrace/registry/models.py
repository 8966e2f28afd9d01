"""Encoding, splits, models, metrics, drift, latency. Events and labelled documents are the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.operators.encode import encode_categories
from millrace.operators.sampling import in_share, stratified_split
from millrace.plans.drift import drift_distances, drift_report, drift_summary
from millrace.plans.latency import latency_summary
from millrace.plans.training import (
    CATEGORIES,
    accuracy_and_macro_f1,
    classification_report,
    join_splits,
    log_loss,
    ranking_rows,
    score,
    train_ranker,
    train_tiers,
)
from millrace.registry import query, table
from millrace.registry.features import training_rows
from millrace.session import materialize, spread

HALF = "2024-01-16"


@query(
    "encode_categories",
    f"""
WITH both_splits AS (
  SELECT event_id, nullif(event_type, 'error') AS event_type, CAST(user_id AS VARCHAR) AS user_id,
         ts < '{HALF}' AS is_validation FROM events
), t AS (
  SELECT event_type, row_number() OVER (ORDER BY min((is_validation, event_id))) - 1 AS code
  FROM both_splits WHERE event_type IS NOT NULL GROUP BY 1
), u AS (
  SELECT user_id, row_number() OVER (ORDER BY min((is_validation, event_id))) - 1 AS code
  FROM both_splits GROUP BY 1
)
SELECT event_id, is_validation, CAST(coalesce(t.code, -1) AS INTEGER) AS event_type_idx,
       CAST(u.code AS INTEGER) AS user_id_idx
FROM both_splits b LEFT JOIN t ON b.event_type = t.event_type LEFT JOIN u ON b.user_id = u.user_id
""",
)
def encode(spark: SparkSession, sf: str) -> DataFrame:
    """Codes in first-seen order, second half of the month (training) before the first (validation)."""
    events = table(spark, sf, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "user_id", "ts"
    )
    both = join_splits(events.filter(F.col("ts") >= HALF), events.filter(F.col("ts") < HALF)).drop("ts")
    return encode_categories(both, ["event_type", "user_id"], ["is_validation", "event_id"])


@query(
    "stratified_split",
    """
SELECT doc_id, quality, toxic,
       CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '-42'), doc_id)
                 <= floor(count(*) OVER (PARTITION BY quality) * CAST(0.2 AS DOUBLE) + 0.5)
            THEN 'test' ELSE 'train' END AS split
FROM labels
""",
)
def split(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_split(table(spark, sf, "labels"), "quality", ["doc_id"])


TEXT_FEATURES = ["n_chars", "n_words", "mean_word", "unlike", "digits", "capitals", "lines"]


def document_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with plain text measures and a three-class target."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    labelled = spread(table(spark, sf, "labels").join(docs, "doc_id"))
    text, n = F.col("text"), F.greatest(F.length("text"), F.lit(1))
    return labelled.withColumn("_words", words("text")).select(
        "doc_id",
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("tier"),
        F.col("quality").alias("label"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size("_words").cast("double").alias("n_words"),
        (n / F.greatest(F.size("_words"), F.lit(1))).alias("mean_word"),
        (F.size(F.array_distinct("_words")) / F.greatest(F.size("_words"), F.lit(1))).alias("unlike"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / n).alias("digits"),
        (F.length(F.regexp_replace(text, "[^A-Z]", "")) / n).alias("capitals"),
        (F.length(text) - F.length(F.regexp_replace(text, "\n", ""))).cast("double").alias("lines"),
    )


@query("classify_documents")
def classify_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Three-class forest on text measures: predictions for the held-out documents."""
    rows = materialize(stratified_split(document_measures(spark, sf), "tier", ["doc_id"]), "tiers")
    model = train_tiers(rows.filter("split = 'train'"), TEXT_FEATURES)
    scored = score(model, rows.filter("split = 'test'"), "1")
    return scored.select("doc_id", "tier", "prediction", "model_version")


@query("ranker")
def ranker(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted binary ranker on returned-or-not lines and all their columns, a fifth of the orders held
    out for validation: log-loss on both parts."""
    rows = training_rows(spark, sf)
    held_out = in_share(["l_orderkey"], 0.2, 42)
    encoded = ranking_rows(rows.filter(~held_out), rows.filter(held_out), ["l_orderkey"])
    codes = [f"{c}_idx" for c in CATEGORIES if f"{c}_idx" in encoded.columns]
    features = ["rating", "price_raw", "has_brand", *codes]
    stored = materialize(encoded, "ranking").fillna(0.0, ["rating", "price_raw"]).fillna(0, ["has_brand"])
    scored = score(train_ranker(stored, features), stored, "1")
    return scored.groupBy("is_validation").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(log_loss("label", F.col("probability")[1]), 6).alias("log_loss"),
    )


# Fixed predictions: short documents are taken for low quality.
PREDICTED = """
WITH p AS (
  SELECT CAST(quality AS INTEGER) AS label, CAST(n_chars > 1000 AS INTEGER) AS prediction
  FROM labels JOIN documents USING (doc_id)
), c AS (
  SELECT class, count(*) FILTER (WHERE label = class) AS support,
         count(*) FILTER (WHERE prediction = class) AS named,
         count(*) FILTER (WHERE label = class AND prediction = class) AS hits
  FROM p CROSS JOIN (SELECT 0 AS class UNION ALL SELECT 1) GROUP BY 1
), r AS (
  SELECT *, coalesce(hits / nullif(named, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall
  FROM c
), f AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM r
)
"""


def _fixed_predictions(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("prediction"))
    return table(spark, sf, "labels").join(docs, "doc_id").withColumnRenamed("quality", "label")


@query(
    "classification_report",
    PREDICTED
    + """SELECT class, support, named, hits, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM f""",
)
def report(spark: SparkSession, sf: str) -> DataFrame:
    rated = classification_report(_fixed_predictions(spark, sf))
    return rated.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "accuracy_macro_f1",
    PREDICTED
    + """SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro,
       CAST(sum(support) AS BIGINT) AS rows FROM f""",
)
def macro(spark: SparkSession, sf: str) -> DataFrame:
    summed = accuracy_and_macro_f1(classification_report(_fixed_predictions(spark, sf)))
    return summed.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1_macro")})


@query(
    "log_loss",
    """
SELECT lang, count(*) AS rows, round(avg(-ln(CASE WHEN quality = 1 THEN p ELSE 1 - p END)), 6) AS log_loss
FROM (SELECT lang, quality, n_chars / (n_chars + CAST(500 AS DOUBLE)) AS p
      FROM labels JOIN documents USING (doc_id)) GROUP BY 1
""",
)
def losses(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", (F.col("n_chars") / (F.col("n_chars") + 500.0)).alias("p")
    )
    joined = table(spark, sf, "labels").join(docs, "doc_id")
    return joined.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.round(log_loss("quality", "p"), 6).alias("log_loss")
    )


@query(
    "drift_report",
    f"""
WITH long AS (
  SELECT 'value' AS feature, value, ts < '{HALF}' AS is_ref FROM events
  UNION ALL SELECT 'k', CAST(json_extract(props, '$.k') AS DOUBLE), ts < '{HALF}' FROM events
  UNION ALL SELECT 'hour', CAST(hour(ts) AS DOUBLE), ts < '{HALF}' FROM events
), v AS (
  SELECT feature, value, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
  FROM long GROUP BY 1, 2
), s AS (
  SELECT *, sum(r) OVER w AS ru, sum(c) OVER w AS cu, sum(r) OVER (PARTITION BY feature) AS rn,
         sum(c) OVER (PARTITION BY feature) AS cn
  FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)
), ks AS (
  SELECT feature, any_value(rn) AS rn, any_value(cn) AS cn, max(abs(ru / rn - cu / cn)) AS ks FROM s GROUP BY 1
), edges AS (
  SELECT feature, j, min(ru) AS ru, min(cu) AS cu
  FROM s JOIN (SELECT unnest(range(1, 10)) AS j) ON ru >= ceil(j * rn / 10) GROUP BY 1, 2
  UNION ALL SELECT feature, 10, rn, cn FROM ks
), bins AS (
  SELECT e.feature, greatest((ru - lag(ru, 1, 0) OVER w) / rn, 0.0001) AS p,
         greatest((cu - lag(cu, 1, 0) OVER w) / cn, 0.0001) AS q
  FROM edges e JOIN ks ON e.feature = ks.feature WINDOW w AS (PARTITION BY e.feature ORDER BY j)
), psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM bins GROUP BY 1)
SELECT feature, CAST(rn AS BIGINT) AS reference_rows, CAST(cn AS BIGINT) AS current_rows,
       round(psi, 6) AS psi, round(ks, 6) AS ks,
       psi > 0.2 OR ks > 1.36 * sqrt((rn + cn) / (rn * cn)) AS drifted
FROM ks JOIN psi USING (feature)
""",
)
def drift(spark: SparkSession, sf: str) -> DataFrame:
    """First against second half of the month, for the numbers of an event."""
    events = table(spark, sf, "events").select(
        "ts",
        "value",
        F.hour("ts").alias("hour"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "double").alias("k"),
    )
    report = drift_report(
        events.filter(F.col("ts") < HALF), events.filter(F.col("ts") >= HALF), ["value", "k", "hour"]
    )
    return report.select(
        "feature", "reference_rows", "current_rows", F.round("psi", 6).alias("psi"), F.round("ks", 6).alias("ks"), "drifted"
    )


@query(
    "drift_distances",
    f"""
WITH long AS (
  SELECT 'value' AS feature, value, ts < '{HALF}' AS is_ref FROM events
  UNION ALL SELECT 'weekday', CAST(dayofweek(ts) AS DOUBLE), ts < '{HALF}' FROM events
  UNION ALL SELECT 'late', CAST(hour(ts) > 17 AND ts < '{HALF}' AS DOUBLE), ts < '{HALF}' FROM events
), v AS (
  SELECT feature, value, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
  FROM long GROUP BY 1, 2
), s AS (
  SELECT *, sum(r) OVER w / sum(r) OVER f AS rs, sum(c) OVER w / sum(c) OVER f AS cs, r / sum(r) OVER f AS p,
         c / sum(c) OVER f AS q, sum(r) OVER f AS rn, sum(c) OVER f AS cn, lead(value) OVER w AS following
  FROM v WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)
), d AS (
  SELECT feature, any_value(rn) AS rn, any_value(cn) AS cn, count(*) AS n, sum(abs(rs - cs) * (following - value)) AS area,
         sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) / 2
           + sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js,
         sqrt(sum(r * value * value) / any_value(rn) - (sum(r * value) / any_value(rn)) ** 2) AS spread
  FROM s GROUP BY 1
), e AS (
  SELECT *, area / greatest(spread, 0.001) AS wasserstein, sqrt(greatest(js, 0)) AS jensen_shannon FROM d
)
SELECT feature, CAST(rn AS BIGINT) AS reference_rows, CAST(cn AS BIGINT) AS current_rows, n AS "values",
       round(wasserstein, 6) AS wasserstein, round(jensen_shannon, 6) AS jensen_shannon,
       CASE WHEN n <= 5 THEN jensen_shannon ELSE wasserstein END >= 0.1 AS drifted
FROM e
""",
)
def distances(spark: SparkSession, sf: str) -> DataFrame:
    """First against second half of the month: a value, the weekday, and a flag that only the first half knows."""
    events = table(spark, sf, "events").select(
        "ts", "value", (F.dayofweek("ts") - 1).alias("weekday"),
        ((F.hour("ts") > 17) & (F.col("ts") < HALF)).cast("int").alias("late"),
    )
    found = drift_distances(events.filter(F.col("ts") < HALF), events.filter(F.col("ts") >= HALF), ["value", "weekday", "late"])
    return found.withColumns({c: F.round(c, 6) for c in ("wasserstein", "jensen_shannon")}).drop("distance")


def _lost_values(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of features that are null everywhere, null in half of the rows, or null on one side only."""
    events = table(spark, sf, "events").select(
        "ts",
        F.lit(None).cast("double").alias("never"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 7).cast("double").alias("half"),
        F.when(F.col("ts") < HALF, F.col("value")).alias("lost"),
    )
    return drift_report(
        events.filter(F.col("ts") < HALF), events.filter(F.col("ts") >= HALF), ["never", "half", "lost"]
    )


@query(
    "drift_nulls",
    f"""
WITH s AS (
  SELECT count(*) FILTER (WHERE ts < '{HALF}') AS r, count(*) FILTER (WHERE ts >= '{HALF}') AS c,
         count(*) FILTER (WHERE ts < '{HALF}' AND event_id % 2 = 0) AS rh,
         count(*) FILTER (WHERE ts >= '{HALF}' AND event_id % 2 = 0) AS ch FROM events
)
SELECT feature, CAST(reference_rows AS BIGINT) AS reference_rows, CAST(current_rows AS BIGINT) AS current_rows,
       round(1 - reference_rows / r, 6) AS reference_null_share, round(1 - current_rows / c, 6) AS current_null_share,
       has_psi, feature = 'lost' AS drifted
FROM (SELECT 'never' AS feature, 0 AS reference_rows, 0 AS current_rows, r, c, false AS has_psi FROM s
      UNION ALL SELECT 'half', rh, ch, r, c, true FROM s UNION ALL SELECT 'lost', r, 0, r, c, false FROM s)
""",
)
def drift_nulls(spark: SparkSession, sf: str) -> DataFrame:
    report = _lost_values(spark, sf)
    return report.select(
        "feature", "reference_rows", "current_rows", F.round("reference_null_share", 6).alias("reference_null_share"),
        F.round("current_null_share", 6).alias("current_null_share"), F.col("psi").isNotNull().alias("has_psi"), "drifted",
    )


@query(
    "drift_summary",
    f"""
SELECT count(*) FILTER (WHERE ts < '{HALF}') AS reference_rows, count(*) FILTER (WHERE ts >= '{HALF}') AS current_rows,
       CAST(3 AS BIGINT) AS features, CAST(1 AS BIGINT) AS drifted_features, false AS dataset_drift FROM events
""",
)
def summary_of_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Rows are those of the tables, however many values are null."""
    return drift_summary(_lost_values(spark, sf))


LATENCY = """
WITH s AS (SELECT value, row_number() OVER (ORDER BY value) AS rank, count(*) OVER () AS n FROM events)
SELECT (SELECT count(*) FROM events) AS requests,
       (SELECT round(count(*) / (floor(epoch(max(ts))) - floor(epoch(min(ts)))), 1) FROM events)
         AS throughput_rps,
       (SELECT round(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*), 2) FROM events)
         AS latency_mean,
       (SELECT round(value, 2) FROM s WHERE rank = n // 2 + 1) AS latency_p50,
       (SELECT round(value, 2) FROM s WHERE rank = {p95}) AS latency_p95,
       (SELECT round(max(value), 2) FROM events) AS latency_max
"""


def _latency(spark: SparkSession, sf: str, floored: bool) -> DataFrame:
    span = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    return latency_summary(table(spark, sf, "events"), "value", span, floored, scale=2)


@query("latency_summary", LATENCY.format(p95="CAST(floor(0.95 * n) AS BIGINT)"))
def latency(spark: SparkSession, sf: str) -> DataFrame:
    """Event values as latencies, spread over the month."""
    return _latency(spark, sf, False)


@query("latency_summary_floored", LATENCY.format(p95="greatest(1, CAST(round_even(0.95 * n, 0) AS BIGINT))"))
def latency_floored(spark: SparkSession, sf: str) -> DataFrame:
    return _latency(spark, sf, True)

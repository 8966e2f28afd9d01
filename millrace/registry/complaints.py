"""Staging and marts. Lineitem with its part stands in for complaints, orders for raw counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import blank_to_null, safe_date, safe_double, tokens_to_null, yes_no_flag
from millrace.functions.timeparts import month_part, month_start, year_part
from millrace.plans.complaints import company_product_mart, product_month_mart, ranked_counts, stage
from millrace.registry import query, table
from millrace.sources.landing import land_parquet, read_with_rescue, typed_view, variant_paths, variant_schema


def complaint_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to stage: product is the part type, company the supplier, flags the two status letters."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    flag = F.col("l_returnflag")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("complaint_id"),
        F.col("l_shipdate").alias("date_received"),
        F.col("p_type").alias("product"),
        F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string")).alias("company"),
        F.when(flag == "R", "Yes").when(flag == "N", "no").otherwise("").alias("timely_response"),
        F.when(F.col("l_linestatus") == "F", "TRUE").otherwise("0").alias("consumer_disputed"),
    )


STAGED = """
WITH staged AS (
  SELECT l_orderkey AS complaint_id, CAST(l_shipdate AS DATE) AS date_received, p_type AS product,
         'Supplier#' || l_suppkey AS company,
         CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS timely,
         l_linestatus = 'F' AS disputed
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
"""


@query(
    "mart_product_month",
    STAGED
    + """
SELECT CAST(CAST(date_trunc('month', date_received) AS DATE) AS VARCHAR) AS month_start, product,
       count(*) AS complaint_count, count(DISTINCT company) AS company_count,
       count(*) FILTER (WHERE timely = false) AS untimely_count,
       count(*) FILTER (WHERE disputed) AS disputed_count,
       round(count(*) FILTER (WHERE disputed) / count(*), 4) AS dispute_rate
FROM staged GROUP BY 1, 2
""",
)
def mart_product_month(spark: SparkSession, sf: str) -> DataFrame:
    mart = product_month_mart(stage(complaint_rows(spark, sf)))
    return mart.withColumn("month_start", F.col("month_start").cast("string"))


@query(
    "mart_company_product",
    STAGED
    + """
SELECT company, product, count(*) AS complaint_count,
       count(*) FILTER (WHERE timely) AS timely_yes,
       count(*) FILTER (WHERE timely = false) AS timely_no,
       count(*) FILTER (WHERE disputed) AS disputed,
       CAST(min(date_received) AS VARCHAR) AS first_complaint_date,
       CAST(max(date_received) AS VARCHAR) AS last_complaint_date
FROM staged GROUP BY 1, 2
""",
)
def mart_company_product(spark: SparkSession, sf: str) -> DataFrame:
    mart = company_product_mart(stage(complaint_rows(spark, sf)))
    days = ["first_complaint_date", "last_complaint_date"]
    return mart.withColumns({c: F.col(c).cast("string") for c in days})


def order_products(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the priority as product; an unspecified priority is a missing product."""
    return table(spark, sf, "orders").select(
        tokens_to_null("o_orderpriority", ["4-NOT SPECIFIED"]).alias("product"),
        F.col("o_orderdate").alias("date_received"),
    )


ORDER_COUNTS = """
SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS product,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
       count(*) AS complaint_count
FROM orders {where} GROUP BY 1, 2
"""


def _month_text(df: DataFrame) -> DataFrame:
    return df.withColumn("month_start", F.col("month_start").cast("date").cast("string"))


@query("mart_counts_all", ORDER_COUNTS.format(where=""))
def mart_counts_all(spark: SparkSession, sf: str) -> DataFrame:
    return _month_text(ranked_counts(order_products(spark, sf), "date_received", "product"))


@query("mart_counts_known", ORDER_COUNTS.format(where="WHERE o_orderpriority <> '4-NOT SPECIFIED'"))
def mart_counts_known(spark: SparkSession, sf: str) -> DataFrame:
    return _month_text(ranked_counts(order_products(spark, sf), "date_received", "product", False))


@query(
    "mart_counts_preview",
    ORDER_COUNTS.format(where="")
    + " ORDER BY complaint_count DESC, product ASC NULLS LAST, month_start LIMIT 50",
)
def mart_counts_preview(spark: SparkSession, sf: str) -> DataFrame:
    return _month_text(ranked_counts(order_products(spark, sf), "date_received", "product", rows=50))


@query(
    "staging_clean",
    """
WITH raw AS (
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, ts FROM events
)
SELECT event_id,
       CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS day,
       CASE WHEN k % 5 = 0 THEN NULL ELSE event_type END AS label,
       CASE k % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'true' WHEN 2 THEN 'false' WHEN 3 THEN 'false' END AS flag,
       CASE WHEN k % 3 = 0 THEN 'unknown' ELSE CAST(year(ts) AS VARCHAR) END AS year,
       CASE WHEN k % 3 = 0 THEN '00' ELSE lpad(CAST(month(ts) AS VARCHAR), 2, '0') END AS month,
       CASE WHEN k % 3 = 0 THEN NULL
            ELSE CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) END AS month_start,
       CASE WHEN k % 2 = 0 THEN CAST(k AS DOUBLE) END AS amount
FROM raw
""",
)
def staging_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Every event made into messy text by its number ``k``, then cleaned."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    day = F.col("ts").cast("date").cast("string")
    flags = F.array(*[F.lit(w) for w in ("Yes", "1", "N", "FALSE", " yes ", "maybe")])
    messy = table(spark, sf, "events").select(
        "event_id",
        F.when(k % 3 == 0, F.lit("2024-13-01")).otherwise(day).alias("date_text"),
        F.when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "event_type")).alias("label_text"),
        F.element_at(flags, k % 6 + 1).alias("flag_text"),
        F.when(k % 2 == 0, k.cast("string")).otherwise("None").alias("amount_text"),
    )
    return messy.select(
        "event_id",
        safe_date("date_text").cast("string").alias("day"),
        blank_to_null("label_text").alias("label"),
        yes_no_flag("flag_text").cast("string").alias("flag"),
        year_part("date_text").alias("year"),
        month_part("date_text").alias("month"),
        month_start(safe_date("date_text")).cast("string").alias("month_start"),
        safe_double("amount_text").alias("amount"),
    )


SPELLINGS = {
    "order_id": ["Order ID", "ORDER_ID", "order_id"],
    "status": ["Status?", "STATUS", "status"],
    "total": ["Total price", "TOTAL_PRICE"],
}


@query(
    "landing_typed",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DOUBLE) END AS total,
       'orders.parquet' AS filename,
       row_number() OVER (ORDER BY file_row_number) AS file_row_number
FROM (SELECT *, o_orderkey AS file_row_number FROM orders)
""",
)
def landing_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as variants under three header spellings (one per status), then typed."""
    names = {"F": ("Order ID", "Status?", "Total price"), "O": ("ORDER_ID", "STATUS", "TOTAL_PRICE")}
    landed = land_parquet(spark, f"{sf}/orders.parquet")
    key = F.variant_get("src", "$.o_orderkey", "long")
    status = F.variant_get("src", "$.o_orderstatus", "string")
    price = F.variant_get("src", "$.o_totalprice", "double")
    fields = [
        (code, F.to_variant_object(F.struct(key.alias(a), status.alias(b), price.alias(c))))
        for code, (a, b, c) in names.items()
    ]
    other = F.to_variant_object(
        F.struct(key.alias("order_id"), status.alias("status"), price.alias("total_price"))
    )
    drifted = landed.withColumn(
        "src", F.when(status == "F", fields[0][1]).when(status == "O", fields[1][1]).otherwise(other)
    )
    view = typed_view(drifted, SPELLINGS)
    return view.withColumn("total", safe_double("total")).drop("loaded_at")


@query("variant_keys")
def variant_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Merged schema of all landed events."""
    return variant_schema(land_parquet(spark, f"{sf}/events.parquet"))


@query(
    "variant_paths",
    r"""
WITH d AS (
  SELECT concat('{"props": ', props, ', "tags": ["', event_type, '", null, [', event_id, ', 1.5]], "ok": ',
    CASE WHEN event_type = 'error' THEN 'null' ELSE 'true' END, '}')::JSON AS doc FROM events
), t AS (SELECT regexp_replace(fullkey, '\[[0-9]+\]', '[*]', 'g') AS path, type FROM d, json_tree(d.doc))
SELECT path, CASE WHEN type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'number' WHEN type = 'VARCHAR' THEN 'text' ELSE lower(type) END
  AS type, count(*) AS rows
FROM t GROUP BY 1, 2
""",
)
def paths_of_variants(spark: SparkSession, sf: str) -> DataFrame:
    """All paths of a nested document made of each event."""
    ok = F.when(F.col("event_type") == "error", "null").otherwise("true")
    text = F.concat(
        F.lit('{"props": '), "props", F.lit(', "tags": ["'), "event_type", F.lit('", null, ['),
        F.col("event_id").cast("string"), F.lit(', 1.5]], "ok": '), ok, F.lit("}"),
    )
    return variant_paths(table(spark, sf, "events").select(F.try_parse_json(text).alias("src")))


@query(
    "schema_merge_rescue",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(NULL AS VARCHAR) AS c_custkey,
       CAST(NULL AS VARCHAR) AS rescued_segment, o_orderpriority AS rescued_priority, 5 AS rescued_fields
FROM orders
UNION ALL
SELECT NULL, CAST(c_custkey AS VARCHAR), c_mktsegment, NULL, 4 FROM customer
""",
)
def schema_merge_rescue(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and customers read as one drifting table whose contract is the two keys."""
    paths = [f"{sf}/orders.parquet", f"{sf}/customer.parquet"]
    merged = read_with_rescue(spark, ["o_orderkey", "c_custkey"], *paths)
    return merged.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.try_element_at("_rescued", F.lit("c_mktsegment")).alias("rescued_segment"),
        F.try_element_at("_rescued", F.lit("o_orderpriority")).alias("rescued_priority"),
        F.size("_rescued").alias("rescued_fields"),
    )

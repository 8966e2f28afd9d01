"""Dedup, merge, high-water mark, re-sync. Lines and orders stand in for keyed loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import key_counts, latest_per_key
from millrace.operators.joins import count_difference
from millrace.operators.merge import incremental_build, newer_rows
from millrace.operators.partitions import merge_partitions, read_partitions
from millrace.operators.resync import index_manifest, sync_report, sync_status, to_index
from millrace.operators.sampling import first_rows, hash_sample
from millrace.registry import query, table
from millrace.session import new_path

LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "dedup_latest",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1
""",
)
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("l_shipdate").desc(), *[F.col(c) for c in [*LINE_ORDER, "l_returnflag", "l_linestatus"]]]
    latest = latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return latest.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


@query(
    "key_counts",
    """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
  AS distinct_keys FROM lineitem
""",
)
def keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_counts(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


CUT = "1999-01-01"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "loaded_at"]


def _loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Target: orders up to the cut. Source: all orders, the pending ones loaded again as final, later."""
    orders = table(spark, sf, "orders").select(*COLUMNS[:-1], F.col("o_orderdate").alias("loaded_at"))
    target = orders.filter(F.col("loaded_at") < CUT)
    changed = orders.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("F"), "loaded_at": F.expr("loaded_at + INTERVAL 10 YEARS")}
    )
    return target, orders.unionByName(changed)


SOURCE_SQL = f"""
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS loaded_at
  FROM orders WHERE o_orderdate < '{CUT}'
), source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS loaded_at FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'F', o_totalprice, o_orderdate + INTERVAL 10 YEARS
  FROM orders WHERE o_orderstatus = 'P'
), fresh AS (
  SELECT * FROM source WHERE loaded_at > (SELECT coalesce(max(loaded_at), '1900-01-01') FROM target)
)
"""


@query(
    "new_rows_since",
    SOURCE_SQL
    + """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(loaded_at AS DATE) AS VARCHAR) AS loaded_at FROM fresh""",
)
def new_rows_since(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _loads(spark, sf)
    fresh = newer_rows(source, target, "loaded_at")
    return fresh.withColumn("loaded_at", F.col("loaded_at").cast("date").cast("string"))


@query(
    "incremental_merge",
    SOURCE_SQL
    + """
, batch AS (
  SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY loaded_at DESC, o_orderstatus) = 1
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(loaded_at AS DATE) AS VARCHAR) AS loaded_at, NULL AS channel
FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(loaded_at AS DATE) AS VARCHAR), 'web'
FROM batch
""",
)
def incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    """New and re-loaded orders merged into the older ones; the batch brings a new column."""
    target, source = _loads(spark, sf)
    merged = incremental_build(
        source.withColumn("channel", F.lit("web")),
        target,
        ["o_orderkey"],
        "loaded_at",
        [F.col("o_orderstatus")],
    )
    return merged.withColumn("loaded_at", F.col("loaded_at").cast("date").cast("string"))


@query(
    "incremental_partitions",
    """
WITH target AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderdate AS loaded_at FROM orders WHERE o_orderdate < '1999-01-01'
), source AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderdate AS loaded_at FROM orders
  UNION ALL SELECT o_orderkey, 'F', o_orderdate, o_orderdate + INTERVAL 10 YEARS FROM orders
  WHERE o_orderstatus = 'P' AND strftime(o_orderdate, '%Y-%m') = '1996-03'
), batch AS (
  SELECT * FROM source WHERE loaded_at > (SELECT max(loaded_at) FROM target)
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY loaded_at DESC, o_orderstatus) = 1
), merged AS (
  SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch) UNION ALL SELECT * FROM batch
)
SELECT o_orderkey, o_orderstatus, CAST(CAST(loaded_at AS DATE) AS VARCHAR) AS loaded_at,
       strftime(o_orderdate, '%Y-%m') AS month,
       CASE WHEN strftime(o_orderdate, '%Y-%m') IN (SELECT strftime(o_orderdate, '%Y-%m') FROM batch) THEN 2 ELSE 1 END AS version
FROM merged
""",
)
def incremental_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by month, loaded up to a day and then to the end, with one month's pending orders loaded again: only the
    months with new or changed orders are in the second version's files."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate").withColumn("loaded_at", F.col("o_orderdate"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    again = orders.filter((F.col("o_orderstatus") == "P") & (month == "1996-03"))
    again = again.withColumns({"o_orderstatus": F.lit("F"), "loaded_at": F.expr("loaded_at + INTERVAL 10 YEARS")})
    root = new_path(spark, "orders")
    for source in (orders.filter(F.col("loaded_at") < CUT), orders.unionByName(again)):
        merge_partitions(source, root, ["o_orderkey"], "loaded_at", month, [F.col("o_orderstatus")])
    current = read_partitions(spark, root)
    return current.select(
        "o_orderkey", "o_orderstatus", F.col("loaded_at").cast("date").cast("string").alias("loaded_at"),
        F.col("_part").alias("month"), F.col("_version").alias("version"),
    )


@query(
    "count_difference",
    """
SELECT coalesce(l.key, o.key) AS order_key, coalesce(l.n, 0) AS left_rows, coalesce(o.n, 0) AS right_rows
FROM (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1) l
FULL JOIN (SELECT o_orderkey AS key, count(*) AS n FROM orders GROUP BY 1) o ON l.key = o.key
WHERE coalesce(l.n, 0) <> coalesce(o.n, 0)
""",
)
def difference(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys with different row counts in lines and orders."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"))
    return count_difference(lines, orders, ["order_key"])


@query(
    "hash_sample",
    """
SELECT event_id, user_id, event_type FROM events
WHERE substr(md5(event_id || '-7'), 1, 8) < '4ccccccc'
""",
)
def sample(spark: SparkSession, sf: str) -> DataFrame:
    """A reproducible 30 % sample (the operator's purpose)."""
    return hash_sample(table(spark, sf, "events"), ["event_id"], 0.3, 7).select(
        "event_id", "user_id", "event_type"
    )


@query("first_rows", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 200000")
def first(spark: SparkSession, sf: str) -> DataFrame:
    """The first 200,000 events (the operator's purpose)."""
    return first_rows(table(spark, sf, "events").select("event_id", "event_type"), ["event_id"])


@query("first_rows_cut", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 700")
def first_cut(spark: SparkSession, sf: str) -> DataFrame:
    """The first 700 events (the operator's purpose): fewer than the table has."""
    return first_rows(table(spark, sf, "events").select("event_id", "event_type"), ["event_id"], 700)


@query("hash_sample_all", "SELECT event_id, user_id, event_type FROM events")
def sample_all(spark: SparkSession, sf: str) -> DataFrame:
    """A share of 1 keeps every row."""
    return hash_sample(table(spark, sf, "events"), ["event_id"], 1.0, 7).select("event_id", "user_id", "event_type")


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """An older index: no French documents yet, other texts from src0, and some documents since deleted."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    old = docs.filter("lang <> 'fr'").withColumn(
        "text", F.when(F.col("source") == "src0", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    )
    gone = docs.filter("lang = 'de'").withColumn("doc_id", -F.col("doc_id") - 1)
    return index_manifest(old.unionByName(gone), "doc_id", "text")


STATUS_SQL = """
WITH status AS (
  SELECT doc_id, CASE WHEN lang = 'fr' THEN 'new' WHEN source = 'src0' THEN 'modified' ELSE 'unchanged' END
    AS status FROM documents
  UNION ALL SELECT -doc_id - 1, 'deleted' FROM documents WHERE lang = 'de'
)
"""


@query("doc_resync", STATUS_SQL + "SELECT doc_id, status FROM status")
def doc_resync(spark: SparkSession, sf: str) -> DataFrame:
    return sync_status(table(spark, sf, "documents"), _manifest(spark, sf), "doc_id", "text")


@query(
    "doc_resync_report",
    STATUS_SQL
    + """
SELECT count(*) FILTER (WHERE status <> 'deleted') AS scanned, count(*) FILTER (WHERE status = 'new') AS new,
       count(*) FILTER (WHERE status = 'modified') AS modified,
       count(*) FILTER (WHERE status = 'unchanged') AS unchanged,
       count(*) FILTER (WHERE status = 'deleted') AS deleted FROM status
""",
)
def doc_resync_report(spark: SparkSession, sf: str) -> DataFrame:
    return sync_report(doc_resync(spark, sf))


@query(
    "doc_to_index",
    """
SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE lang = 'fr' OR source = 'src0'
""",
)
def doc_to_index(spark: SparkSession, sf: str) -> DataFrame:
    pending = to_index(table(spark, sf, "documents"), _manifest(spark, sf), "doc_id", "text")
    return pending.select("doc_id", "content_hash")


@query(
    "doc_resync_nulls",
    """
SELECT doc_id, CASE WHEN lang = 'es' THEN 'new' WHEN lang = 'de' THEN 'modified' ELSE 'unchanged' END AS status,
       lang IN ('es', 'de') AS pending
FROM documents
""",
)
def doc_resync_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Texts lost: French ones were null before too, German ones have become null, Spanish ones are new."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    nothing = F.lit(None).cast("string")
    old = docs.filter("lang <> 'es'").withColumn("text", F.when(F.col("lang") == "fr", nothing).otherwise(F.col("text")))
    new = docs.withColumn("text", F.when(F.col("lang").isin("fr", "de"), nothing).otherwise(F.col("text")))
    manifest = index_manifest(old, "doc_id", "text")
    pending = to_index(new, manifest, "doc_id", "text").select("doc_id", F.lit(True).alias("pending"))
    status = sync_status(new, manifest, "doc_id", "text").join(pending, "doc_id", "left")
    return status.select("doc_id", "status", F.coalesce("pending", F.lit(False)).alias("pending"))

"""Readers and sinks: the given tables written out in each form and read back, all rows compared."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import class_from_file
from millrace.functions.columns import missing_columns, normalize_names, require_columns
from millrace.functions.rules import keep_rejects, request_rules
from millrace.operators.profile import dataset_rows
from millrace.plans.complaints import ingest, optional_counts
from millrace.plans.features import run_events, run_items, run_trips
from millrace.plans.training import feature_vector
from millrace.registry import query, table
from millrace.session import new_path
from millrace.sources import readers, writers

# The wine measures, taken from lines: name in the file and the line's value.
WINE_FROM_LINES = {
    "fixed acidity": "3 + l_quantity / 4",
    "volatile acidity": "l_discount * 10",
    "citric acid": "l_tax * 10",
    "residual sugar": "l_quantity",
    "chlorides": "l_tax",
    "free sulfur dioxide": "l_quantity * 2",
    "total sulfur dioxide": "l_quantity * 5",
    "density": "0.99 + l_tax / 10",
    "pH": "3 + l_discount",
    "sulphates": "l_discount * 20 + 0.25",
    "alcohol": "9 + l_tax * 25",
    "quality": "CAST(3 + l_linenumber % 7 AS INT)",
}


def _wine_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Two CSV folders: red files in the usual column order, white files in the reverse order."""
    lines = table(spark, sf, "lineitem").select(
        *[F.expr(value).alias(name) for name, value in WINE_FROM_LINES.items()], "l_returnflag"
    )
    base = new_path(spark, "shared-wine")
    paths = f"{base}/winequality-red.csv", f"{base}/winequality-white.csv"
    columns = list(WINE_FROM_LINES)
    for path, is_red, names in ((paths[0], True, columns), (paths[1], False, columns[::-1])):
        side = lines.filter((F.col("l_returnflag") == "R") if is_red else (F.col("l_returnflag") != "R"))
        side.select(*names).write.csv(path, sep=";", header=True)
    return paths


WINE_SQL = ",\n       ".join(
    f'{value.replace("AS INT)", "AS INTEGER)")} AS "{"pH" if name == "pH" else name.replace(" ", "_")}"'
    for name, value in WINE_FROM_LINES.items()
)


@query(
    "read_wine_csv",
    f"SELECT {WINE_SQL}, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS wine_type FROM lineitem",
)
def read_wine_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Semicolon files with a header, columns by name in either order, tagged red or white."""
    return readers.read_wine_pair(spark, *_wine_files(spark, sf))


@query(
    "wine_feature_table",
    """
SELECT 3 + l_quantity / 4 AS fixed_acidity, CAST(3 + l_linenumber % 7 AS INTEGER) AS quality,
       CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS wine_type,
       round((3 + l_quantity / 4) + l_discount * 10 + l_tax * 10, 6) AS total_acidity
FROM lineitem
""",
)
def wine_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files to a feature table partitioned by class, read as training data from the stored table."""
    red, white = _wine_files(spark, sf)
    pair = readers.read_training_data(spark, "csv", (red, white))
    wide = pair.withColumn("total_acidity", F.round(F.expr("fixed_acidity + volatile_acidity + citric_acid"), 6))
    path = new_path(spark, "wine-features")
    writers.write_parquet(wide, path, ["wine_type"], "wine", red)
    stored = readers.read_training_data(spark, "auto", (red, white), path)
    return stored.select("fixed_acidity", "quality", "wine_type", "total_acidity")


@query(
    "class_from_file_name",
    """
SELECT page_id, CASE WHEN contains(regexp_extract(url, '([^/]*)$', 1), '7') THEN 'seven' ELSE 'other' END AS class
FROM pages
""",
)
def class_from_file_name(spark: SparkSession, sf: str) -> DataFrame:
    """A class by the base name alone: a 7 in the host or a folder does not count."""
    return table(spark, sf, "pages").select("page_id", class_from_file("url", "7", "seven", "other").alias("class"))


TEXT_CSV = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
       CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 4 THEN NULL WHEN 1 THEN 'two' || chr(10) || 'lines, "quoted"'
            ELSE o_orderpriority END AS note,
       CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_orderstatus END AS status,
       o_orderkey % 7 = 3 AND o_orderkey % 5 <> 4 AS malformed
FROM orders
"""


@query("read_text_csv", TEXT_CSV)
def read_text_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Text files with null tokens, quoted line breaks, short lines, and lines with one to twelve surplus
    fields, of which empty ones are no fault."""
    key = F.col("o_orderkey")
    token = F.element_at(F.array(*[F.lit(t) for t in ("NA", "N/A", "null", '""', "")]), (F.floor(key / 5) % 5 + 1).cast("int"))
    note = (
        F.when(key % 5 == 0, token)
        .when(key % 5 == 1, F.lit('"two\nlines, ""quoted"""'))
        .otherwise(F.col("o_orderpriority"))
    )
    full = F.concat_ws(",", key.cast("string"), note, "o_orderstatus")
    surplus = F.concat(F.repeat(F.lit(","), (key % 12 + 1).cast("int")), F.when(key % 7 == 3, "lost").otherwise(""))
    line = F.when(key % 5 == 4, key.cast("string")).when(key % 7 >= 3, F.concat(full, surplus)).otherwise(full)
    orders = table(spark, sf, "orders").select((key % 16).alias("bucket"), line.alias("line"))
    files = orders.groupBy("bucket").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("lines"))
    path = new_path(spark, "text-csv")
    body = F.concat(F.lit("order_key,note,status\n"), "lines")
    files.select("bucket", body.alias("value")).write.partitionBy("bucket").text(path)
    good, bad = readers.split_malformed(readers.read_text_csv(spark, f"{path}/*/*.txt"))
    both = good.withColumn("malformed", F.lit(False)).unionByName(bad.drop("_overflow").withColumn("malformed", F.lit(True)))
    return readers.apply_null_tokens(both)


@query("read_splits", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as three split folders and read as one table."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    base = new_path(spark, "splits")
    for k, split in enumerate(readers.SPLITS):
        writers.write_parquet(orders.filter(F.col("o_orderkey") % 3 == k), f"{base}/{split}")
    return readers.read_splits(spark, base)


@query(
    "write_splits",
    """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'valid' ELSE 'test' END AS split,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderstatus END AS extra FROM orders
""",
)
def write_splits(spark: SparkSession, sf: str) -> DataFrame:
    """One table partitioned by split; a column of one split is null in the others."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    parts = {s: orders.filter(F.col("o_orderkey") % 3 == k) for k, s in enumerate(readers.SPLITS)}
    parts = {s: f.withColumnRenamed("o_orderstatus", "extra") if s == "test" else f.drop("o_orderstatus") for s, f in parts.items()}
    path = new_path(spark, "split-table")
    writers.write_splits(parts, path)
    return spark.read.parquet(path).select("o_orderkey", "split", "extra")


@query(
    "read_current_forms",
    """
SELECT form, o_orderkey, o_totalprice, o_custkey FROM orders CROSS JOIN (VALUES ('csv'), ('parquet')) t(form)
""",
)
def read_current_forms(spark: SparkSession, sf: str) -> DataFrame:
    """The current table from Parquet, and from CSV with the reference's types."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    base = new_path(spark, "current")
    orders.write.parquet(f"{base}/rows.parquet")
    orders.write.csv(f"{base}/rows-csv", header=True)
    found = [
        readers.read_current(spark, f"{base}/{name}", orders).withColumn("form", F.lit(form))
        for name, form in (("rows.parquet", "parquet"), ("rows-csv", "csv"))
    ]
    return found[0].unionByName(found[1])


@query(
    "read_case_files",
    """
SELECT 'c' || item_id AS id, text AS question, list_slice(string_split(text, ' '), 1, 2) AS expected_keywords,
       item_id % 7 = 0 AS expect_blocked, CASE WHEN item_id % 3 > 0 THEN 'keyword' END AS category FROM benchmark
""",
)
def read_case_files(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluation cases as JSON arrays of forty cases a file."""
    case = F.struct(
        F.concat(F.lit("c"), F.col("item_id").cast("string")).alias("id"),
        F.col("text").alias("question"),
        F.slice(F.split("text", " "), 1, 2).alias("expected_keywords"),
        (F.col("item_id") % 7 == 0).alias("expect_blocked"),
        F.when(F.col("item_id") % 3 > 0, "keyword").alias("category"),
    )
    files = table(spark, sf, "benchmark").groupBy(F.floor(F.col("item_id") / 40).alias("file"))
    path = new_path(spark, "cases")
    files.agg(F.to_json(F.collect_list(case)).alias("value")).write.partitionBy("file").text(path)
    return readers.read_cases(spark, f"{path}/*/*.txt")


def _text_files(spark: SparkSession, sf: str) -> str:
    path = new_path(spark, "texts")
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("value"))
    items.repartition("item_id").write.partitionBy("item_id").text(path)
    return path


@query("read_text_files", "SELECT item_id, text || chr(10) AS text FROM benchmark")
def read_text_files(spark: SparkSession, sf: str) -> DataFrame:
    """One text file per item, whole texts with their paths."""
    found = readers.read_documents(spark, _text_files(spark, sf), "*.txt")
    item = F.regexp_extract("path", "item_id=(-?[0-9]+)/", 1).cast("long")
    return found.select(item.alias("item_id"), "text")


@query("list_text_files", "SELECT item_id, CAST(strlen(text) + 1 AS BIGINT) AS length FROM benchmark")
def list_text_files(spark: SparkSession, sf: str) -> DataFrame:
    found = readers.list_documents(spark, _text_files(spark, sf), "*.txt")
    item = F.regexp_extract("path", "item_id=(-?[0-9]+)/", 1).cast("long")
    return found.select(item.alias("item_id"), "length")


@query(
    "first_files",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN (SELECT DISTINCT c_mktsegment FROM customer ORDER BY 1 LIMIT 2)",
)
def first_files(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the first two files by name, one file per segment."""
    path = new_path(spark, "segments")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customers.repartition("c_mktsegment").write.partitionBy("c_mktsegment").parquet(path)
    return spark.read.parquet(*readers.first_files(spark, path, 2)).select("c_custkey", "c_name")


@query(
    "sink_partitioned",
    """
SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority,
       (SELECT count(*) FROM orders) AS row_count,
       CAST((SELECT count(*) FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)) AS BIGINT) AS partitions
FROM orders
""",
)
def sink_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Overwrite by two columns, after an older version with other rows; metrics beside the rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    path = new_path(spark, "orders")
    writers.write_parquet(orders.limit(10), path, ["o_orderpriority", "o_orderstatus"])
    metrics = writers.write_parquet(orders, path, ["o_orderstatus", "o_orderpriority"], "orders", sf)
    return spark.read.parquet(path).select(
        *orders.columns,
        F.lit(metrics["row_count"]).cast("long").alias("row_count"),
        F.lit(metrics["partitions"]).cast("long").alias("partitions"),
    )


@query(
    "sink_metrics",
    "SELECT 'lines' AS dataset, count(*) AS row_count, count(DISTINCT l_returnflag) AS partitions FROM lineitem",
)
def sink_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Run metrics written as JSON and read back."""
    metrics = writers.write_parquet(table(spark, sf, "lineitem"), new_path(spark, "lines"), ["l_returnflag"], "lines")
    path = new_path(spark, "metrics")
    writers.write_metrics(spark, metrics, path)
    return spark.read.json(path).select("dataset", "row_count", "partitions")


@query(
    "sink_trip_days",
    """
SELECT CAST(o_orderdate AS DATE) AS pickup_date, count(*) AS trips FROM orders
WHERE o_orderkey % 4 <> 3 AND o_totalprice < 250000 GROUP BY 1
""",
)
def sink_trip_days(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as trips of ten minutes, written by day through the trip job."""
    trips = table(spark, sf, "orders").select(
        F.lit(2.0).alias("trip_distance"),
        (F.col("o_totalprice") / 500).alias("fare_amount"),
        (F.col("o_orderkey") % 4 + 4).cast("double").alias("passenger_count"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.expr("o_orderdate + INTERVAL 10 MINUTES").alias("tpep_dropoff_datetime"),
        F.col("o_custkey").alias("PULocationID"),
        F.col("o_custkey").alias("DOLocationID"),
    )
    raw, out = new_path(spark, "trips"), new_path(spark, "trip-features")
    trips.write.parquet(raw)
    run_trips(spark, raw, out)
    return spark.read.parquet(out).groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))


@query(
    "sink_event_days",
    """
SELECT user_id, event_id AS item_id, CAST(event_id % 6 AS DOUBLE) AS rating, CAST(ts AS DATE) AS date FROM events
""",
)
def sink_event_days(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "user_id", F.col("event_id").alias("item_id"), (F.col("event_id") % 6).cast("double").alias("rating"), "ts"
    )
    out = new_path(spark, "event-days")
    run_events(events, out, item="item_id", timestamp="ts")
    return spark.read.parquet(out).select("user_id", "item_id", "rating", "date")


@query("sink_items", "SELECT p_partkey AS item_id, p_name AS title, p_retailprice AS price_raw FROM part")
def sink_items(spark: SparkSession, sf: str) -> DataFrame:
    """Item metadata without partitions."""
    parts = table(spark, sf, "part").withColumn("author", F.lit(None).cast("string"))
    out = new_path(spark, "items")
    names = {"item": "p_partkey", "title": "p_name", "categories": "p_type", "price": "p_retailprice"}
    run_items(parts, out, **names, main_category="p_type", store="p_brand")
    return spark.read.parquet(out).select("item_id", "title", "price_raw")


def _texts_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as text rows; some keys are blank and some dates do not parse."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(key % 400 == 7, "  ").otherwise(key.cast("string")).alias("Complaint ID"),
        F.when(key % 50 == 3, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Date received"),
    )


@query(
    "sink_ingest",
    """
SELECT CASE WHEN o_orderkey % 50 = 3 THEN 'unknown' ELSE strftime(o_orderdate, '%Y') END AS year,
       CASE WHEN o_orderkey % 50 = 3 THEN '00' ELSE strftime(o_orderdate, '%m') END AS month, count(*) AS rows
FROM orders GROUP BY 1, 2
""",
)
def sink_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Year and month folders, read back as they are named."""
    out = new_path(spark, "complaints")
    ingest(_texts_of_orders(spark, sf), out)
    stored = spark.read.schema("`Complaint ID` string, `Date received` string, year string, month string").parquet(out)
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "sink_ingest_manifest",
    """
SELECT count(*) AS row_count, count(*) FILTER (WHERE o_orderkey % 400 = 7) AS null_or_blank_keys,
       count(*) AS stored, true AS skipped FROM orders
""",
)
def sink_ingest_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest as written beside the table, the rows there are, and that a second run is skipped."""
    out = new_path(spark, "complaints")
    rows = _texts_of_orders(spark, sf)
    ingest(rows, out)
    skipped = ingest(rows, out, skip_existing=True) is None
    manifest = spark.read.json(f"{out}.manifest")
    return manifest.select(
        "row_count", "null_or_blank_keys", F.lit(dataset_rows(spark, out)).cast("long").alias("stored"),
        F.lit(skipped).alias("skipped"),
    )


@query("sink_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey > 3")
def sink_table(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table replaced by one with other columns."""
    path = new_path(spark, "table")
    name = "millrace_" + path.rsplit("-", 1)[1]
    nations = table(spark, sf, "nation")
    writers.write_table(nations.select("n_nationkey"), name, path)
    writers.write_table(nations.filter("n_nationkey > 3"), name, path)
    return spark.table(name).select("n_nationkey", "n_name", "n_regionkey")


@query("sink_table_from_query", 'SELECT s_suppkey AS supplier_key, s_name AS "name" FROM supplier WHERE s_acctbal > 0')
def sink_table_from_query(spark: SparkSession, sf: str) -> DataFrame:
    """A table made from a query whose headers are mapped to plain names."""
    path = new_path(spark, "ctas")
    name = "millrace_" + path.rsplit("-", 1)[1]
    view = f"{name}_source"
    writers.publish_layer(table(spark, sf, "supplier"), view, "staging")
    writers.table_from_query(
        spark, f"SELECT s_suppkey AS `Supplier key`, s_name AS `Name?` FROM {view} WHERE s_acctbal > 0", name, "landing", path
    )
    return spark.table(name)


@query(
    "sink_report",
    "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1",
)
def sink_report(spark: SparkSession, sf: str) -> DataFrame:
    """A report as JSON lines, read back."""
    report = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    path = new_path(spark, "report")
    writers.write_report(report, path)
    return spark.read.json(path).select("segment", "customers")


@query(
    "column_names",
    """
SELECT rule, name, count(*) AS rows FROM orders CROSS JOIN (VALUES ('features', 'order_key'), ('features', 'pH'),
  ('landing', 'order_key'), ('landing', 'ph_value'), ('plain', 'Order_Key'), ('plain', 'PH-value?')) t(rule, name)
GROUP BY 1, 2
""",
)
def column_names(spark: SparkSession, sf: str) -> DataFrame:
    """The three name rules on the headers of the orders, each name with the rows under it."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    orders = table(spark, sf, "orders")
    found = []
    for rule, second in (("features", "PH"), ("landing", " PH-value? "), ("plain", "PH-value?")):
        named = normalize_names(orders.select(key.alias(" Order Key "), status.alias(second)), rule)
        cells = F.array(*[F.struct(F.lit(name).alias("name"), F.col(f"`{name}`").isNotNull().alias("there")) for name in named.columns])
        counted = named.select(F.inline(cells)).filter("there").groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
        found.append(counted.withColumn("rule", F.lit(rule)))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "required_columns",
    """
SELECT 'o_rating,o_zone' AS missing, 'required columns not found: [''o_rating'', ''o_zone'']' AS message,
       false AS optional_built, count(*) AS rows FROM orders
""",
)
def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that orders lack, the error that names them, and a mart that is left out for them."""
    orders = table(spark, sf, "orders")
    wanted = ["o_zone", "o_orderkey", "o_rating"]
    try:
        require_columns(orders, wanted)
        message = ""
    except ValueError as error:
        message = str(error)
    built = optional_counts(orders, "o_orderdate", "o_product") is not None
    return orders.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(",".join(missing_columns(orders, wanted))).alias("missing"), F.lit(message).alias("message"),
        F.lit(built).alias("optional_built"), "rows",
    )


@query(
    "request_rejects",
    """
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity < 10 THEN 'sulphates' END,
       CASE WHEN l_tax = 0 THEN 'density' END, CASE WHEN l_linenumber > 5 THEN 'pH' END,
       CASE WHEN l_returnflag = 'N' THEN 'wine_type' END) AS failed
FROM lineitem WHERE l_quantity < 10 OR l_tax = 0 OR l_linenumber > 5 OR l_returnflag = 'N'
""",
)
def request_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as scoring requests: the ones outside the ranges, with the rules they break."""
    rules = request_rules(non_negative=("sulphates",))
    asked = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") - 10).alias("sulphates"), F.col("l_tax").alias("density"),
        F.when(F.col("l_linenumber") > 5, 14.5).otherwise(14.0).alias("pH"),
        F.when(F.col("l_returnflag") == "N", 2).otherwise(1).alias("wine_type"),
    )
    rejected = keep_rejects(asked, rules)
    return rejected.select("l_orderkey", "l_linenumber", F.array_join("failed_rules", ",").alias("failed"))


@query(
    "feature_matrix",
    "SELECT l_orderkey, l_linenumber, [l_tax, l_quantity, CAST(l_linenumber AS DOUBLE)] AS features FROM lineitem",
)
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The assembled feature vector, in the order asked for."""
    rows = feature_vector(table(spark, sf, "lineitem"), ["l_tax", "l_quantity", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("features"))

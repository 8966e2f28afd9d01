"""Schema-drift-tolerant landing: rows as variants, header spellings, rescued columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import variant_text
from millrace.session import materialize

# Header spellings of the complaint columns.
COMPLAINT_SPELLINGS = {
    "complaint_id": ["Complaint ID", "COMPLAINT_ID", "complaint_id"],
    "date_received": ["Date received", "DATE_RECEIVED", "date_received"],
    "product": ["Product", "PRODUCT", "product"],
    "sub_product": ["Sub-product", "SUB_PRODUCT", "sub_product"],
    "issue": ["Issue", "ISSUE", "issue"],
    "sub_issue": ["Sub-issue", "SUB_ISSUE", "sub_issue"],
    "consumer_complaint_narrative": [
        "Consumer complaint narrative",
        "CONSUMER_COMPLAINT_NARRATIVE",
        "consumer_complaint_narrative",
    ],
    "company_public_response": ["Company public response", "COMPANY_PUBLIC_RESPONSE"],
    "company": ["Company", "COMPANY", "company"],
    "state": ["State", "STATE", "state"],
    "zip_code": ["ZIP code", "ZIP_CODE", "zip_code"],
    "tags": ["Tags", "TAGS"],
    "consumer_consent_provided": ["Consumer consent provided?", "CONSUMER_CONSENT_PROVIDED"],
    "submitted_via": ["Submitted via", "SUBMITTED_VIA", "submitted_via"],
    "date_sent_to_company": ["Date sent to company", "DATE_SENT_TO_COMPANY"],
    "company_response_to_consumer": ["Company response to consumer", "COMPANY_RESPONSE_TO_CONSUMER"],
    "timely_response": ["Timely response?", "TIMELY_RESPONSE", "timely_response"],
    "consumer_disputed": ["Consumer disputed?", "CONSUMER_DISPUTED", "consumer_disputed"],
}

LINEAGE = ["filename", "file_row_number", "loaded_at"]


def land(raw: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Rows of a Parquet scan as one variant each, with file name, row number in the file and load time."""
    when = F.current_timestamp() if loaded_at is None else loaded_at
    return raw.select(
        F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("src"),
        F.col("_metadata.file_name").alias("filename"),
        (F.col("_metadata.row_index") + 1).alias("file_row_number"),
        when.cast("timestamp_ntz").alias("loaded_at"),
    )


def land_parquet(spark: SparkSession, path: str, loaded_at: Column | None = None) -> DataFrame:
    """Land the ``.parquet`` files under a path.

    Schemas are merged over all files: by default a scan knows the columns of one file only, and a
    column under another spelling would be lost. A column a file lacks is a null in its variants.
    """
    files = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", True)
    return land(files.parquet(path), loaded_at)


def typed_view(landing: DataFrame, spellings: Mapping[str, Sequence[str]] = COMPLAINT_SPELLINGS) -> DataFrame:
    """Text columns from the landing variants, whichever header spelling a file used."""
    return landing.select(*[variant_text("src", *names).alias(c) for c, names in spellings.items()], *LINEAGE)


def variant_schema(landing: DataFrame, source: str = "src") -> DataFrame:
    """One row with the merged schema of all landed variants."""
    return landing.agg(F.schema_of_variant_agg(source).alias("variant_schema"))


def _variant_type(value: str) -> Column:
    """object, array, number, text, boolean, null, or another type's own name."""
    name = F.lower(F.regexp_extract(F.schema_of_variant(value), r"^(\w+)", 1))
    known = F.when(name == "void", "null").when(name == "string", "text")
    return known.when(name.isin("bigint", "decimal", "double", "float", "int", "smallint", "tinyint"), "number").otherwise(name)


def variant_paths(landing: DataFrame, source: str = "src") -> DataFrame:
    """Rows ``path, type, rows`` of all values in the landed variants, however deep they lie.

    Members are ``.name``, elements of arrays ``[*]``; nulls are a type. Each level is exploded once and counted; the
    loop ends with the level that holds no object and no array.
    """
    spark = landing.sparkSession
    level = landing.select(F.lit("$").alias("path"), F.col(source).alias("value")).filter(F.col(source).isNotNull())
    counts = None
    while True:
        level = level.withColumn("type", _variant_type("value"))
        found = materialize(level.groupBy("path", "type").agg(F.count(F.lit(1)).alias("rows")), "paths")
        counts = found if counts is None else counts.unionByName(found)
        if found.filter(F.col("type").isin("object", "array")).isEmpty():
            return counts
        inner = level.filter(F.col("type").isin("object", "array")).select("path", "value")
        level = spark.sql(
            "SELECT concat(path, coalesce(concat('.', e.key), '[*]')) AS path, e.value FROM {inner}, LATERAL variant_explode(value) AS e",
            inner=inner,
        )


def read_with_rescue(spark: SparkSession, contract: Sequence[str], *paths: str) -> DataFrame:
    """Files of differing schemas as one frame of the contract columns.

    Values of any other column are kept as text in the map ``_rescued``, which is null where a row
    has none.
    """
    merged = spark.read.option("mergeSchema", True).parquet(*paths)
    extra = [name for name in merged.columns if name not in contract]
    kept = [F.col(f"`{c}`") if c in merged.columns else F.lit(None).cast("string").alias(c) for c in contract]
    if not extra:
        return merged.select(*kept, F.lit(None).cast("map<string,string>").alias("_rescued"))
    pairs = [item for name in extra for item in (F.lit(name), F.col(f"`{name}`").cast("string"))]
    found = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    return merged.select(*kept, F.when(F.cardinality(found) > 0, found).alias("_rescued"))

"""Sources: CSV, Parquet, JSON and document readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import NULL_TOKENS, tokens_to_null
from millrace.functions.columns import normalize_names

# Columns of the wine files, in file order, and the split folders.
WINE_COLUMNS = [
    "fixed acidity",
    "volatile acidity",
    "citric acid",
    "residual sugar",
    "chlorides",
    "free sulfur dioxide",
    "total sulfur dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
    "quality",
]
SPLITS = ["train", "valid", "test"]

_OVERFLOW = "_overflow"
_RAW = "_raw_line"


def wine_schema() -> T.StructType:
    """Schema of the wine files: doubles, and an integer quality."""
    fields = [T.StructField(name, T.DoubleType()) for name in WINE_COLUMNS[:-1]]
    return T.StructType([*fields, T.StructField("quality", T.IntegerType())])


def read_wine(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Semicolon-separated measures with a header; columns go by name, in any order.

    The header decides the order in which fields are read, so types need no inference pass. A header
    column that the schema lacks is read as text; a schema column that the header lacks is an error.
    """
    wanted = schema or wine_schema()
    kinds = {field.name: field.dataType for field in wanted}
    header = spark.read.csv(path, sep=";", header=True).columns
    if lacking := [name for name in kinds if name not in header]:
        raise ValueError(f"columns not in the header: {lacking}")
    ordered = T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in header])
    # With enforceSchema off, a file whose header differs from this one is an error, not a mix-up.
    rows = spark.read.csv(path, sep=";", header=True, schema=ordered, enforceSchema=False)
    return rows.select(*kinds, *[name for name in header if name not in kinds])


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One frame over one or more Parquet files or folders."""
    return spark.read.parquet(*paths)


def read_splits(spark: SparkSession, base: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """The split folders under ``base`` as one frame."""
    return spark.read.parquet(*[f"{base.rstrip('/')}/{split}" for split in splits])


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as text, with a column ``_overflow`` that is non-null on lines with too many fields.

    Quoted line breaks and doubled quotes are understood; short lines are filled with null. Surplus
    fields that are all empty do no harm: such a line is a good one. Spark keeps the raw text of every
    line whose number of fields differs from the header's; what follows the last column decides, however
    many fields that is. Pass ``columns`` to save the look at the header.
    """
    options = dict(header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    names = list(columns) if columns else spark.read.csv(path, **options).columns
    fields = [T.StructField(name, T.StringType()) for name in [*names, _RAW]]
    lines = spark.read.csv(
        path, schema=T.StructType(fields), mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW, **options
    )
    # One field: quoted text with doubled quotes, or anything without a comma. Nothing to backtrack.
    field = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^,]*+)'
    known = rf"(?s)^{field}(?:,{field}){{{len(names) - 1}}}"
    surplus = F.regexp_replace(F.col(_RAW), known, "")
    lost = F.col(_RAW).rlike(f"{known},") & (F.regexp_replace(surplus, r'[,\s"]', "") != "")
    # Spark refuses to read the raw line alone; the first column's length, never negative, goes with it.
    first = F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0
    content = F.when(lost & first, surplus)
    return lines.select(*[F.col(f"`{name}`") for name in names], content.alias(_OVERFLOW))


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the marker column, and the malformed rows."""
    return raw.filter(F.col(_OVERFLOW).isNull()).drop(_OVERFLOW), raw.filter(F.col(_OVERFLOW).isNotNull())


def apply_null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Null for every text field that is exactly a null token."""
    return df.select(
        *[
            tokens_to_null(field.name, tokens).alias(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.col(field.name)
            for field in df.schema
        ]
    )


def read_wine_pair(spark: SparkSession, red_path: str, white_path: str) -> DataFrame:
    """Red and white files as one frame with an integer ``wine_type``: 0 red, 1 white."""
    red = normalize_names(read_wine(spark, red_path)).withColumn("wine_type", F.lit(0))
    white = normalize_names(read_wine(spark, white_path)).withColumn("wine_type", F.lit(1))
    return red.unionByName(white)


def read_training_data(
    spark: SparkSession,
    mode: str = "auto",
    csv_paths: tuple[str, str] | None = None,
    store_path: str | None = None,
) -> DataFrame:
    """Training rows from the feature table or from the CSV pair; ``auto`` prefers a named table."""
    if mode not in ("auto", "csv", "feature_store"):
        raise ValueError(f"unknown source mode: {mode}")
    if mode == "feature_store" or (mode == "auto" and store_path):
        if not store_path:
            raise ValueError("the feature table's path is needed")
        return read_parquet(spark, store_path)
    if not csv_paths:
        raise ValueError("the two CSV paths are needed")
    return read_wine_pair(spark, *csv_paths)


def read_current(
    spark: SparkSession, path: str | None, reference: DataFrame, fraction: float = 0.3, seed: int = 7
) -> DataFrame:
    """Rows to compare with the reference: a Parquet path, a CSV path, or else a sample of the reference."""
    if path is None:
        return reference.sample(fraction=fraction, seed=seed)
    if path.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path)
    types = {field.name: field.dataType for field in reference.schema}
    text = spark.read.csv(path, header=True)
    return text.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in text.columns]
    )


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases from one JSON array."""
    schema = (
        "id string, question string, expected_keywords array<string>, "
        "expect_blocked boolean, category string"
    )
    return spark.read.json(path, schema=schema, multiLine=True)


def read_documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per text file: its path and its whole text. Spark scans pass over empty files."""
    files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return files.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def list_documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Non-empty files under a prefix with size and time; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return files.option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")


def first_files(spark: SparkSession, path: str, n: int, pattern: str = "*.parquet") -> list[str]:
    """The first ``n`` file paths by name."""
    listing = list_documents(spark, path, pattern).orderBy("path").limit(n)
    return [row.path for row in listing.select("path").collect()]

"""Integer codes for categories, in first-seen order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import with_rank
from millrace.session import materialize


def category_codes(df: DataFrame, columns: Sequence[str], order_key: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, code)``: code 0 is the value seen first by ``order_key``.

    Values first seen at the same key are numbered by value. All but the last column of the key should
    be coarse (a split, a file). All columns are numbered in one pass: values are reduced to their first
    occurrence before the shuffle, and the numbering of a column with very many values is spread over
    range partitions.
    """
    *coarse, fine = order_key
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    long = df.select(*order_key, F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    # The minimum of one plain column stays in a hash aggregate; that of a struct has to be sorted, so
    # it is taken of what the first aggregate leaves over.
    first = long.groupBy("column", "value", *coarse).agg(F.min(fine).alias(fine))
    if coarse:
        first = first.groupBy("column", "value").agg(F.min(F.struct(*order_key)).alias("_at"))
    else:
        first = first.withColumnRenamed(fine, "_at")
    ranked = with_rank(first, ["_at", "value"], "_rank", groups=["column"])
    return ranked.select("column", "value", (F.col("_rank") - 1).cast("int").alias("code"))


def encode_categories(df: DataFrame, columns: Sequence[str], order_key: Sequence[str]) -> DataFrame:
    """Replace each column ``c`` by its code ``c_idx``; a null value gets -1."""
    codes = materialize(category_codes(df, columns, order_key), "codes")
    encoded = df
    for c in columns:
        one = codes.filter(F.col("column") == c).select(
            F.col("value").alias(f"_{c}"), F.col("code").alias(f"{c}_code")
        )
        encoded = (
            encoded.join(one, F.col(c).cast("string") == F.col(f"_{c}"), "left")
            .withColumn(f"{c}_idx", F.coalesce(F.col(f"{c}_code"), F.lit(-1)))
            .drop(f"_{c}", f"{c}_code")
        )
    return encoded.drop(*columns)

"""Data tests. Each yields result rows ``(test, column, failures, severity, status)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import is_blank

# Product names a complaint may have, freshness limits in days, null-key share.
PRODUCTS = [
    "Credit reporting, credit repair services, or other personal consumer reports",
    "Credit card or prepaid card",
    "Debt collection",
    "Checking or savings account",
    "Mortgage",
    "Vehicle loan or lease",
    "Student loan",
    "Money transfer, virtual currency, or money service",
    "Payday loan, title loan, personal loan, or advance",
    "Credit reporting",
    "Credit card",
    "Bank account or service",
    "Consumer Loan",
    "Prepaid card",
    "Other financial service",
    "Payday loan",
    "Money transfers",
    "Virtual currency",
]
WARN_DAYS = 30
ERROR_DAYS = 90
MAX_NULL_KEY_SHARE = 0.01


class DataTestFailure(ValueError):
    """A data test of severity ``error`` found failures."""


def _status(failures: Column, severity: str) -> Column:
    bad = "fail" if severity == "error" else "warn"
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit(bad))


def _result_rows(one_row: DataFrame, labels: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Turn one row of failure counts into result rows; labels are (alias, test, column, severity)."""
    rows = [
        F.struct(
            F.lit(test).alias("test"),
            F.lit(column).alias("column"),
            F.col(alias).cast("long").alias("failures"),
            F.lit(severity).alias("severity"),
            _status(F.col(alias), severity).alias("status"),
        )
        for alias, test, column, severity in labels
    ]
    return one_row.select(F.inline(F.array(*rows)))


def column_tests(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    accepted_severity: str = "warn",
) -> DataFrame:
    """``not_null`` and ``accepted_values`` tests of any number of columns in one aggregate.

    ``accepted_values`` counts the distinct values outside its list. A null passes it.
    """
    counts, labels = [], []
    for i, c in enumerate(not_null):
        counts.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        labels.append((f"n{i}", "not_null", c, "error"))
    for i, (c, values) in enumerate((accepted or {}).items()):
        counts.append(F.count_distinct(F.when(~F.col(c).isin(*values), F.col(c))).alias(f"a{i}"))
        labels.append((f"a{i}", "accepted_values", c, accepted_severity))
    return _result_rows(df.agg(*counts), labels)


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Non-null keys that occur more than once, with their row count."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def unique_test(df: DataFrame, *keys: str) -> DataFrame:
    """``unique`` test of a key: failures are the repeated keys."""
    counted = repeated_keys(df, *keys).agg(F.count(F.lit(1)).alias("u"))
    return _result_rows(counted, [("u", "unique", ",".join(keys), "error")])


def not_empty_test(df: DataFrame, name: str) -> DataFrame:
    """Fails for a table without rows."""
    counted = df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("e"))
    return _result_rows(counted, [("e", "not_empty", name, "error")])


def row_count_test(df: DataFrame, name: str, minimum: int, severity: str = "error") -> DataFrame:
    """Fails for a table with fewer than ``minimum`` rows; failures are the missing rows."""
    counted = df.agg(F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)).alias("m"))
    return _result_rows(counted, [("m", "min_rows", name, severity)])


def expected_count_test(df: DataFrame, name: str, expected: int) -> DataFrame:
    """Any other row count than the expected one is a warning, an empty table a failure."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    off = F.abs(F.col("n") - expected)
    status = F.when(F.col("n") == 0, "fail").when(off > 0, "warn").otherwise("pass")
    return counted.select(
        F.lit("expected_count").alias("test"),
        F.lit(name).alias("column"),
        off.alias("failures"),
        F.when(F.col("n") == 0, "error").otherwise("warn").alias("severity"),
        status.alias("status"),
    )


def key_share_test(df: DataFrame, key: str, max_share: float = MAX_NULL_KEY_SHARE) -> DataFrame:
    """Fails for an empty table and for a share of null or blank keys above the limit."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_blank(F.col(key))).alias("b"))
    bad = (F.col("n") == 0) | (F.col("b") > F.col("n") * max_share)
    return counted.select(
        F.lit("key_share").alias("test"),
        F.lit(key).alias("column"),
        F.col("b").alias("failures"),
        F.lit("error").alias("severity"),
        F.when(bad, "fail").otherwise("pass").alias("status"),
    )


def freshness_test(
    df: DataFrame, loaded_at: str, as_of: Column, warn_days: int = WARN_DAYS, error_days: int = ERROR_DAYS
) -> DataFrame:
    """Age of the newest row at ``as_of``; ``failures`` is the age in whole days. No rows is a failure."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    seconds = F.unix_timestamp(as_of) - F.unix_timestamp("newest")
    status = (
        F.when(F.col("newest").isNull() | (seconds > error_days * 86400), "fail")
        .when(seconds > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    return newest.select(
        F.lit("freshness").alias("test"),
        F.lit(loaded_at).alias("column"),
        F.floor(seconds / 86400).alias("failures"),
        F.when(status == "warn", "warn").otherwise("error").alias("severity"),
        status.alias("status"),
    )


def combine(*results: DataFrame) -> DataFrame:
    """All result rows as one frame."""
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> None:
    """Raise if a test of severity ``error`` failed; warnings pass."""
    failed = results.filter("status = 'fail'").select("test", "column", "failures").collect()
    if failed:
        raise DataTestFailure("; ".join(f"{r.test}({r.column}): {r.failures}" for r in failed))


def contract(dataset: str, local: DataFrame, copy: DataFrame | None) -> DataFrame:
    """One row comparing the row counts of a dataset and its copy: PASS, FAIL or LOCAL_ONLY."""
    mine = local.agg(F.count(F.lit(1)).alias("local_rows"))
    other = F.lit(None).cast("long") if copy is None else copy.agg(F.count(F.lit(1))).scalar()
    counted = mine.withColumn("copy_rows", other)
    status = (
        F.when(F.col("copy_rows").isNull(), "LOCAL_ONLY")
        .when(F.col("copy_rows") == F.col("local_rows"), "PASS")
        .otherwise("FAIL")
    )
    return counted.select(F.lit(dataset).alias("dataset"), "*", status.alias("status"))


def assert_contract(document: DataFrame) -> None:
    """Stop on FAIL only; a contract without a copy passes."""
    broken = [row.dataset for row in document.filter("status = 'FAIL'").collect()]
    if broken:
        raise DataTestFailure(f"row counts differ from the copy: {broken}")

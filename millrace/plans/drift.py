"""Drift of numeric features between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import running_totals, with_rank
from millrace.session import materialize, stored_side

# Our own limits: a feature drifts if its stability index or its distribution distance is too high.
PSI_LIMIT = 0.2
KS_FACTOR = 1.36  # large-sample 5 % point of the two-sample Kolmogorov-Smirnov distance
DISTANCE_LIMIT = 0.1  # of either distance, from which a feature of a large sample drifts
FEW_VALUES = 5  # a feature of so many values at most is compared value by value
BINS = 10
EMPTY_SHARE = 1e-4
LEAST_SPREAD = 1e-3  # by which an area is divided at least


def _long(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """Distinct non-null values per feature with their counts, in the columns of one side."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(c).try_cast("double").alias("value")) for c in features
    ]
    long = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))
    zero = F.lit(0).cast("long")
    return counts.select(
        "feature",
        "value",
        (F.col("rows") if side == "reference" else zero).alias("ref"),
        (F.col("rows") if side == "current" else zero).alias("cur"),
    )


def _cumulative(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature and distinct value: rows of both sides, and rows up to it."""
    sides = _long(reference, features, "reference").unionByName(_long(current, features, "current"))
    values = sides.groupBy("feature", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    summed = running_totals(values, ["value"], {"ref_upto": "ref", "cur_upto": "cur"}, ["feature"])
    return materialize(summed, "cumulative")


def _table_counts(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """Per feature the table's rows and its non-null values, in one pass."""
    known = [F.count(F.col(c).try_cast("double")).alias(f"n{i}") for i, c in enumerate(features)]
    counts = df.agg(F.count(F.lit(1)).alias("all"), *known)
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col("all").alias(f"{side}_table"), F.col(f"n{i}").alias(f"{side}_rows"))
        for i, c in enumerate(features)
    ]
    return counts.select(F.inline(F.array(*cells)))


def drift_report(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature: counts of values, null shares, stability index over reference deciles,
    distance, drift flag, and the rows of both tables.

    Both statistics come from one table of running counts over the distinct values of each feature. A
    feature without values on a side has no statistics; it has drifted if the other side has values.
    ``features`` is a list written by the caller, so tables with one row per feature are broadcast.
    """
    summed = _cumulative(reference, current, features)
    sizes = materialize(
        _table_counts(reference, features, "reference").join(_table_counts(current, features, "current"), "feature"),
        "sizes",
    )
    placed = summed.join(F.broadcast(sizes), "feature")
    gap = F.abs(
        F.try_divide(F.col("ref_upto"), F.col("reference_rows"))
        - F.try_divide(F.col("cur_upto"), F.col("current_rows"))
    )
    distance = placed.groupBy("feature").agg(F.max(gap).alias("ks"))

    # Decile edge j is the first value with at least j/10 of the reference rows up to it.
    steps = F.sequence(F.lit(1), F.lit(BINS - 1))
    crossed = F.filter(
        steps,
        lambda j: (F.ceil(j * F.col("reference_rows") / BINS) > F.col("ref_upto") - F.col("ref"))
        & (F.ceil(j * F.col("reference_rows") / BINS) <= F.col("ref_upto")),
    )
    edges = placed.select("feature", F.explode(crossed).alias("edge"), "ref_upto", "cur_upto").unionByName(
        sizes.select(
            "feature",
            F.lit(BINS).alias("edge"),
            F.col("reference_rows").alias("ref_upto"),
            F.col("current_rows").alias("cur_upto"),
        )
    )
    before = Window.partitionBy("feature").orderBy("edge")
    bins = edges.join(F.broadcast(sizes), "feature").select(
        "feature",
        *[
            F.greatest(
                F.try_divide(F.col(upto) - F.lag(upto, 1, 0).over(before), F.col(total)), F.lit(EMPTY_SHARE)
            ).alias(share)
            for upto, total, share in (
                ("ref_upto", "reference_rows", "r"),
                ("cur_upto", "current_rows", "c"),
            )
        ],
    )
    index = bins.groupBy("feature").agg(
        F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).alias("psi")
    )
    limit = KS_FACTOR * F.sqrt(
        F.try_divide(F.col("reference_rows") + F.col("current_rows"), F.col("reference_rows") * F.col("current_rows"))
    )
    one_sided = (F.col("reference_rows") == 0) != (F.col("current_rows") == 0)
    measured = (F.col("psi") > PSI_LIMIT) | (F.col("ks") > limit)

    def null_share(side: str) -> Column:
        return 1 - F.try_divide(F.col(f"{side}_rows"), F.col(f"{side}_table"))

    return (
        sizes.join(index, "feature", "left")
        .join(distance, "feature", "left")
        .withColumns(
            {
                "psi": F.when((F.col("reference_rows") > 0) & (F.col("current_rows") > 0), F.col("psi")),
                "drifted": F.coalesce(one_sided | F.coalesce(measured, F.lit(False)), F.lit(False)),
                "reference_null_share": null_share("reference"),
                "current_null_share": null_share("current"),
            }
        )
        .select(
            "feature", "reference_rows", "current_rows", "psi", "ks", "drifted",
            "reference_null_share", "current_null_share", "reference_table", "current_table",
        )
    )


def drift_distances(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature for samples too large for tests, which call every difference significant.

    ``wasserstein``: the area between the two distribution functions in standard deviations of the reference.
    ``jensen_shannon``: the square root of the divergence (base 2) between the shares of values. ``distance`` is the
    second for features of at most ``FEW_VALUES`` values, else the first; from ``DISTANCE_LIMIT`` on the feature
    ``drifted``. Without values on a side all are null, and it has drifted if the other side has some.
    Both are sums over the stored running counts of distinct values; neighbours meet by rank, so no task
    holds a feature.
    """
    summed = with_rank(_cumulative(reference, current, features), ["value"], "_rank", ["feature"])
    summed = materialize(summed, "ranked")
    following = summed.select("feature", (F.col("_rank") - 1).alias("_rank"), F.col("value").alias("_next"))
    sizes = summed.groupBy("feature").agg(F.sum("ref").alias("reference_rows"), F.sum("cur").alias("current_rows"))
    sizes = stored_side(sizes)  # one row per feature
    placed = summed.join(following, ["feature", "_rank"], "left").join(sizes, "feature")
    share = lambda part, whole: F.try_divide(F.col(part), F.col(whole))
    area = F.abs(share("ref_upto", "reference_rows") - share("cur_upto", "current_rows")) * (F.col("_next") - F.col("value"))
    p, q = share("ref", "reference_rows"), share("cur", "current_rows")
    lost = lambda x: F.when(x > 0, x * F.log2(x / ((p + q) / 2)))
    zero = F.lit(0.0)
    found = placed.groupBy("feature", "reference_rows", "current_rows").agg(
        F.count(F.lit(1)).alias("values"),
        F.coalesce(F.sum(area), zero).alias("_area"),
        (F.coalesce(F.sum(lost(p)), zero) / 2 + F.coalesce(F.sum(lost(q)), zero) / 2).alias("_divergence"),
        F.sum(F.col("ref") * F.col("value")).alias("_sum"),
        F.sum(F.col("ref") * F.col("value") * F.col("value")).alias("_squares"),
    )
    n = F.col("reference_rows")
    spread = F.sqrt(F.greatest(F.try_divide(F.col("_squares"), n) - F.pow(F.try_divide(F.col("_sum"), n), F.lit(2)), zero))
    both = (n > 0) & (F.col("current_rows") > 0)
    found = found.withColumns(
        {
            "wasserstein": F.when(both, F.col("_area") / F.greatest(spread, F.lit(LEAST_SPREAD))),
            "jensen_shannon": F.when(both, F.sqrt(F.greatest("_divergence", zero))),
        }
    )
    distance = F.when(F.col("values") <= FEW_VALUES, F.col("jensen_shannon")).otherwise(F.col("wasserstein"))
    drifted = F.coalesce(F.col("distance") >= DISTANCE_LIMIT, F.lit(True))
    return found.withColumn("distance", distance).select(
        "feature", "reference_rows", "current_rows", "values", "wasserstein", "jensen_shannon", "distance", drifted.alias("drifted")
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: rows of both tables, drifted features, and whether at least half of them drifted."""
    return report.agg(
        F.max("reference_table").alias("reference_rows"),
        F.max("current_table").alias("current_rows"),
        F.count(F.lit(1)).alias("features"),
        F.count_if("drifted").alias("drifted_features"),
        (F.count_if("drifted") * 2 >= F.count(F.lit(1))).alias("dataset_drift"),
    )

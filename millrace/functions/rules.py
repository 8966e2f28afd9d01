"""Validity rules: one definition serves as filter, as row flag and as reject count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted ranges of the wine measures, both ends included.
WINE_BOUNDS = {
    "fixed_acidity": (3.0, 16.0),
    "volatile_acidity": (0.0, 2.0),
    "citric_acid": (0.0, 1.5),
    "residual_sugar": (0.0, 70.0),
    "chlorides": (0.0, 0.7),
    "free_sulfur_dioxide": (0.0, 300.0),
    "total_sulfur_dioxide": (0.0, 450.0),
    "density": (0.98, 1.01),
    "pH": (2.5, 4.5),
    "sulphates": (0.0, 2.0),
    "alcohol": (5.0, 17.0),
    "quality": (3.0, 9.0),
}

# Measures of a scoring request that only have to be non-negative.
NON_NEGATIVE_FIELDS = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "sulphates",
    "alcohol",
]


@dataclass(frozen=True)
class Rule:
    """A named condition. A null outcome counts as a failure."""

    name: str
    condition: Column


def within(bounds: Mapping[str, tuple[float, float]]) -> list[Rule]:
    """One rule per column: both ends included."""
    return [Rule(name, F.col(name).between(low, high)) for name, (low, high) in bounds.items()]


def trip_rules(
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    passengers: str = "passenger_count",
    max_fare: float = 500.0,
    seats: tuple[int, int] = (1, 6),
) -> list[Rule]:
    """Plausible trips: positive distance, fare strictly inside its limits, 1 to 6 passengers."""
    return [
        Rule("distance", F.col(distance) > 0),
        Rule("fare", (F.col(fare) > 0) & (F.col(fare) < max_fare)),
        Rule("passengers", F.col(passengers).between(*seats)),
    ]


def request_rules(
    non_negative: Sequence[str] = NON_NEGATIVE_FIELDS,
    positive: Sequence[str] = ("density",),
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> list[Rule]:
    """Ranges of a scoring request."""
    ranges = {"pH": (0.0, 14.0), "wine_type": (0, 1)} if ranges is None else ranges
    return (
        [Rule(name, F.col(name) >= 0) for name in non_negative]
        + [Rule(name, F.col(name) > 0) for name in positive]
        + within(ranges)
    )


def all_hold(rules: Sequence[Rule]) -> Column:
    """Conjunction of the rules, as a scan filter: null drops the row, each term can be pushed down."""
    return reduce(and_, [rule.condition for rule in rules])


def row_valid(rules: Sequence[Rule]) -> Column:
    """Two-valued row flag."""
    return F.coalesce(all_hold(rules), F.lit(False))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule."""
    return df.filter(all_hold(rules))


def keep_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of the broken rules in ``failed_rules``."""
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(rule.condition, F.lit(False)), F.lit(rule.name)) for rule in rules])
    )
    return df.withColumn("failed_rules", failed).filter(F.size("failed_rules") > 0)


def reject_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows ``(rule, rejected)``, one per rule, from a single aggregate over the data."""
    counts = df.agg(
        *[
            F.count_if(~F.coalesce(rule.condition, F.lit(False))).alias(f"r{i}")
            for i, rule in enumerate(rules)
        ]
    )
    pairs = [
        F.struct(F.lit(rule.name).alias("rule"), F.col(f"r{i}").alias("rejected"))
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*pairs)))

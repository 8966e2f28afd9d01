"""Numbers: ratios, rates, reproducible averages, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.cleaning import _col, safe_double

# Price and rating limits.
PRICE_LIMITS = [(10.0, "low"), (50.0, "medium"), (200.0, "high")]
RATING_LIMITS = [(4.0, "positive_rating"), (3.0, "neutral_rating")]


def guarded_ratio(top: Column | str, bottom: Column | str, floor: float = 1.0) -> Column:
    """Ratio whose denominator is at least ``floor``."""
    return _col(top) / F.greatest(_col(bottom), F.lit(floor))


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Ratio, null where the denominator is zero."""
    return F.try_divide(_col(top), _col(bottom))


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded share, null for an empty whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def total(value: Column | str, scale: int | None = None) -> Column:
    """Sum. With ``scale`` the values are summed as whole units of 10^-scale.

    A sum of doubles depends on the order in which partitions arrive, and so may change when a task
    is retried. Values known to have ``scale`` decimals can be summed exactly instead, at the price
    of a long addition.
    """
    if scale is None:
        return F.sum(_col(value))
    return F.sum(F.round(_col(value) * 10**scale).cast("long")) / F.lit(float(10**scale))


def average(value: Column | str, scale: int | None = None) -> Column:
    """Mean; see ``total`` for ``scale``."""
    if scale is None:
        return F.avg(_col(value))
    return F.try_divide(total(value, scale), F.count(_col(value)))


def step_label(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper limit the value stays below."""
    label = F.lit(otherwise)
    for limit, name in reversed(limits):
        label = F.when(value < limit, F.lit(name)).otherwise(label)
    return label


def price_bucket(
    price: Column | str, limits: Sequence[tuple[float, str]] = PRICE_LIMITS, top: str = "premium"
) -> Column:
    """Price class. A missing or non-numeric price is ``unknown``."""
    amount = safe_double(price)
    return F.when(amount.isNull(), F.lit("unknown")).otherwise(step_label(amount, limits, top))


def rating_class(
    rating: Column | str,
    limits: Sequence[tuple[float, str]] = RATING_LIMITS,
    otherwise: str = "negative_rating",
) -> Column:
    """Class of a rating by lower limits, highest first. A missing rating gets the lowest class."""
    label = F.lit(otherwise)
    for limit, name in reversed(limits):
        label = F.when(_col(rating) >= limit, F.lit(name)).otherwise(label)
    return label


def score_tier(score: Column | str, low_max: float = 5, mid_max: float = 7) -> Column:
    """Tier 0, 1 or 2 of a score; null stays null."""
    score = _col(score)
    return F.when(score <= low_max, 0).when(score <= mid_max, 1).when(score.isNotNull(), 2)

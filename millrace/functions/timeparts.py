"""Parts of dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.cleaning import _col, safe_date, safe_timestamp

EPOCH_UNITS = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end, counted in whole seconds."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(60.0)


def as_timestamp(value: Column | str, epoch_unit: str | None = None) -> Column:
    """Timestamp from text, timestamp, or an epoch number in the named unit (``s``, ``ms``, ``us``)."""
    if epoch_unit is None:
        return safe_timestamp(value)
    return EPOCH_UNITS[epoch_unit](_col(value).try_cast("long"))


def day_of(value: Column | str, epoch_unit: str | None = None) -> Column:
    """Calendar day of a timestamp in any of the forms of ``as_timestamp``."""
    return F.to_date(as_timestamp(value, epoch_unit))


def month_start(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(day), "month")


def year_part(text: Column | str) -> Column:
    """Year of a date text; ``unknown`` if it is no date."""
    return F.coalesce(F.year(safe_date(text)).cast("string"), F.lit("unknown"))


def month_part(text: Column | str) -> Column:
    """Two-digit month of a date text; ``00`` if it is no date."""
    return F.coalesce(F.lpad(F.month(safe_date(text)).cast("string"), 2, "0"), F.lit("00"))

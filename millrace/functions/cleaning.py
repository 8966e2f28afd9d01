"""Text to typed values. A value that does not parse becomes null; nothing here raises on data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a flag, and tokens that stand for a missing CSV field.
YES_WORDS = ["yes", "y", "true", "1"]
NO_WORDS = ["no", "n", "false", "0"]
NULL_TOKENS = ["", "NA", "N/A", "null"]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(text: Column | str) -> Column:
    """Trimmed text; blank becomes null."""
    return F.nullif(F.trim(_col(text)), F.lit(""))


def is_blank(text: Column | str) -> Column:
    """True for null, empty and white-space-only text."""
    text = _col(text)
    return text.isNull() | (F.trim(text) == "")


def tokens_to_null(text: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null for text that is exactly one of the null tokens."""
    text = _col(text)
    return F.when(~text.isin(*tokens), text)


def yes_no_flag(text: Column | str) -> Column:
    """True, false or null from yes/no spellings. Case is ignored, surrounding blanks are not."""
    word = F.lower(_col(text))
    return F.when(word.isin(*YES_WORDS), F.lit(True)).when(word.isin(*NO_WORDS), F.lit(False))


def safe_date(text: Column | str, pattern: str | None = None) -> Column:
    """Date from text or timestamp, null if it is not a date."""
    return F.try_to_date(_col(text), pattern) if pattern else _col(text).try_cast("date")


def safe_timestamp(value: Column | str) -> Column:
    """Timestamp from text, date or timestamp, null if it does not parse.

    For epoch numbers use ``timeparts.as_timestamp``, which is told the unit.
    """
    return _col(value).try_cast("timestamp")


def safe_double(value: Column | str) -> Column:
    """Double from any scalar, null if it does not parse."""
    return _col(value).try_cast("double")


def variant_text(source: Column | str, *spellings: str) -> Column:
    """First non-null field among several spellings of one name, as text."""
    fields = [F.try_variant_get(_col(source), f'$["{name}"]', "string") for name in spellings]
    return F.coalesce(*fields)


def lookup(value: Column | str, mapping: Mapping) -> Column:
    """Value from a literal map; null where the key is not in it."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), _col(value))


def class_from_file(name: Column | str, needle: str, found: str, otherwise: str) -> Column:
    """Class from a file's base name. Folder names do not count."""
    base = F.regexp_extract(_col(name), r"([^/]*)$", 1)
    return F.when(base.contains(needle), F.lit(found)).otherwise(F.lit(otherwise))


def is_present(value: Column | str) -> Column:
    """Two-valued presence flag."""
    return _col(value).isNotNull()

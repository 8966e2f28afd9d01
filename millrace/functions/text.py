"""Text, link and answer expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.cleaning import _col

# Chunk length and overlap share, link forms, preview length.
CHUNK_TOKENS = 300
CHUNK_OVERLAP = 0.2
FEATURE_PATH = "features"
OBJECT_LINK = r"^s3://([^/]+)/(.+)$"
PREVIEW_CHARS = 200

BLANKS = r"[ \t\r\n\f]+"

CITATION_TYPE = (
    "array<struct<retrievedReferences:array<struct<location:struct<s3Location:struct<uri:string>>>>>>"
)


def words(text: Column | str) -> Column:
    """White-space-separated words; none for empty or null text."""
    return F.array_remove(F.split(F.coalesce(_col(text), F.lit("")), BLANKS), "")


def any_keyword(text: Column | str, keywords: Column | str) -> Column:
    """True if the text contains one of the keywords, ignoring case."""
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.exists(_col(keywords), lambda word: F.contains(lowered, F.lower(word)))


def preview(text: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    """The first characters of a text, for display in a report."""
    return F.substring(_col(text), 1, chars)


def citation_links(citations: Column | str) -> Column:
    """Source links of an answer's nested citations: no blanks, no repeats, first-seen order."""
    references = F.flatten(
        F.transform(
            _col(citations),
            lambda c: F.coalesce(c["retrievedReferences"], F.array()),
        )
    )
    links = F.transform(references, lambda r: r["location"]["s3Location"]["uri"])
    kept = F.array_distinct(F.filter(links, lambda link: link.isNotNull() & (link != "")))
    return F.coalesce(kept, F.array().cast("array<string>"))


def link_bucket(link: Column | str) -> Column:
    """Bucket of an object link; null if the text is no such link."""
    return F.nullif(F.regexp_extract(_col(link), OBJECT_LINK, 1), F.lit(""))


def link_key(link: Column | str) -> Column:
    """Key of an object link; null if the text is no such link."""
    return F.nullif(F.regexp_extract(_col(link), OBJECT_LINK, 2), F.lit(""))


def feature_link(bucket: Column | str, dataset: Column | str, part: Column | str | None = None) -> Column:
    """Link of a feature table, or of one part of it."""
    pieces = [F.concat(F.lit("s3://"), _col(bucket)), F.lit(FEATURE_PATH), _col(dataset)]
    if part is not None:
        pieces.append(F.nullif(F.regexp_replace(_col(part), "/+$", ""), F.lit("")))
    return F.concat_ws("/", *pieces)


def request_question(body: Column | str) -> Column:
    """Trimmed question of a JSON request body; null for a bad body or a blank question."""
    question = F.try_variant_get(F.try_parse_json(_col(body)), "$.question", "string")
    return F.nullif(F.trim(question), F.lit(""))


def chunk_starts(n_words: Column, size: int = CHUNK_TOKENS, overlap: float = CHUNK_OVERLAP) -> Column:
    """0-based starts of overlapping chunks. The last chunk always holds a word no other one has."""
    shared = int(round(size * overlap))
    last = F.greatest(n_words - F.lit(shared + 1), F.lit(0))
    return F.sequence(F.lit(0), last, F.lit(size - shared))

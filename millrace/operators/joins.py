"""Joins of facts with their descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import require_columns

BITS_PER_KEY = 16  # one key in sixteen that is not wanted passes
MOST_BITS = 1 << 28  # 32 MB
CHUNK_BITS = 1 << 15  # of Spark's bitmaps


def enrich(facts: DataFrame, items: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Left join of item columns on a shared key; ``items`` must be unique by key.

    No strategy is forced: a small item table is broadcast by its measured size, and in a shuffled
    join adaptive execution splits the partition of a hot item. It cannot do so if ``items`` was just
    aggregated by the key, since the join then shares the aggregate's shuffle: ``materialize`` such a
    table first.
    """
    require_columns(facts, [key])
    require_columns(items, [key])
    chosen = items if columns is None else items.select(key, *columns)
    return facts.join(chosen, key, "left")


def count_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose row counts differ between two copies, with both counts.

    Both sides are counted in one aggregate rather than joined, so hot keys shrink before the shuffle.
    """
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = sides.groupBy(*keys).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    return counts.filter(F.col("left_rows") != F.col("right_rows"))


def with_maybe(rows: DataFrame, wanted: DataFrame, key: str, flag: str, most_bits: int = MOST_BITS) -> DataFrame:
    """Add ``flag``, which is true if ``key`` is in ``wanted`` (a stored table with that column, not null), and for a
    few other keys.

    A bitmap of hashed keys is broadcast, of at most ``most_bits``: beyond its size more rows pass. Filtered
    by it, rows with long texts are dropped before an exact join shuffles them.
    """
    slots = min(max(BITS_PER_KEY * wanted.count(), CHUNK_BITS), most_bits)
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    at = (slot % CHUNK_BITS).cast("int")
    marks = wanted.select(F.floor(slot / CHUNK_BITS).alias("_chunk"), at.cast("long").alias("_at"))
    bitmap = marks.groupBy("_chunk").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = rows.withColumns({"_chunk": F.floor(slot / CHUNK_BITS), "_at": at})
    met = placed.join(F.broadcast(bitmap), "_chunk", "left")
    return met.withColumn(flag, F.coalesce(F.getbit(byte, F.col("_at") % 8) == 1, F.lit(False))).drop("_chunk", "_at", "_bits")


def only_wanted(rows: DataFrame, wanted: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """Left semi join on ``key`` that shuffles hardly any other rows; ``wanted`` is a stored table."""
    maybe = with_maybe(rows, wanted.select(key), key, "_maybe", most_bits).filter("_maybe").drop("_maybe")
    return maybe.join(wanted.select(key), key, "left_semi")

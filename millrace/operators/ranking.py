"""Exact ranks and running totals over whole tables, without gathering a group in one task.

``row_number()`` over a window puts each window partition into one task: all rows if there is no
partition key, a third of them if one key is that hot. Here the rows are range-partitioned by the
full order instead. Each partition is numbered by itself, and a small table with one row per
partition (and group) says how much lies before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored_side, materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row position below


def attach_by(rows: DataFrame, side: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join of a side table on equally named columns, where null matches null."""
    renamed = side.withColumnsRenamed({name: f"_key_{name}" for name in names})
    condition = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_key_{name}")) for name in names])
    return rows.join(renamed, condition, "left").drop(*[f"_key_{name}" for name in names])


def with_rank(
    df: DataFrame, order_by: Sequence[str], rank: str = "rank", groups: Sequence[str] = ()
) -> DataFrame:
    """Add the 1-based row number by ``order_by``, within ``groups`` if given.

    ``order_by`` must be a total order within a group. There should be few groups (classes, column
    names, features): the side table has one row per range partition and group.
    """
    keys = [*groups, *order_by]
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    slots = materialize(sorted_rows.withColumn("_slot", F.monotonically_increasing_id()), "slots")
    slots = slots.withColumn("_block", F.shiftright("_slot", _POSITION_BITS))
    blocks = slots.groupBy("_block", *groups).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first")
    )
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_block",
        *groups,
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    located = attach_by(slots, stored_side(starts), ["_block", *groups])
    number = F.col("_before") + F.col("_slot") - F.col("_first") + 1
    return located.withColumn(rank, number).drop("_slot", "_block", "_first", "_before")


def running_totals(
    df: DataFrame, order_by: Sequence[str], totals: Mapping[str, str], groups: Sequence[str] = ()
) -> DataFrame:
    """Add running sums ``{new column: summed column}`` by ``order_by``, within ``groups`` if given.

    The same conditions hold as for ``with_rank``.
    """
    keys = [*groups, *order_by]
    blocks = df.repartitionByRange(*keys).withColumn("_block", F.spark_partition_id())
    blocks = materialize(blocks, "blocks")
    sums = blocks.groupBy("_block", *groups).agg(*[F.sum(c).alias(f"_all_{c}") for c in totals.values()])
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "_block",
        *groups,
        *[
            F.coalesce(F.sum(f"_all_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
            for c in totals.values()
        ],
    )
    inside = (
        Window.partitionBy("_block", *groups)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = blocks.select("*", *[F.sum(c).over(inside).alias(f"_local_{c}") for c in totals.values()])
    located = attach_by(local, stored_side(before), ["_block", *groups])
    added = {new: F.col(f"_before_{c}") + F.col(f"_local_{c}") for new, c in totals.items()}
    return located.select(*df.columns, *[value.alias(new) for new, value in added.items()])


def value_ranks(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values with their count ``n`` and running count ``upto``.

    The first row with ``upto >= r`` holds the value at rank ``r``. Equal values are counted before
    the shuffle, so a value that fills a third of the rows is one row per task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(counts, [value], {"upto": "n"}, groups)

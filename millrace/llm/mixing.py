"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Every document gets a rate between 0 and ``limit``. Rates minimise the (bounded) relative entropy to
equal rates under one constraint per source: the expected words are the source's target. The dual is
convex with one multiplier per source, and its solution tilts rates exponentially in document size:
``rate = limit * e^(m z) / (1 + e^(m z))`` with ``z = size / mean size``. Newton iterations need two
sums per source; they run over the distinct sizes of each source, with whole numbers, so that reruns
agree to the last bit.

Rates become copies by systematic rounding along the order (source, size, id): the running total of
rates is rounded, and each document gets the difference. Neighbours have similar sizes, so a
source's words stay within a few documents of its target.

Null texts and empty texts have size 0, count for nothing and are never taken. Null sources are one
source, the last. Repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, null_safe, query, stored_with, table
from millrace.operators.ranking import running_totals
from millrace.session import materialize

SCALE = 1 << 24  # rates and multipliers as whole numbers
TOLERANCE = 1e-5  # of the words expected of a source


def text_size(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: float) -> DataFrame:
    """``source, source_size, target`` from rows ``source, source_size``.

    Targets are in proportion to the weights, dealt out by code point with null last, and stop at
    ``limit`` times the source's size; the rest goes to the others by weight. Sorted by the factor at
    which a source fills up, the filled ones are a prefix, so running sums give the level directly.
    One row per source; the windows below see nothing larger.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1))
    weighted = weighted.withColumn("_cap", F.col("source_size") * F.lit(float(limit)))
    fills = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    upto, everything = fills.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(everything) * F.lit(share)
    left = total - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(upto), F.lit(0))
    # The level if every source before this one is full and this and all later ones are not.
    levelled = weighted.withColumns({"_level": left / weight_left, "_place": F.row_number().over(fills)})
    full = F.col("_cap") <= F.col("_level") * F.col("_weight")
    first = F.min(F.when(~full, F.struct("_place", "_level"))).over(everything)
    levelled = levelled.withColumn("_final", first["_level"])
    target = F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_final") * F.col("_weight"))
    )
    return levelled.select("source", "source_size", target.alias("target"))


def _rate(multiplier: Column, z: Column, limit: float) -> Column:
    return F.lit(limit) / (1 + F.exp(-multiplier * z))


def tilt(histogram: DataFrame, targets: DataFrame, limit: float, tolerance: float = TOLERANCE) -> DataFrame:
    """``source, source_size, target, mean, multiplier`` by Newton iterations on the dual.

    ``histogram``: rows ``source, size, docs``. Words grow with the multiplier, so the gap's sign says on which
    side of a multiplier the solution lies. A Newton step is taken if it stays between the bounds so found
    and below a longest step, which doubles whenever it is met; else the bounds are halved. The largest relative
    gap is observed while a state is written, and the loop ends when it is below ``tolerance`` or no multiplier
    moves any more (they are whole multiples of 2^-24). A source at its limit has no finite multiplier
    and gets rate ``limit`` by ``full``.
    """
    means = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("mean"))
    none = F.lit(None).cast("double")
    state = null_safe(targets, means, ["source"], "inner").select(
        "source",
        "source_size",
        "target",
        "mean",
        (F.col("target") >= F.col("source_size") * F.lit(limit)).alias("full"),
        F.lit(0.0).alias("multiplier"),
        none.alias("_low"),
        none.alias("_high"),
        F.lit(4.0).alias("_reach"),
    )
    state = materialize(state, "tilt")
    while True:
        joined = null_safe(histogram, state, ["source"], "inner")
        z = F.col("size") / F.col("mean")
        rate = _rate(F.col("multiplier"), z, limit)
        words = F.round(F.col("size") * F.col("docs") * rate * 1024).cast("decimal(38,0)")
        slope = F.round(F.col("size") * F.col("docs") * z * rate * (1 - rate / limit) * 1024).cast("decimal(38,0)")
        sums = joined.groupBy("source").agg(F.sum(words).alias("_words"), F.sum(slope).alias("_slope"))
        both = null_safe(state, sums, ["source"], "inner")
        gap = F.col("target") * 1024 - F.col("_words").cast("double")
        both = both.withColumn("_gap", F.when(~F.col("full"), gap))
        both = both.withColumns(
            {
                "_low": F.when(F.col("_gap") > 0, F.col("multiplier")).otherwise(F.col("_low")),
                "_high": F.when(F.col("_gap") < 0, F.col("multiplier")).otherwise(F.col("_high")),
            }
        )
        newton = F.col("_gap") / (F.col("_slope").cast("double") + 1)
        clipped = F.greatest(-F.col("_reach"), F.least(F.col("_reach"), newton))
        aim = F.col("multiplier") + clipped
        beside = (aim <= F.col("_low")) | (aim >= F.col("_high")) | (F.abs(newton) > F.col("_reach"))
        middle = (F.col("_low") + F.col("_high")) / 2  # null until both bounds are known
        moved = F.when(F.coalesce(beside, F.lit(False)), F.coalesce(middle, aim)).otherwise(aim)
        moved = F.when(F.coalesce(F.col("_gap") != 0, F.lit(False)), F.round(moved * SCALE) / SCALE).otherwise(F.col("multiplier"))
        reach = F.when(F.abs(newton) > F.col("_reach"), 2 * F.col("_reach")).otherwise(F.col("_reach"))
        both = both.withColumns({"_next": moved, "_reach": F.coalesce(reach, F.col("_reach"))}).drop("_words", "_slope")
        off = F.max(F.abs(F.col("_gap")) / (F.col("target") * 1024))
        moves = F.count_if(F.col("_next") != F.col("multiplier"))
        both, seen = stored_with(both, "tilt", {"off": F.coalesce(off, F.lit(0.0)), "moves": moves})
        if seen["off"] <= tolerance or not seen["moves"]:
            return both.select("source", "source_size", "target", "mean", "full", "multiplier")
        state = both.withColumn("multiplier", F.col("_next")).drop("_next", "_gap")


def mix_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    limit: int = 2,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document its id, ``source``, ``size``, ``source_size``, ``target`` and number of ``copies``.

    ``carry`` names further columns to keep; only their rows' numbers are sorted, and copies are joined to them.
    """
    sized = materialize(
        docs.select(
            F.col(doc_id).alias("_id"), F.col(source).alias("source"), text_size(text).alias("size"),
            *[F.col(c).alias(f"_carry_{c}") for c in carry], *([F.monotonically_increasing_id().alias("_row")] if carry else []),
        ),
        "sizes",
    )
    carried = sized.select("_row", *[f"_carry_{c}" for c in carry]) if carry else None
    sized = sized.drop(*[f"_carry_{c}" for c in carry])
    histogram = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "histogram")
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    state = tilt(histogram.filter("size > 0"), materialize(source_targets(totals, weights, share, limit), "targets"), limit)
    # Sources without a word have no row in ``state``; their totals come from the histogram.
    all_sources = null_safe(totals, state.drop("source_size"), ["source"], "left")
    rated = null_safe(sized, materialize(all_sources, "tilted"), ["source"], "inner")
    rate = F.when(F.col("full"), F.lit(float(limit))).otherwise(
        _rate(F.col("multiplier"), F.col("size") / F.col("mean"), limit)
    )
    units = F.when(F.col("size") > 0, F.round(rate * SCALE).cast("long")).otherwise(F.lit(0).cast("long"))
    rated = rated.withColumn("_units", F.coalesce(units, F.lit(0).cast("long"))).drop("mean", "full", "multiplier")
    rated = rated.withColumn("_source", F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")))
    run = running_totals(rated, ["size", "_id"], {"_upto": "_units"}, ["_source"])
    half = SCALE // 2
    copies = F.floor((F.col("_upto") + half) / SCALE) - F.floor((F.col("_upto") - F.col("_units") + half) / SCALE)
    own = [] if doc_id in carry else [F.col("_id").alias(doc_id)]
    if carry:
        kept = ["source", "size", "source_size", "target", "_upto", "_units", *([] if doc_id in carry else ["_id"])]
        run = carried.join(run.select("_row", *kept), "_row")
    return run.select(
        *own, "source", "size", "source_size",
        F.coalesce("target", F.lit(0.0)).alias("target"), copies.cast("long").alias("copies"),
        *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )


@query("op5_mix_sources")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix_copies(table(spark, sf, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )

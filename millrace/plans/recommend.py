"""Recommendation features, candidates and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.measures import rate
from millrace.functions.rules import Rule, reject_counts
from millrace.operators.encode import encode_categories
from millrace.operators.inner_product import top_inner_products
from millrace.operators.ranking import running_totals, with_rank
from millrace.operators.sampling import hash_key, in_share
from millrace.operators.windows import top_per_key
from millrace.session import materialize

# Clicks kept per user, rating range, share of the first variant.
LAST_CLICKS = 10
RATING_RANGE = (0.0, 5.0)
FIRST_VARIANT_SHARE = 0.8

# Our own choices.
SEGMENTS = [(5, "light"), (50, "regular")]
ACTION_WEIGHTS = {"view": 1.0, "click": 2.0, "purchase": 5.0}


def user_features(events: DataFrame, user: str, ts: str, as_of: Column) -> DataFrame:
    """Activity count, days since the last event, and segment per user."""
    counts = events.groupBy(user).agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("_last"))
    segment = F.lit("heavy")
    for limit, name in reversed(SEGMENTS):
        segment = F.when(F.col("events") < limit, F.lit(name)).otherwise(segment)
    return counts.select(
        user,
        "events",
        F.datediff(F.to_date(as_of), F.to_date("_last")).alias("recency_days"),
        segment.alias("segment"),
    )


def item_features(events: DataFrame, items: DataFrame, item: str, columns: Sequence[str]) -> DataFrame:
    """Popularity and chosen attributes of every item. Events are counted before the join."""
    counts = events.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    return items.join(counts, item, "left").select(
        item, *columns, F.coalesce("_n", F.lit(0)).alias("popularity")
    )


def last_items(
    events: DataFrame, user: str, item: str, order: Sequence[Column], n: int = LAST_CLICKS
) -> DataFrame:
    """Each user's last ``n`` items, newest first."""
    recent = top_per_key(events, [user], order, n)
    ordered = F.array_sort(F.collect_list(F.struct("position", item)))
    return recent.groupBy(user).agg(F.transform(ordered, lambda e: e[item]).alias("last_items"))


def daily_volume(events: DataFrame, ts: str, days: int = 7, limit: float = 3.0) -> DataFrame:
    """Events per day, and whether a day lies ``limit`` deviations off its ``days`` predecessors.

    The window runs over one row per day.
    """
    daily = events.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("events"))
    past = Window.orderBy("day").rowsBetween(-days, -1)
    known = daily.withColumns(
        {
            "_seen": F.count(F.lit(1)).over(past),
            "usual": F.avg("events").over(past),
            "_spread": F.stddev_samp("events").over(past),
        }
    )
    off = (F.col("_seen") == days) & (F.abs(F.col("events") - F.col("usual")) > limit * F.col("_spread"))
    verdict = F.when(~F.coalesce(off, F.lit(False)), "normal").when(
        F.col("events") > F.col("usual"), "spike"
    )
    return known.select("day", "events", "usual", verdict.otherwise("drop").alias("verdict"))


def event_checks(
    events: DataFrame,
    required: Sequence[str],
    rating: str,
    bounds: tuple[float, float] = RATING_RANGE,
) -> DataFrame:
    """Rejects per check: required columns not null, rating inside its range."""
    rules = [Rule(f"{c}_present", F.col(c).isNotNull()) for c in required]
    return reject_counts(events, [*rules, Rule("rating_range", F.col(rating).between(*bounds))])


def interaction_weights(
    events: DataFrame, user: str, item: str, action: str, weights: Mapping[str, float] = ACTION_WEIGHTS
) -> DataFrame:
    """Summed action weight per user and item; other actions weigh nothing and are left out."""
    weight = F.lit(None).cast("double")
    for name, value in weights.items():
        weight = F.when(F.col(action) == name, F.lit(value)).otherwise(weight)
    weighted = events.select(user, item, weight.alias("weight")).filter(F.col("weight").isNotNull())
    return weighted.groupBy(user, item).agg(F.sum("weight").alias("weight"))


def factorize(
    weights: DataFrame, user: str, item: str, rank: int = 10, rounds: int = 10, seed: int = 42
) -> ALSModel:
    """Implicit-feedback matrix factorisation; ids must be integers (see ``encode_categories``)."""
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol="weight",
        implicitPrefs=True,
        rank=rank,
        maxIter=rounds,
        seed=seed,
        coldStartStrategy="drop",
    )
    return als.fit(weights)


def model_top_n(model: ALSModel, user: str, item: str, n: int) -> DataFrame:
    """Top ``n`` items of every user by the factor model: ``(user, item, score, position)``."""
    users = model.userFactors.withColumnRenamed("id", user)
    return top_inner_products(users, model.itemFactors.withColumnRenamed("id", item), n, user, item, "features", "features")


def top_n(scores: DataFrame, user: str, item: str, score: str, n: int) -> DataFrame:
    """Top ``n`` scored items per user; ties by item."""
    return top_per_key(scores, [user], [F.col(score).desc(), F.col(item)], n)


def negative_samples(
    positives: DataFrame, items: DataFrame, user: str, item: str, per_positive: int = 1, seed: int = 42
) -> DataFrame:
    """Items a user has not touched: ``per_positive`` for each positive pair, or all there are if these are fewer.

    Draws are numbers of untouched items. The ``i``-th of ``m`` draws lies in the ``i``-th of ``m`` equal parts
    of these numbers, at a hashed place, so no two draws of a user agree. With ``j`` touched items before
    it, the ``r``-th untouched item has place ``r + j`` in the list of items: one running count over a user's
    draws and touched places together finds it. No user meets all items.
    """
    numbered = materialize(with_rank(items.filter(F.col(item).isNotNull()).select(item).distinct(), [item], "_place"), "items")
    size = numbered.count()
    pairs = positives.filter(F.col(user).isNotNull()).select(user, item).distinct()
    touched = with_rank(pairs.join(numbered, item).select(user, "_place"), ["_place"], "_nth", groups=[user])
    touched = materialize(touched, "touched")
    left = F.lit(size) - F.max("_nth")
    asked = touched.groupBy(user).agg(left.alias("_left"), F.least(F.count(F.lit(1)) * per_positive, left).alias("_asked"))
    draws = asked.filter("_asked > 0").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_asked")).alias("_draw"))
    # Decimals: products of two counts may pass 64 bits.
    edge = lambda i: F.expr(f"CAST((CAST({i} AS DECIMAL(19,0)) * CAST(_left AS DECIMAL(19,0))) div CAST(_asked AS DECIMAL(19,0)) AS BIGINT)")
    digest = F.conv(F.substring(hash_key([user, "_draw"], seed), 1, 8), 16, 10).cast("long")
    number = edge("(_draw - 1)") + digest % (edge("_draw") - edge("(_draw - 1)")) + 1
    # A touched item lies before the draws whose number is above the count of untouched items before it.
    before = touched.select(user, (F.col("_place") - F.col("_nth")).alias("_at"), F.lit(1).alias("_touched"), F.lit(0).alias("_kind"))
    wanted = draws.select(user, (number - 1).alias("_at"), F.lit(0).alias("_touched"), F.lit(1).alias("_kind"))
    events = before.unionByName(wanted).groupBy(user, "_at", "_kind").agg(F.sum("_touched").alias("_touched"))
    placed = running_totals(events, ["_at", "_kind"], {"_before": "_touched"}, groups=[user]).filter("_kind = 1")
    found = placed.select(user, (F.col("_at") + 1 + F.col("_before")).alias("_place"))
    return found.join(numbered, "_place").select(user, item)


def ranking_metrics(recommended: DataFrame, relevant: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """One row: recall, NDCG, MAP and hit rate at ``k`` over the users with relevant items.

    ``recommended`` has a 1-based ``position`` per user. Everything is a join and two aggregates: no
    list per user is built.
    """
    truth = relevant.select(user, item).distinct()
    wanted = truth.groupBy(user).agg(F.count(F.lit(1)).alias("_wanted"))
    hits = recommended.filter(F.col("position") <= k).join(truth, [user, item])
    nth = F.row_number().over(Window.partitionBy(user).orderBy("position"))
    per_user = (
        hits.withColumn("_nth", nth)
        .groupBy(user)
        .agg(
            F.count(F.lit(1)).alias("_hits"),
            F.sum(F.lit(1.0) / F.log2(F.col("position") + 1)).alias("_gain"),
            F.sum(F.col("_nth") / F.col("position")).alias("_precision"),
        )
    )
    possible = F.least(F.col("_wanted"), F.lit(k))
    best_gain = F.aggregate(
        F.sequence(F.lit(1), possible.cast("int")),
        F.lit(0.0),
        lambda acc, i: acc + F.lit(1.0) / F.log2(i + F.lit(1)),
    )
    rated = wanted.join(per_user, user, "left").fillna(0, ["_hits", "_gain", "_precision"])
    return rated.agg(
        F.count(F.lit(1)).alias("users"),
        F.avg(F.col("_hits") / F.col("_wanted")).alias("recall"),
        F.avg(F.col("_gain") / best_gain).alias("ndcg"),
        F.avg(F.col("_precision") / possible).alias("map"),
        F.avg((F.col("_hits") > 0).cast("double")).alias("hit_rate"),
    )


def business_metrics(
    recommended: DataFrame, interactions: DataFrame, user: str, item: str, price: str
) -> DataFrame:
    """One row: share of test interactions that were recommended, and expected revenue per user.

    ``interactions`` carry the item's price; revenue counts the recommended ones.
    """
    offered = recommended.select(user, item).distinct().withColumn("_offered", F.lit(True))
    # Summed per pair first: a pair that is met very often is one row in the join.
    pairs = interactions.groupBy(user, item).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(price).alias("_value")
    )
    judged = pairs.join(offered, [user, item], "left")
    taken = F.coalesce("_offered", F.lit(False))
    per_user = judged.groupBy(user).agg(
        F.sum("_n").alias("_all"),
        F.sum(F.when(taken, F.col("_n")).otherwise(0)).alias("_taken"),
        F.sum(F.when(taken, F.col("_value")).otherwise(0.0)).alias("_revenue"),
    )
    return per_user.agg(
        F.sum("_all").alias("interactions"),
        (F.sum("_taken") / F.sum("_all")).alias("ctr_proxy"),
        F.avg("_revenue").alias("revenue_per_user"),
    )


def assign_variant(df: DataFrame, user: str, share: float = FIRST_VARIANT_SHARE, seed: int = 0) -> DataFrame:
    """Add ``variant``: A for ``share`` of the users, however small, else B; a user always gets the same one."""
    return df.withColumn("variant", F.when(in_share([user], share, seed), "A").otherwise("B"))


def compare_variants(
    df: DataFrame, action: str, latency: str, click: str, buy: str, error: str
) -> DataFrame:
    """Per variant: rows, click, conversion and error rate, mean latency."""
    is_action = lambda name: F.count_if(F.col(action) == name)
    n = F.count(F.lit(1))
    return df.groupBy("variant").agg(
        n.alias("rows"),
        rate(is_action(click), n).alias("ctr"),
        rate(is_action(buy), n).alias("conversion_rate"),
        rate(is_action(error), n).alias("error_rate"),
        F.avg(latency).alias("avg_latency"),
    )


def model_ids(events: DataFrame, user: str, item: str, order_key: Sequence[str]) -> DataFrame:
    """Events with integer ``<user>_idx`` and ``<item>_idx`` for ``factorize``."""
    return encode_categories(events, [user, item], order_key)

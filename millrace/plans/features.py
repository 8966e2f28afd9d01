"""Feature tables: wine measures, trips, events, items."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import class_from_file, is_present, lookup, safe_timestamp
from millrace.functions.columns import normalize_names, require_columns
from millrace.functions.measures import average, guarded_ratio, price_bucket, rating_class, ratio
from millrace.functions.rules import WINE_BOUNDS, keep_valid, trip_rules, within
from millrace.functions.timeparts import day_of, minutes_between
from millrace.operators.quality import enforce, row_count_test
from millrace.operators.windows import with_group_values
from millrace.sources.readers import read_wine
from millrace.sources.writers import write_parquet

# Class codes, smallest accepted tables, longest trip, output columns.
WINE_TYPES = {"red": 0, "white": 1}
MIN_WINE_ROWS = 6_000
MIN_TRIP_ROWS = 100_000
MAX_TRIP_MINUTES = 180.0
TRIP_FEATURES = [
    "pickup_hour",
    "pickup_dow",
    "trip_distance",
    "trip_duration_min",
    "passenger_count",
    "fare_per_mile",
    "zone_avg_fare",
    "zone_trip_count",
    "zone_avg_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
]


def wine_features(raw: DataFrame) -> DataFrame:
    """Valid wines with their class and three derived measures."""
    wines = normalize_names(raw)
    if "wine_type" not in wines.columns:
        file = F.col("_metadata.file_name")
        wines = wines.withColumn("wine_type", class_from_file(file, "red", "red", "white"))
    valid = keep_valid(require_columns(wines, WINE_BOUNDS), within(WINE_BOUNDS))
    return valid.withColumns(
        {
            "wine_type": lookup("wine_type", WINE_TYPES),
            "total_acidity": F.col("fixed_acidity") + F.col("volatile_acidity") + F.col("citric_acid"),
            "free_to_total_so2_ratio": guarded_ratio("free_sulfur_dioxide", "total_sulfur_dioxide"),
            "alcohol_density_ratio": ratio("alcohol", "density"),
        }
    )


def zone_values(
    df: DataFrame, zone: str, hour: str, fare: str, distance: str, scale: int | None = None
) -> DataFrame:
    """Add the averages and the row count of each row's zone and hour.

    ``scale`` is the number of decimals of fare and distance, if known (see ``measures.total``).
    """
    values = {
        "zone_avg_fare": average(fare, scale),
        "zone_trip_count": F.count(F.lit(1)),
        "zone_avg_distance": average(distance, scale),
    }
    return with_group_values(df, [zone, hour], values)


def clean_trips(raw: DataFrame, max_fare: float = 500.0, max_minutes: float = MAX_TRIP_MINUTES) -> DataFrame:
    """Plausible trips with time parts and fare per mile. Scan filters come first."""
    timed = keep_valid(raw, trip_rules(max_fare=max_fare)).withColumns(
        {
            "pickup_ts": safe_timestamp("tpep_pickup_datetime"),
            "dropoff_ts": safe_timestamp("tpep_dropoff_datetime"),
        }
    )
    lasting = timed.withColumn("trip_duration_min", minutes_between("pickup_ts", "dropoff_ts")).filter(
        F.col("pickup_ts").isNotNull()
        & (F.col("trip_duration_min") > 0)
        & (F.col("trip_duration_min") < max_minutes)
    )
    return lasting.withColumns(
        {
            "pickup_hour": F.hour("pickup_ts"),
            "pickup_dow": F.dayofweek("pickup_ts"),
            "pickup_date": F.to_date("pickup_ts"),
            "fare_per_mile": ratio("fare_amount", "trip_distance"),
        }
    )


def trip_features(
    raw: DataFrame,
    max_fare: float = 500.0,
    max_minutes: float = MAX_TRIP_MINUTES,
    scale: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The twelve trip features, the pickup day, and any extra input columns named in ``keep``."""
    trips = clean_trips(raw, max_fare, max_minutes)
    zoned = zone_values(trips, "PULocationID", "pickup_hour", "fare_amount", "trip_distance", scale)
    return zoned.select(*keep, *TRIP_FEATURES, "pickup_date")


def event_rows(
    raw: DataFrame,
    user: str = "user_id",
    item: str = "parent_asin",
    rating: str = "rating",
    timestamp: str = "timestamp",
    epoch_unit: str | None = None,
    **limits: Any,
) -> DataFrame:
    """Interactions as events: rating class and day. ``limits`` go to ``rating_class``."""
    return raw.select(
        F.col(user).alias("user_id"),
        F.col(item).alias("item_id"),
        F.col(rating).alias("rating"),
        F.col(timestamp).alias("timestamp"),
        rating_class(rating, **limits).alias("event_type"),
        day_of(timestamp, epoch_unit).alias("date"),
    )


def item_rows(
    raw: DataFrame,
    item: str = "parent_asin",
    title: str = "title",
    categories: str = "categories",
    price: str = "price",
    main_category: str = "main_category",
    store: str = "store",
    author: str = "author",
    **limits: Any,
) -> DataFrame:
    """Item metadata with price bucket and presence flag. ``limits`` go to ``price_bucket``."""
    return raw.select(
        F.col(item).alias("item_id"),
        F.col(title).alias("title"),
        F.col(categories).alias("category_raw"),
        F.col(price).alias("price_raw"),
        F.col(main_category).alias("main_category"),
        F.col(store).alias("store"),
        F.col(author).alias("author"),
        price_bucket(price, **limits).alias("price_bucket"),
        is_present(store).alias("has_brand"),
    )


def run_wine(spark: SparkSession, path: str, out: str) -> dict[str, Any]:
    """CSV folder to partitioned feature table; returns the run metrics."""
    return write_parquet(wine_features(read_wine(spark, path)), out, ["wine_type"], "wine", path)


def run_trips(spark: SparkSession, path: str, out: str) -> dict[str, Any]:
    """Trip files to a feature table partitioned by day; returns the run metrics."""
    return write_parquet(trip_features(spark.read.parquet(path)), out, ["pickup_date"], "taxi", path)


def run_events(raw: DataFrame, out: str, **columns: Any) -> dict[str, Any]:
    """Interactions to an event table partitioned by day."""
    return write_parquet(event_rows(raw, **columns), out, ["date"], "events")


def run_items(raw: DataFrame, out: str, **columns: Any) -> dict[str, Any]:
    """Item metadata to an item table."""
    return write_parquet(item_rows(raw, **columns), out, dataset="items")


def gate_features(features: DataFrame, dataset: str, minimum: int) -> DataFrame:
    """The features, or an error if the table is too small to go on with."""
    enforce(row_count_test(features, dataset, minimum))
    return features

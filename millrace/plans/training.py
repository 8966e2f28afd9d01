"""Training rows, models, scoring and model metrics."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import require_columns
from millrace.functions.measures import score_tier
from millrace.functions.rules import Rule, keep_valid
from millrace.operators.boosting import BoostedTrees, boost
from millrace.operators.encode import encode_categories
from millrace.operators.sampling import stratified_split
from millrace.session import materialize

# Feature order, target, tier names, model settings, encoded and cast columns.
WINE_FEATURES = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
    "wine_type",
]
WINE_TARGET = "quality"
TIER_NAMES = {"low": "3-5", "medium": "6-7", "high": "8-9"}
TIER_TREES, TIER_DEPTH, TIER_RATE = 200, 6, 0.1
RANKER_ROUNDS, RANKER_DEPTH, RANKER_RATE = 131, 7, 0.1944
PATIENCE = 10
TEST_SHARE = 0.2
SEED = 42
CATEGORIES = ["user_id", "item_id", "event_type", "main_category", "price_bucket"]
DOUBLES = ["rating", "price_raw"]
FLAGS = ["has_brand"]


def cast_numeric(df: DataFrame, doubles: Sequence[str] = DOUBLES, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Doubles and 0/1 integers for the named columns that exist."""
    casts: dict[str, Column] = {c: F.col(c).try_cast("double") for c in doubles if c in df.columns}
    casts |= {c: F.col(c).cast("int") for c in flags if c in df.columns}
    return df.withColumns(casts) if casts else df


def join_splits(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Both splits in one frame; ``is_validation`` tells them apart later."""
    return train.withColumn("is_validation", F.lit(False)).unionByName(
        validation.withColumn("is_validation", F.lit(True))
    )


def ranking_rows(
    train: DataFrame,
    validation: DataFrame,
    order_key: Sequence[str],
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """Encoded training and validation rows. Codes are shared, first seen in training order."""
    both = cast_numeric(join_splits(train, validation))
    present = [c for c in categories if c in both.columns]
    return encode_categories(both, present, ["is_validation", *order_key])


def feature_vector(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """Add the column ``features`` in fixed order; a missing input column is an error."""
    require_columns(df, [*features, *([target] if target else [])])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def train_tiers(
    rows: DataFrame,
    features: Sequence[str] = WINE_FEATURES,
    label: str = "tier",
    trees: int = TIER_TREES,
    depth: int = TIER_DEPTH,
    rate: float = TIER_RATE,
    boosted: bool = True,
    seed: int = SEED,
) -> PipelineModel | BoostedTrees:
    """Three-class tree model: boosted trees by softmax, ``trees`` rounds of one tree per class.

    Without ``boosted`` it is a forest, for which ``rate`` has no meaning; boosting has no use for ``seed``.
    """
    if boosted:
        return boost(rows, features, label, len(TIER_NAMES), rounds=trees, depth=depth, rate=rate)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[assembler, model]).fit(rows)


def stopping_round(losses: Sequence[float], patience: int) -> int:
    """The 1-based round before the first ``patience`` rounds that bring no improvement."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def train_ranker(
    rows: DataFrame,
    features: Sequence[str],
    label: str = "label",
    validation: str = "is_validation",
    rounds: int = RANKER_ROUNDS,
    depth: int = RANKER_DEPTH,
    rate: float = RANKER_RATE,
    patience: int = PATIENCE,
) -> BoostedTrees:
    """Boosted binary ranker that stops after ``patience`` rounds without a better validation loss.

    Without validation rows all rounds are trained.
    """
    return boost(rows, features, label, 2, validation, rounds, depth, rate, patience)


def score(
    model: PipelineModel | BoostedTrees, requests: DataFrame, version: str, rules: Sequence[Rule] = ()
) -> DataFrame:
    """Valid requests with integer class, class probabilities if the model gives them, and model version."""
    valid = keep_valid(requests, rules) if rules else requests
    found = model.transform(valid)
    added = [F.col("prediction").cast("int").alias("prediction")]
    if "probability" in found.columns:
        is_array = dict(found.dtypes)["probability"].startswith("array")
        added.append(F.col("probability") if is_array else vector_to_array("probability").alias("probability"))
    return found.select(*requests.columns, *added).withColumn("model_version", F.lit(version))


def confusion_counts(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per pair of class and predicted class."""
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_report(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per class seen as label or prediction: precision, recall, F1, support.

    The data is reduced to class pairs once; everything else works on those few rows. A share of
    nothing is 0.
    """
    pairs = confusion_counts(predictions, label, prediction)
    sides = F.inline(
        F.array(
            F.struct(F.col("label").alias("class"), F.col("rows").alias("support"), F.lit(0).alias("named")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("rows").alias("named")),
        )
    )
    hits = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)
    # A hit is counted on the label's side only, so that it counts once.
    per_class = (
        pairs.withColumn("hits", hits)
        .select("hits", sides)
        .groupBy("class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("named").alias("named"),
            F.sum(F.when(F.col("support") > 0, F.col("hits")).otherwise(0)).alias("hits"),
        )
    )
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    rated = per_class.withColumns({"precision": share("hits", "named"), "recall": share("hits", "support")})
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        F.lit(0.0),
    )
    return rated.withColumn("f1", f1)


def accuracy_and_macro_f1(report: DataFrame) -> DataFrame:
    """One row: accuracy and the unweighted mean of the classes' F1."""
    return report.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.sum("support").alias("rows"),
    )


def log_loss(label: Column | str, probability: Column | str, floor: float = 1e-15) -> Column:
    """Mean negative log-likelihood of 0/1 labels under the probability of class 1, as an aggregate."""
    label = F.col(label) if isinstance(label, str) else label
    probability = F.col(probability) if isinstance(probability, str) else probability
    safe = F.least(F.greatest(probability, F.lit(floor)), F.lit(1 - floor))
    return F.avg(-F.log(F.when(label == 1, safe).otherwise(1 - safe)))


def tiered(rows: DataFrame, score_column: str = WINE_TARGET) -> DataFrame:
    """Rows with the integer target ``tier``."""
    return rows.withColumn("tier", score_tier(score_column))


def train_and_evaluate(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] = WINE_FEATURES,
    target: str = WINE_TARGET,
    **settings: Any,
) -> tuple[PipelineModel | BoostedTrees, dict[str, float], DataFrame]:
    """Tier, split, train and test: the model, its test metrics, and the report per class.

    Rows should already have passed their gates.
    """
    split = materialize(
        stratified_split(tiered(require_columns(rows, [*features, target]), target), "tier", keys), "split"
    )
    model = train_tiers(split.filter("split = 'train'"), features, **settings)
    predictions = model.transform(split.filter("split = 'test'"))
    report = materialize(classification_report(predictions, "tier"), "report")
    metrics = accuracy_and_macro_f1(report).select("accuracy", "f1_macro").first().asDict()
    return model, metrics, report


def settings_used(**given: Any) -> dict[str, Any]:
    """The settings a tier model is trained with: those given, and the defaults of the rest."""
    defaults = {"trees": TIER_TREES, "depth": TIER_DEPTH, "rate": TIER_RATE, "boosted": True, "seed": SEED}
    return defaults | {"test_share": TEST_SHARE} | given


def save_model(
    spark: SparkSession,
    model: PipelineModel | BoostedTrees,
    path: str,
    name: str,
    metrics: Mapping[str, float],
    params: Mapping[str, Any],
    features: Sequence[str] = WINE_FEATURES,
    target: str = WINE_TARGET,
) -> None:
    """Model, and beside it a metadata document: name, features, target, tiers, metrics, settings."""
    if isinstance(model, BoostedTrees):
        model.save(spark, f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    # The document's keys.
    metadata = {
        "model_name": name,
        "feature_columns": list(features),
        "target_column": target,
        "quality_tiers": TIER_NAMES,
        "metrics": dict(metrics),
        "params": dict(params),
    }
    document = spark.createDataFrame([(json.dumps(metadata),)], "value string")
    document.write.mode("overwrite").text(f"{path}/metadata")

"""Rating, success and longevity models on MLlib, with their scores and feature rankings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from venuekit.operators.metrics import auc, classification_metrics, regression_metrics
from venuekit.operators.sampling import split, with_split
from venuekit.schema import FEATURE_IMPORTANCE

# The features of the first two models and the settings of all of them.
ANALYSIS_FEATURES = [
    "review_count", "is_open", "has_wifi", "price_level", "noise_level", "avg_useful", "avg_funny", "avg_cool",
]
SEED = 42
TRAIN_SHARE = 0.8
HOLDOUT_TRAIN_SHARE = 0.7


@dataclass(frozen=True)
class Fit:
    """A fitted pipeline, its test-side predictions, their metrics and the feature weights."""

    model: PipelineModel
    features: list[str]
    predictions: DataFrame
    metrics: DataFrame
    ranking: DataFrame


def assemble(df: DataFrame, features: Sequence[str], invalid: str = "error") -> DataFrame:
    """Add the feature vector; ``invalid`` says whether a null raises or drops the row."""
    return _assembler(features, invalid).transform(df)


def _assembler(features: Sequence[str], invalid: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)


def rank_features(spark: SparkSession, features: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """Feature weights by size, largest first; one row per feature."""
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    ranked = spark.createDataFrame(rows, FEATURE_IMPORTANCE)
    return ranked.orderBy(F.abs("importance").desc(), "feature")


def with_score(predictions: DataFrame) -> DataFrame:
    """Add the probability of class 1 as ``score``."""
    return predictions.withColumn("score", vector_to_array("probability")[1])


def other_columns(df: DataFrame, *excluded: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in excluded]


def _run(
    df: DataFrame, estimator: Estimator, features: Sequence[str], label: str, invalid: str, key: str
) -> Fit:
    train, test = split(df, key, TRAIN_SHARE, SEED)
    model = Pipeline(stages=[_assembler(features, invalid), estimator]).fit(train)
    predictions = model.transform(test)
    last = model.stages[-1]
    if "probability" in predictions.columns:
        predictions = with_score(predictions)
        metrics = auc(predictions, label)
    else:
        metrics = regression_metrics(predictions, label)
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    return Fit(model, list(features), predictions, metrics,
               rank_features(df.sparkSession, features, weights.toArray()))


def linear_stars(analysis: DataFrame, key: str = "business_id", features: Sequence[str] = ANALYSIS_FEATURES) -> Fit:
    """Linear regression of stars, solved by the normal equations in one pass."""
    estimator = LinearRegression(featuresCol="features", labelCol="stars", solver="normal")
    return _run(analysis, estimator, features, "stars", "error", key)


def forest_success(
    df: DataFrame, key: str = "business_id", features: Sequence[str] = ANALYSIS_FEATURES, invalid: str = "error"
) -> Fit:
    """Random forest for success: 100 trees of depth 5."""
    estimator = RandomForestClassifier(
        featuresCol="features", labelCol="success", numTrees=100, maxDepth=5, seed=SEED
    )
    return _run(df, estimator, features, "success", invalid, key)


def forest_stars(model_data: DataFrame, key: str = "business_id") -> Fit:
    """Random forest for stars: 50 trees of depth 8, over every column but id, stars and success."""
    estimator = RandomForestRegressor(featuresCol="features", labelCol="stars", numTrees=50, maxDepth=8, seed=SEED)
    return _run(model_data, estimator, other_columns(model_data, key, "stars", "success"), "stars", "skip", key)


def forest_success_wide(model_data: DataFrame, key: str = "business_id") -> Fit:
    """The success forest over every column but id, stars and success."""
    return forest_success(model_data, key, other_columns(model_data, key, "stars", "success"), "skip")


def logistic_open(model_data: DataFrame, key: str = "business_id") -> Fit:
    """Logistic regression of staying open; stars are a feature here."""
    estimator = LogisticRegression(featuresCol="features", labelCol="is_open", maxIter=20, regParam=0.1)
    return _run(model_data, estimator, other_columns(model_data, key, "is_open", "success"), "is_open", "skip", key)


def holdout_forest(
    df: DataFrame, key: str = "business_id", label: str = "success", exclude: Sequence[str] = ("stars",)
) -> Fit:
    """The dashboard's forest (50 trees of depth 3, leaves of at least 10) on a 70/30 split.

    Every row comes back; training rows have a null prediction. ``stars`` is left out by default because the
    label is derived from it.
    """
    features = other_columns(df, key, label, *exclude)
    estimator = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=50, maxDepth=3, minInstancesPerNode=10, seed=SEED
    )
    flagged = with_split(df, key, HOLDOUT_TRAIN_SHARE, SEED)
    model = Pipeline(stages=[_assembler(features, "skip"), estimator]).fit(flagged.filter("is_train"))
    scored = model.transform(flagged).select(
        *flagged.columns, F.when(~F.col("is_train"), F.col("prediction")).alias("prediction")
    )
    weights = model.stages[-1].featureImportances.toArray()
    return Fit(model, features, scored, classification_metrics(scored, label),
               rank_features(df.sparkSession, features, weights))


def model_rows(ranking: DataFrame, predictions: DataFrame) -> DataFrame:
    """Importance rows and prediction rows in one frame, absent columns null."""
    return ranking.unionByName(predictions, allowMissingColumns=True)

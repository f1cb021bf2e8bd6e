"""Forests as tables of nodes."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor

from venuekit.plans import forests as O

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        a, b = rng.random(), rng.randrange(5)
        rows.append((i, a, float(b), 1.0, float(a + b / 5 + rng.gauss(0, 0.2) > 0.9), 2 * a - b))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double, y double").repartition(3)


def fitted(data, kind, label, **options):
    estimator = kind(featuresCol="features", labelCol=label, seed=3, **options)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), estimator]).fit(data)


@pytest.mark.parametrize("kind, label, options", [
    (RandomForestClassifier, "label", {"numTrees": 9, "maxDepth": 4}), (RandomForestClassifier, "label", {"numTrees": 1, "maxDepth": 0}),
    (RandomForestRegressor, "y", {"numTrees": 7, "maxDepth": 5}), (RandomForestClassifier, "b", {"numTrees": 5, "maxDepth": 3}),
])
def test_rows_routed_by_the_table_are_predicted_as_by_the_model(spark, data, kind, label, options):
    model = fitted(data, kind, label, **options)
    nodes = O.forest_nodes(model, FEATURES)
    assert nodes.where("node = 0").count() == options["numTrees"]
    classes = getattr(model.stages[-1], "numClasses", 0)
    routed = {r.id: r.p for r in O.route(data, nodes, FEATURES, classes, "p").collect()}
    for r in model.transform(data).collect():
        assert routed[r.id] == (r.prediction if classes else pytest.approx(r.prediction, rel=1e-12))
    weights = {r.feature: r.importance for r in O.importances(nodes).collect()}
    want = dict(zip(FEATURES, model.stages[-1].featureImportances.toArray()))
    assert {f: weights.get(f, 0.0) or 0.0 for f in FEATURES} == pytest.approx(want)


def test_ranks_are_by_weight_then_by_name(spark):
    weights = spark.createDataFrame([("x", 0.25), ("y", -0.5), ("w", 0.25)], "feature string, importance double")
    got = [tuple(r) for r in O.with_ranks(weights, ["w", "x", "y", "z"]).orderBy("rank").collect()]
    assert got == [(1, "y", -0.5), (2, "w", 0.25), (3, "x", 0.25), (4, "z", 0.0)]


def test_a_missing_feature_has_no_prediction(spark, data):
    nodes = O.forest_nodes(fitted(data, RandomForestClassifier, "label", numTrees=2, maxDepth=2), FEATURES)
    rows = spark.createDataFrame([(1, None, 1.0, 1.0), (2, float("nan"), 1.0, 1.0), (3, 0.5, 1.0, 1.0)], "id long, a double, b double, c double")
    got = {r.id: r.prediction for r in O.route(rows, nodes, FEATURES, 2).collect()}
    assert got[1] is None and got[2] is None and got[3] in (0.0, 1.0)

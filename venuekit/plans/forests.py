"""Fitted forests as tables: nodes as rows, predictions and importances from these rows alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.operators.ranks import attach
from venuekit.session import new_path


def forest_nodes(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(tree, node, feature, threshold, gain, n, left, right, prediction, shares) of the model's forest.

    A leaf has no feature; ``n`` is the weight of the training rows in the node, and shares are their counts by class (a
    regression has none). The nodes are read from the saved model, so the table holds what a saved model holds.
    """
    spark = SparkSession.getActiveSession()
    forest = model.stages[-1]
    path = new_path(spark, "forest")
    forest.write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    leaf = node["leftChild"] < 0
    names = F.lit(list(features))
    stats = node["impurityStats"]
    classes = hasattr(forest, "numClasses")
    n = F.aggregate(stats, F.lit(0.0), lambda s, x: s + x) if classes else F.get(stats, F.lit(0))
    return stored.select(
        F.col("treeID").cast("int").alias("tree"), node["id"].cast("int").alias("node"),
        F.when(~leaf, F.get(names, node["split"]["featureIndex"])).alias("feature"),
        F.when(~leaf, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~leaf, node["gain"]).alias("gain"), n.alias("n"),
        F.when(~leaf, node["leftChild"]).cast("int").alias("left"), F.when(~leaf, node["rightChild"]).cast("int").alias("right"),
        node["prediction"].alias("prediction"), (stats if classes else F.array().cast("array<double>")).alias("shares"),
    )


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance): each tree's gains by feature, weighted by rows and scaled to 1, summed and scaled to 1."""
    gains = nodes.where(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("gain"))
    whole = gains.groupBy("tree").agg(F.sum("gain").alias("all"))
    shares = gains.join(whole, "tree").groupBy("feature").agg(F.sum(F.try_divide("gain", "all")).alias("share"))
    total = shares.agg(F.sum("share").alias("total"))
    return attach(shares, total, ()).select("feature", F.try_divide("share", "total").alias("importance"))


def with_ranks(weights: DataFrame, features: Sequence[str]) -> DataFrame:
    """(rank, feature, importance): every feature, the heaviest first, ties by name; one without a split weighs 0."""
    spark = weights.sparkSession
    every = spark.createDataFrame([(f,) for f in features], "feature string")
    filled = every.join(F.broadcast(weights.select("feature", "importance")), "feature", "left").fillna({"importance": 0.0})
    # one row a feature
    listed = filled.agg(F.array_sort(F.collect_list(F.struct((-F.abs("importance")).alias("by"), "feature", "importance"))).alias("all"))
    ranked = listed.select(F.posexplode("all").alias("at", "f"))
    return ranked.select((F.col("at") + 1).alias("rank"), "f.feature", "f.importance")


def _trees(nodes: DataFrame, features: Sequence[str]) -> tuple[DataFrame, int]:
    """The forest as one array of trees, each an array of nodes by number, in one row; and the depth of the deepest.

    A forest is bounded by its settings: trees x 2^(depth + 1) nodes.
    """
    place = {f: i for i, f in enumerate(features)}
    trees: dict[int, dict] = {}
    for r in nodes.collect():
        trees.setdefault(r.tree, {})[r.node] = r

    def depth(tree: dict, node: int) -> int:
        r = tree[node]
        return 0 if r.left is None else 1 + max(depth(tree, r.left), depth(tree, r.right))

    spark = nodes.sparkSession
    rows = [
        (t, [(place.get(r.feature, -1), r.threshold, r.left, r.right, r.prediction, list(r.shares)) for _, r in sorted(tree.items())])
        for t, tree in sorted(trees.items())
    ]
    kind = "array<struct<feature:int,threshold:double,left:int,right:int,prediction:double,shares:array<double>>>"
    table = spark.createDataFrame(rows, f"tree int, nodes {kind}").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("tree", "nodes"))), lambda t: t["nodes"]).alias("forest")
    )
    return table, max((depth(tree, 0) for tree in trees.values()), default=0)


def route(df: DataFrame, nodes: DataFrame, features: Sequence[str], classes: int = 0, column: str = "prediction") -> DataFrame:
    """``df`` with the forest's prediction from a table of nodes: each row walks down each tree by native expressions.

    With ``classes`` trees vote with their leaf's shares and the heaviest class wins, the first of equals; without, their
    predictions are averaged. A row with a null or NaN feature has no prediction.
    """
    forest, deepest = _trees(nodes, features)
    values = F.array(*[F.col(f).cast("double") for f in features])
    known = F.lit(True)
    for f in features:
        known = known & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    given = attach(df.withColumn("_x", values), forest, ())

    def leaf(tree: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            side = F.when(F.get(F.col("_x"), node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])
            return F.when(node["feature"] < 0, at).otherwise(side)

        steps = F.sequence(F.lit(1), F.lit(deepest)) if deepest else F.array().cast("array<int>")
        return F.get(tree, F.aggregate(steps, F.lit(0), down))

    leaves = F.transform("forest", leaf)
    if classes:
        zeros = F.array_repeat(F.lit(0.0), classes)
        share = lambda s: F.transform(s, lambda x: x / F.aggregate(s, F.lit(0.0), lambda a, b: a + b))
        votes = F.aggregate(leaves, zeros, lambda sums, n: F.zip_with(sums, share(n["shares"]), lambda a, b: a + b))
        given = given.withColumn("_votes", votes)
        found = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
    else:
        found = F.aggregate(leaves, F.lit(0.0), lambda s, n: s + n["prediction"]) / F.size("forest")
    return given.withColumn(column, F.when(known, found)).select(*df.columns, column)

"""Fitted trees as tables: their nodes, what a shallower or smaller ensemble would say, their leaves' intervals."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import fresh_folder

NODES = "tree int, node int, feature int, threshold double, low int, high int, value double"
DEEP = 1 << 20
"""A depth that no tree has: nothing is cut."""


def nodes(spark: SparkSession, model: RandomForestRegressionModel | GBTRegressionModel) -> DataFrame:
    """``tree, node, feature, threshold, low, high, value, weight, sorted``: a row per node, numbered from the root
    with the lower branch first; a leaf has no children (-1). ``sorted`` says that the split is by a threshold."""
    path = fresh_folder(spark, "trees")
    model.write().save(path)
    data, trees = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/treesMetadata")
    n = F.col("nodeData")
    rows = data.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["leftChild"].alias("low"), n["rightChild"].alias("high"), n["prediction"].alias("value"),
        ((n["leftChild"] < 0) | (n["split"]["numCategories"] == -1)).alias("sorted"),
    )
    weights = trees.toDF("tree", "_", "weight").select("tree", "weight")
    return rows.join(weights, "tree")


def _by_node(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    """A tree's columns, by node number, and every node's depth."""
    rows = rows.sort_values("node")
    own = {c: rows[c].to_numpy() for c in ("node", "feature", "threshold", "low", "high", "value")}
    place = np.full(int(own["node"].max()) + 1, -1)
    place[own["node"]] = np.arange(len(rows))
    depth = np.zeros(len(rows), np.int64)
    # children come after their parents
    for i in np.flatnonzero(own["low"] >= 0).tolist():
        depth[place[own["low"][i]]] = depth[place[own["high"][i]]] = depth[i] + 1
    return own | {"place": place, "depth": depth}


def leaf_values(spark: SparkSession, model: RandomForestRegressionModel | GBTRegressionModel, depths: Sequence[int | None]) -> DataFrame:
    """``tree, leaf, weight, v0, v1, ...``: what each leaf says if its tree stops at each of the depths.

    A node keeps the mean of its own rows, so a tree stopped at a depth is the tree grown to that depth.
    ``leaf`` counts a tree's leaves from the lowest branch, as Spark's leaf column does."""
    stops = [DEEP if d is None else d for d in depths]

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        tree = _by_node(rows)
        leaves = np.flatnonzero(tree["low"] < 0)
        out = {"tree": rows["tree"].iloc[0], "leaf": np.arange(len(leaves)), "weight": rows["weight"].iloc[0]}
        for k, stop in enumerate(stops):
            # nodes are numbered branch by branch, so the last node at the stop before a leaf is above it
            ends = np.where((tree["depth"] == stop) | ((tree["depth"] < stop) & (tree["low"] < 0)), np.arange(len(tree["low"])), 0)
            out[f"v{k}"] = tree["value"][np.maximum.accumulate(ends)[leaves]]
        return pd.DataFrame(out)

    schema = "tree int, leaf int, weight double, " + ", ".join(f"v{k} double" for k in range(len(stops)))
    return nodes(spark, model).groupBy("tree").applyInPandas(cut, schema)


def cut_predictions(
    model: RandomForestRegressionModel | GBTRegressionModel, rows: DataFrame, depths: Sequence[int | None], trees: Sequence[int], keep: Sequence[str]
) -> DataFrame:
    """``keep`` and a column ``p<depth place>_<trees>`` for every smaller ensemble, all from one walk through the trees.

    A row's leaves are looked up and summed where the row lies; a forest's trees are averaged, a boosted model's added.
    """
    mean = isinstance(model, RandomForestRegressionModel)
    walked = model.copy({model.leafCol: "_leaves"}).transform(rows)
    walked = walked.select(*keep, "_leaves", F.monotonically_increasing_id().alias("_row"))
    walked = walked.select(*keep, "_row", F.posexplode(vector_to_array("_leaves")).alias("tree", "_leaf"))
    told = walked.withColumn("leaf", F.col("_leaf").cast("int")).join(leaf_values(rows.sparkSession, model, depths), ["tree", "leaf"])
    sums = [
        (F.sum(F.when(F.col("tree") < t, F.col(f"v{k}") * F.col("weight"))) / F.lit(float(t) if mean else 1.0)).alias(f"p{k}_{t}")
        for k in range(len(depths))
        for t in trees
    ]
    return told.groupBy("_row", *keep).agg(*sums).drop("_row")


def leaf_paths(spark: SparkSession, model: RandomForestRegressionModel | GBTRegressionModel) -> DataFrame:
    """``tree, leaf, gain, path``: each leaf's value times its tree's share of the forecast, and for every feature on its way
    the interval (low, high] it admits. Splits by category raise."""
    mean = isinstance(model, RandomForestRegressionModel)
    share = 1.0 / model.getNumTrees if mean else 1.0
    table = nodes(spark, model)
    if not table.where(~F.col("sorted")).isEmpty():
        raise ValueError("leaf intervals need splits by thresholds")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        tree = _by_node(rows)
        ways: list[dict[int, tuple[float, float]]] = [{} for _ in tree["node"]]
        out = []
        for i, way in enumerate(ways):
            if tree["low"][i] < 0:
                path = [{"feature": f, "low": a, "high": b} for f, (a, b) in sorted(way.items())]
                out.append((int(rows["tree"].iloc[0]), len(out), float(tree["value"][i] * rows["weight"].iloc[0]) * share, path))
                continue
            f, t = int(tree["feature"][i]), float(tree["threshold"][i])
            a, b = way.get(f, (-np.inf, np.inf))
            ways[tree["place"][tree["low"][i]]] = way | {f: (a, min(b, t))}
            ways[tree["place"][tree["high"][i]]] = way | {f: (max(a, t), b)}
        return pd.DataFrame(out, columns=["tree", "leaf", "gain", "path"])

    return table.groupBy("tree").applyInPandas(walk, "tree int, leaf int, gain double, path array<struct<feature:int,low:double,high:double>>")


def boosted_from_nodes(spark: SparkSession, rows: Sequence[tuple], n_trees: int, n_features: int, estimator: GBTRegressor) -> GBTRegressionModel:
    """Spark's boosted model of trees given as ``NODES`` rows, each tree with weight 1: written in the model's stored form and loaded."""
    path = fresh_folder(spark, "boosted")
    estimator.write().save(f"{path}-estimator")
    meta = json.loads(spark.read.text(f"{path}-estimator/metadata").first()[0])
    own = meta | {"class": "org.apache.spark.ml.regression.GBTRegressionModel", "numFeatures": n_features, "numTrees": n_trees}
    spark.createDataFrame([(json.dumps(own),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    # a tree's parameters are those that it shares with the ensemble
    shared = {"cacheNodeIds", "checkpointInterval", "featuresCol", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "predictionCol", "seed"}
    params = {k: {p: v for p, v in meta[k].items() if p in shared} for k in ("paramMap", "defaultParamMap")}
    trees = [(i, json.dumps(meta | params | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": f"dtr_{i}"}), 1.0) for i in range(n_trees)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    leaf = F.col("low") < 0
    split = F.struct(
        F.when(leaf, -1).otherwise(F.col("feature")).alias("featureIndex"),
        F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    data = spark.createDataFrame(list(rows), NODES).select(
        F.col("tree").alias("treeID"),
        F.struct(
            F.col("node").alias("id"), F.col("value").alias("prediction"), F.lit(0.0).alias("impurity"),
            F.array(F.lit(1.0), F.col("value"), F.col("value") * F.col("value")).alias("impurityStats"), F.lit(1).cast("bigint").alias("rawCount"),
            F.when(leaf, -1.0).otherwise(0.0).alias("gain"), F.col("low").alias("leftChild"), F.col("high").alias("rightChild"), split.alias("split"),
        ).alias("nodeData"),
    )
    data.write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)

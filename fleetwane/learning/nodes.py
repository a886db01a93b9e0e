"""Trees as rows: the node table of a stored ensemble, cut, chosen from, and made into a model again.

Growth is greedy from the root down, so a tree that stops earlier is a part of the tree that
goes on: a minimum number of rows to split a node is a cut through the stored nodes, and
leaf-wise growth is a choice among the splits of a tree that is deep enough. A node table is as
large as the model, not as the data.
"""

from __future__ import annotations

import heapq
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwane.session import scratch_dir

# The columns of Spark's stored trees.
STORED = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
NODE = "tree int, id int, prediction double, impurity double, stats array<double>, n bigint, gain double, left int, right int, feature int, threshold double"


def saved(model) -> str:
    """Where a copy of the model is stored."""
    path = f"{scratch_dir(SparkSession.active())}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    return path


def node_table(model) -> DataFrame:
    """One row per node of every tree; leaves have left, right and feature -1, n counts the rows of the sample."""
    return read_nodes(SparkSession.active(), saved(model))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table of a stored ensemble."""
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        node["impurity"].alias("impurity"),
        node["impurityStats"].alias("stats"),
        node["rawCount"].alias("n"),
        node["gain"].alias("gain"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    )


def _as_stored(nodes: DataFrame) -> DataFrame:
    threshold = F.when(F.col("left") < 0, F.array().cast("array<double>")).otherwise(F.array("threshold"))
    split = F.struct(F.col("feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = F.struct(
        F.col("id"),
        F.col("prediction"),
        F.col("impurity"),
        F.col("stats").alias("impurityStats"),
        F.col("n").alias("rawCount"),
        F.col("gain"),
        F.col("left").alias("leftChild"),
        F.col("right").alias("rightChild"),
        split.alias("split"),
    )
    return nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).to(_stored_schema(nodes.sparkSession))


def _stored_schema(spark: SparkSession):
    return spark.createDataFrame([], STORED).schema


# ---------------------------------------------------------------- a minimum of rows to split


def require_rows_to_split(nodes: DataFrame, least: int) -> DataFrame:
    """The trees without the splits of nodes with fewer than ``least`` rows, and without what is below.

    Rows only get fewer on the way down, so a node stays if its parent may be split.
    """
    may_split = (F.col("left") >= 0) & (F.col("n") >= least)
    below = nodes.filter(may_split).select("tree", F.explode(F.array("left", "right")).alias("id"))
    kept = nodes.join(below, ["tree", "id"], "left_semi").unionByName(nodes.filter("id = 0"))

    def leaf(name: str, value: float) -> Column:
        return F.when(may_split, F.col(name)).otherwise(F.lit(value)).cast(dict(nodes.dtypes)[name]).alias(name)

    cut = kept.select(
        "tree", "id", "prediction", "impurity", "stats", "n", leaf("gain", -1), leaf("left", -1), leaf("right", -1), leaf("feature", -1), "threshold"
    )
    return renumbered(cut)


def renumbered(nodes: DataFrame) -> DataFrame:
    """Node ids 0, 1, 2, ... per tree again, in the order that they have."""
    number = F.row_number().over(Window.partitionBy("tree").orderBy("id")) - 1
    numbered = nodes.withColumn("number", number)
    names = numbered.select("tree", F.col("id").alias("old"), F.col("number").alias("new"))
    out = numbered
    for side in ("left", "right"):
        found = names.withColumnsRenamed({"old": side, "new": f"new_{side}"})
        out = out.join(found, ["tree", side], "left")
    return out.select(
        "tree",
        F.col("number").alias("id"),
        *("prediction", "impurity", "stats", "n", "gain"),
        *(F.coalesce(f"new_{side}", F.lit(-1)).alias(side) for side in ("left", "right")),
        *("feature", "threshold"),
    )


def walk(df: DataFrame, key: str, vector: str, nodes: DataFrame, weights: Sequence[float], *, mean: bool) -> DataFrame:
    """(key, prediction) of every row by leading it down the trees, one join with the node table per level.

    The state of a row is one node per tree; a row that has reached a leaf stays there.
    """
    spark = df.sparkSession
    table = F.broadcast(nodes.select("tree", "id", "left", "right", "feature", "threshold", F.col("prediction").alias("value")))  # the model
    roots = F.explode(F.sequence(F.lit(0), F.lit(len(weights) - 1)))
    state = df.select(key, vector_to_array(vector).alias("cells"), roots.alias("tree")).withColumn("id", F.lit(0))
    for _ in range(_depth(nodes)):
        goes_left = F.get("cells", F.col("feature")) <= F.col("threshold")
        below = F.when(F.col("left") < 0, F.col("id")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        state = state.join(table, ["tree", "id"]).select(key, "cells", "tree", below.alias("id"))
    share = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "tree int, weight double")
    reached = state.join(table, ["tree", "id"]).join(F.broadcast(share), "tree")
    total = F.sum(F.col("value") * F.col("weight"))
    return reached.groupBy(key).agg((total / F.sum("weight") if mean else total).alias("prediction"))


def _depth(nodes: DataFrame) -> int:
    """The most levels below a root: the number of joins that find no further child."""
    table, depth = nodes.filter("left >= 0").select("tree", "id", F.array("left", "right").alias("below")), 0
    front = nodes.filter("id = 0").select("tree", "id")
    while True:
        front = front.join(table, ["tree", "id"]).select("tree", F.explode("below").alias("id"))
        if front.isEmpty():
            return depth
        depth += 1


def rebuilt(model, nodes: DataFrame):
    """An ensemble like ``model`` with the trees of ``nodes`` instead of its own."""
    spark = nodes.sparkSession
    old, new = saved(model), f"{scratch_dir(spark)}/trees-{uuid.uuid4().hex}"
    spark.read.text(f"{old}/metadata").coalesce(1).write.text(f"{new}/metadata")
    spark.read.parquet(f"{old}/treesMetadata").coalesce(1).write.parquet(f"{new}/treesMetadata")
    _as_stored(nodes).write.parquet(f"{new}/data")
    return type(model).load(new)


# ---------------------------------------------------------------- one tree on the driver


@dataclass(frozen=True)
class Node:
    """A node of one tree."""

    id: int
    prediction: float
    impurity: float
    stats: tuple[float, ...]
    n: int
    gain: float
    left: int
    right: int
    feature: int
    threshold: float | None

    @property
    def weight(self) -> float:
        """By how much the split lowers the sum of squared errors."""
        return self.gain * self.stats[0]

    @property
    def squares(self) -> float:
        """The sum of squared errors of the node, the most that splits below can win."""
        count, total, squares = self.stats
        return squares - total * total / count if count else 0.0


def tree_rows(nodes: DataFrame) -> list[Node]:
    """The nodes of a table with one tree (bounded by the tree's depth), by id."""
    rows = nodes.drop("tree").collect()
    return sorted((Node(**(r.asDict() | {"stats": tuple(r.stats)})) for r in rows), key=lambda node: node.id)


def best_first(tree: Sequence[Node], leaves: int) -> list[int]:
    """The splits, in the order in which a tree that always splits the best leaf next makes them."""
    chosen: list[int] = []
    heap = [(-tree[0].weight, 0)] if tree[0].left >= 0 else []
    while heap and len(chosen) < leaves - 1:
        _, i = heapq.heappop(heap)
        chosen.append(i)
        for child in (tree[i].left, tree[i].right):
            if tree[child].left >= 0:
                heapq.heappush(heap, (-tree[child].weight, child))
    return chosen


def deep_enough(tree: Sequence[Node], leaves: int, depth: int, least: int) -> bool:
    """Whether a tree grown by level to ``depth`` decides which leaves best-first growth makes.

    It does not if a node that had to stop at the last level might win more than what was chosen last.
    Only children of chosen splits count: growth never comes to the other nodes of that level.
    """
    chosen = best_first(tree, leaves)
    enough = len(chosen) == leaves - 1
    last = min((tree[i].weight for i in chosen), default=0.0) if enough else 0.0
    level = levels(tree)
    reached = [tree[child] for i in chosen for child in (tree[i].left, tree[i].right) if level[child] == depth]
    return not any(node.left < 0 and node.n >= 2 * least and node.squares > last for node in reached)


def levels(tree: Sequence[Node]) -> list[int]:
    """The depth of each node."""
    out = [0] * len(tree)
    for node in tree:  # children have higher ids
        if node.left >= 0:
            out[node.left] = out[node.right] = out[node.id] + 1
    return out


def with_splits(tree: Sequence[Node], chosen: Sequence[int]) -> list[Node]:
    """The tree with only the chosen splits, nodes numbered from 0 in the order that they have."""
    splits, kept, open_ = set(chosen), [], [0]
    while open_:
        i = open_.pop()
        kept.append(i)
        if i in splits:
            open_ += [tree[i].left, tree[i].right]
    number = {i: k for k, i in enumerate(sorted(kept))}
    return [
        replace(tree[i], id=number[i], left=number[tree[i].left], right=number[tree[i].right])
        if i in splits
        else replace(tree[i], id=number[i], gain=-1.0, left=-1, right=-1, feature=-1, threshold=None)
        for i in sorted(kept)
    ]


def leaf_tree(value: float, n: int) -> list[Node]:
    """A tree of one leaf."""
    return [Node(0, value, 0.0, (float(n), value * n, value * value * n), n, -1.0, -1, -1, -1, None)]


def as_expression(tree: Sequence[Node], vector: str) -> str:
    """SQL of the tree's prediction, over an array column of the features."""

    def of(i: int) -> str:
        node = tree[i]
        if node.left < 0:
            return f"{node.prediction!r}D"
        return f"CASE WHEN {vector}[{node.feature}] <= {node.threshold!r}D THEN {of(node.left)} ELSE {of(node.right)} END"

    return of(0)


def as_boosted(trees: Sequence[Sequence[Node]], weights: Sequence[float], template: GBTRegressor, features: int) -> GBTRegressionModel:
    """A boosted model: the weighted sum of the trees. ``template`` has the parameters that the model tells."""
    spark = SparkSession.active()
    path = f"{scratch_dir(spark)}/trees-{uuid.uuid4().hex}"
    base = DecisionTreeRegressor(labelCol=template.getLabelCol(), maxDepth=template.getMaxDepth())
    package = "org.apache.spark.ml.regression"
    head = _metadata(template, f"{package}.GBTRegressionModel") | {"numFeatures": features, "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = json.dumps(_metadata(base, f"{package}.DecisionTreeRegressionModel"))
    listed = [(i, each, float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = [(k, *(getattr(node, c) for c in node.__dataclass_fields__)) for k, tree in enumerate(trees) for node in tree]
    _as_stored(spark.createDataFrame([(*r[:4], list(r[4]), *r[5:]) for r in rows], NODE)).coalesce(1).write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)


def _metadata(estimator, name: str) -> Mapping:
    """What a stored model tells of itself."""
    own = {p.name: v for p, v in estimator.extractParamMap().items() if p.name not in ("thresholds", "weightCol", "validationIndicatorCol")}
    return {
        "class": name,
        "timestamp": int(1000 * time.time()),
        "sparkVersion": SparkSession.active().version,
        "uid": estimator.uid,
        "paramMap": own,
        "defaultParamMap": {},
    }

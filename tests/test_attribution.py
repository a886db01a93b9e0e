"""Tree attributions against sums over all subsets."""

import itertools
import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fleetwane.learning import attribution, models, nodes

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    n = F.col("id")
    rows = spark.range(400).select(
        (n % 7).cast("double").alias("a"), F.sin(n).alias("b"), (F.floor(n / 7) % 5).cast("double").alias("c"), F.lit(1.0).alias("d")
    )
    label = F.col("a") * F.col("c") + F.when(F.col("b") > 0.3, F.col("a") * 2).otherwise(F.col("b") * 5)
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(rows.withColumn("RUL", label)).persist()


def expectation(tree, x, known, i=0):
    node = tree[i]
    if node.left < 0:
        return node.prediction
    low, high = (expectation(tree, x, known, child) for child in (node.left, node.right))
    if node.feature in known:
        return low if x[node.feature] <= node.threshold else high
    share = tree[node.left].stats[0] / node.stats[0]
    return share * low + (1 - share) * high


def shapley(trees, weights, x):
    d, out = len(COLUMNS), []
    for i in range(d):
        value = 0.0
        for size in range(d):
            for known in itertools.combinations([j for j in range(d) if j != i], size):
                w = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                value += w * sum(t * (expectation(tree, x, {*known, i}) - expectation(tree, x, set(known))) for tree, t in zip(trees, weights))
        out.append(value)
    return out


@pytest.mark.parametrize(
    "family,params",
    [
        (models.FOREST, {"n_estimators": 3, "max_depth": 5, "max_features": None, "min_samples_split": 8}),
        (models.BOOSTED, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.4, "colsample_bytree": 0.6}),
        (models.LEAFWISE, {"n_estimators": 2, "num_leaves": 6, "learning_rate": 0.5, "min_child_samples": 2}),
    ],
)
def test_attributions_equal_all_subsets(table, family, params):
    model = models.ESTIMATORS[family](params).fit(table)
    mean = family == models.FOREST
    total = sum(model.treeWeights) if mean else 1.0
    weights = [w / total for w in model.treeWeights]
    stored = nodes.node_table(model)
    trees = [nodes.tree_rows(stored.filter(F.col("tree") == k)) for k in range(len(weights))]
    rows = attribution.attributions(model.transform(table), model, COLUMNS, mean=mean).collect()
    for r in rows:  # they add up on every row
        assert r.expected + sum(r[f"{c}_share"] for c in COLUMNS) == pytest.approx(r.prediction, abs=1e-9)
        assert r.d_share == 0
    for r in rows[::40]:
        assert [r[f"{c}_share"] for c in COLUMNS] == pytest.approx(shapley(trees, weights, list(r.features)), abs=1e-9)
        assert r.expected == pytest.approx(sum(w * expectation(t, None, set()) for t, w in zip(trees, weights)))


def test_model_without_splits(table):
    flat = table.withColumn("RUL", F.lit(2.0))
    model = models.train_boosted({"n_estimators": 1, "max_depth": 2}).fit(flat)
    r = attribution.attributions(model.transform(flat), model, COLUMNS, mean=False).first()
    assert (r.expected, [r[f"{c}_share"] for c in COLUMNS]) == (2.0, [0.0] * 4)


def test_too_many_features_on_a_path():
    def chain(k):
        tree = []
        for i in range(k):
            tree.append(nodes.Node(2 * i, 0.0, 0.0, (2.0 * (k - i + 1), 0, 0), 1, 1.0, 2 * i + 1, 2 * i + 2, i, 0.0))
            tree.append(nodes.Node(2 * i + 1, 1.0, 0.0, (1.0, 0, 0), 1, -1.0, -1, -1, -1, None))
        return [*tree, nodes.Node(2 * k, 1.0, 0.0, (1.0, 0, 0), 1, -1.0, -1, -1, -1, None)]

    assert len(attribution.leaves(chain(5))) == 6
    with pytest.raises(ValueError):
        attribution.leaves(chain(attribution.MOST_ON_PATH + 1))

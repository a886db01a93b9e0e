"""Trees as rows, against plain Python trees."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fleetwane.learning import models, nodes, search

COLUMNS = ["a", "b", "c"]


def grown(rows, least_split, least_leaf, leaves=None, depth=30):
    """row -> prediction of the greedy tree, by plain loops; with ``leaves`` the best leaf is split next. Also its depth."""

    def best(own):
        if len(own) < least_split:
            return None
        total, found = sum(y for _, y in own), (1e-9, None)
        for j in range(len(COLUMNS)):
            for cut in sorted({x[j] for x, _ in own})[:-1]:
                low = [y for x, y in own if x[j] <= cut]
                if min(len(low), len(own) - len(low)) < least_leaf:
                    continue
                gain = sum(low) ** 2 / len(low) + (total - sum(low)) ** 2 / (len(own) - len(low)) - total**2 / len(own)
                if gain > found[0] + 1e-9:
                    found = (gain, (j, cut))
        return found if found[1] else None

    def entry(own, level):
        return [best(own) if level < depth else None, own, level]

    open_, splits = [entry(rows, 0)], 0
    while any(o[0] for o in open_) and (leaves is None or splits < leaves - 1):
        top = max((o for o in open_ if o[0]), key=lambda o: o[0][0])
        open_ = [o for o in open_ if o is not top]
        (_, (j, cut)), own, level = top
        open_ += [entry([r for r in own if r[0][j] <= cut], level + 1), entry([r for r in own if r[0][j] > cut], level + 1)]
        splits += 1
    return {x: sum(y for _, y in own) / len(own) for _, own, _ in open_ for x, _ in own}, max(level for *_, level in open_)


@pytest.fixture(scope="module")
def table(spark):
    """A label that falls off ever more steeply along ``a``: its trees are chains."""
    n = F.col("id")
    rows = spark.range(900).select(
        (n % 11).cast("double").alias("a"),
        (F.floor(n / 11) % 7).cast("double").alias("b"),
        (F.floor(n / 77) % 5).cast("double").alias("c"),
    )
    label = F.pow(F.lit(3.0), F.col("a")) + F.col("b") * 0.37 + F.sin(F.col("c") * F.col("b")) * 2
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(rows.withColumn("RUL", label)).persist()


@pytest.fixture(scope="module")
def rows(table):
    return [((r.a, r.b, r.c), r.RUL) for r in table.collect()]


def predictions(model, table):
    return {(r.a, r.b, r.c): r.prediction for r in model.transform(table).collect()}


def agree(got, want):
    return all(got[x] == pytest.approx(want[x], rel=1e-9, abs=1e-7) for x in want)


@pytest.mark.parametrize("least", [2, 40, 150, 2000])
def test_rows_to_split(table, rows, least):
    params = {"n_estimators": 1, "max_depth": 6, "min_samples_split": least, "bootstrap": False, "max_features": None}
    model = models.train_forest(params).fit(table)
    assert agree(predictions(model, table), grown(rows, least, 1, depth=6)[0])
    stored = nodes.node_table(model)
    assert stored.filter(f"left >= 0 and n < {least}").count() == 0
    assert stored.count() == 2 * stored.filter("left >= 0").count() + 1


def test_rows_to_split_cuts_every_tree_of_a_forest(spark, table):
    params = {"n_estimators": 7, "max_depth": 8, "max_features": "sqrt", "random_state": 3}
    whole, cut = models.train_forest(params).fit(table), models.train_forest(params | {"min_samples_split": 60}).fit(table)
    before, after = nodes.node_table(whole), nodes.node_table(cut)
    want = before.filter("left >= 0 and n >= 60").groupBy("tree").count()
    assert sorted(map(tuple, after.filter("left >= 0").groupBy("tree").count().collect())) == sorted(map(tuple, want.collect()))
    assert cut.getNumTrees == 7 and cut.treeWeights == whole.treeWeights
    path = nodes.saved(cut)
    assert predictions(type(cut).load(path), table) == predictions(cut, table)


@pytest.mark.parametrize("leaves", [2, 5, 9])
def test_best_leaf_next(table, rows, leaves):
    fit = models.train_boosted_leafwise({"n_estimators": 1, "num_leaves": leaves, "learning_rate": 1.0, "min_child_samples": 3})
    want, depth = grown(rows, 2, 3, leaves)
    assert leaves < 9 or depth > math.ceil(math.log2(leaves))  # deeper than a balanced tree of so many leaves
    model = fit.fit(table)
    assert agree(predictions(model, table), want)
    assert nodes.node_table(model).filter("tree = 1 and left < 0").count() == leaves


def node(i, total, squares, n, gain=-1.0, left=-1, right=-1):
    return nodes.Node(i, total / n, 0.0, (float(n), total, squares), n, gain, left, right, 0 if left >= 0 else -1, 0.5 if left >= 0 else None)


def test_only_children_of_chosen_splits_ask_for_depth():
    # the right child may win nothing, the left one's split is worth 1 of its 50 squares
    tree = [node(0, 0.0, 90.0, 40, 1.0, 1, 2), node(1, 0.0, 50.0, 20, 0.05, 3, 4), node(2, 0.0, 0.0, 20), node(3, 0.0, 45.0, 10), node(4, 0.0, 5.0, 10)]
    assert nodes.best_first(tree, 2) == [0] and nodes.deep_enough(tree, 2, 2, 3)  # nodes 3 and 4 are never reached
    assert nodes.best_first(tree, 3) == [0, 1] and not nodes.deep_enough(tree, 3, 2, 3)
    assert nodes.deep_enough(tree, 3, 2, 6)  # too few rows to split


def test_noise_is_not_grown_to_the_end(table):
    noise = table.drop("RUL").withColumn("RUL", F.pmod(F.xxhash64("a", "b", "c"), 1000).cast("double")).persist()
    own = [((r.a, r.b, r.c), r.RUL) for r in noise.collect()]
    want, depth = grown(own, 2, 3, 4)
    model = models.train_boosted_leafwise({"n_estimators": 1, "num_leaves": 4, "learning_rate": 1.0, "min_child_samples": 3}).fit(noise)
    assert agree(predictions(model, noise), want)
    assert model.getMaxDepth() <= depth + 1 + models.DEEPER  # not until nodes have too few rows to split


def test_leafwise_rounds(table, rows):
    model = models.train_boosted_leafwise({"n_estimators": 2, "num_leaves": 4, "learning_rate": 0.6, "min_child_samples": 1}).fit(table)
    fitted = dict.fromkeys([x for x, _ in rows], sum(y for _, y in rows) / len(rows))
    for _ in range(2):
        step, _depth = grown([(x, y - fitted[x]) for x, y in rows], 2, 1, 4)
        fitted = {x: fitted[x] + 0.6 * step[x] for x in fitted}
    assert agree(predictions(model, table), fitted)


def test_columns_per_tree(table, rows):
    params = {"n_estimators": 12, "max_depth": 2, "learning_rate": 0.4, "colsample_bytree": 0.34, "random_state": 5}
    model = models.train_boosted(params).fit(table)  # more rounds than between checkpoints
    used = nodes.node_table(model).filter("left >= 0").select("tree", "feature").distinct().collect()
    for r in used:
        assert [r.feature] == models.columns_of_round(3, 0.34, 5, r.tree - 1)
    assert {r.tree for r in used} == set(range(1, 13)) and {r.feature for r in used} == {0, 1, 2}
    assert [list(t.featureImportances.toArray()).count(0.0) >= 2 for t in model.trees] == [True] * 13
    assert model.treeWeights == [1.0, *[0.4] * 12]


def test_walk_equals_model(table):
    keyed = table.withColumn("key", F.monotonically_increasing_id()).persist()
    for family, params in ((models.FOREST, {"n_estimators": 4, "max_depth": 5}), (models.BOOSTED, {"n_estimators": 3, "max_depth": 3})):
        model = models.ESTIMATORS[family](params).fit(table)
        walked = nodes.walk(keyed, "key", "features", nodes.node_table(model), list(model.treeWeights), mean=family == models.FOREST)
        want = {r.key: r.prediction for r in model.transform(keyed).collect()}
        got = {r.key: r.prediction for r in walked.collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_grid_draws_rows_to_split():
    assert search.GRIDS[models.FOREST]["min_samples_split"] == [2, 5, 10]
    assert all("min_samples_split" in d for d in search.sample_params(search.GRIDS[models.FOREST], 10))


def test_constant_label_is_the_mean(spark, table):
    flat = table.withColumn("RUL", F.lit(5.0))
    for family in models.ESTIMATORS:
        model = models.ESTIMATORS[family]({"n_estimators": 2, "max_depth": 3, "num_leaves": 4, "min_samples_split": 5}).fit(flat)
        assert set(predictions(model, flat).values()) == {5.0}

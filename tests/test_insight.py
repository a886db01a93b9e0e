"""Principal components and permutation importance against NumPy and plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from fleetwane.learning import importance, models
from fleetwane.operators import components
from fleetwane.operators.permute import permuted, positions

RNG = np.random.default_rng(11)
DATA = RNG.normal(size=(600, 4)) @ RNG.normal(size=(4, 4)) + [1e6, 0, -5, 3]


@pytest.fixture(scope="module")
def table(spark):
    rows = [tuple(map(float, r)) for r in DATA] + [(None, 1.0, 2.0, 3.0), (1.0, 2.0, float("inf"), 4.0)]
    return spark.createDataFrame(rows, "a double, b double, c double, `d e` double")


COLUMNS = ["a", "b", "c", "d e"]


@pytest.mark.parametrize("standardize", [True, False])
def test_components_equal_numpy(spark, table, standardize):
    found = components.principal_components(table, COLUMNS, standardize=standardize)
    own = np.corrcoef(DATA.T) if standardize else np.cov(DATA.T)
    values, vectors = np.linalg.eigh(own)
    assert np.allclose(found.variances, values[::-1], rtol=1e-8)
    for loading, vector in zip(found.loadings, vectors.T[::-1]):
        assert abs(loading @ vector) == pytest.approx(1, abs=1e-8)
        assert loading[np.abs(loading).argmax()] > 0
    assert found.shares.sum() == pytest.approx(1)
    scores = np.array([[r[f"component_{i}"] for i in range(1, 5)] for r in found.project(table).collect()][: len(DATA)])
    assert np.allclose(np.cov(scores.T), np.diag(found.variances), atol=1e-6 * found.variances.max())
    assert [r.component for r in found.table(spark).orderBy("component", "sensor").collect()] == sorted([1, 2, 3, 4] * 4)


def test_missing_sensor_has_no_score(table):
    found = components.principal_components(table, COLUMNS, k=2)
    assert len(found.loadings) == 2
    assert found.project(table).filter("a is null").first()["component_1"] is None


def test_constant_sensor_and_too_few_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, k double")
    found = components.principal_components(df, ["a", "k"])
    assert found.variances == pytest.approx([1, 0]) and abs(found.loadings[0, 0]) == pytest.approx(1)
    with pytest.raises(ValueError):
        components.principal_components(df.limit(1), ["a", "k"])
    with pytest.raises(ValueError):
        components.principal_components(df.limit(0), ["a", "k"])


def test_gram_is_combined_before_the_shuffle(spark, table, folder):
    table.write.parquet(f"{folder}/t")
    plan = plan_of(components.gram_table(spark.read.parquet(f"{folder}/t"), COLUMNS))
    assert plan.count("HashAggregate") >= 2 and "Python" not in plan


def test_positions_are_dense_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.lit(None).cast("long").alias("place of")).repartition(16)
    rows = positions(df, [F.col("v")], "place").orderBy("place").collect()
    assert [r.place for r in rows] == list(range(5000))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_permuted_is_a_seeded_permutation(spark):
    df = spark.range(3000).select("id", (F.col("id") % 17).alias("x"), F.when(F.col("id") % 5 > 0, F.sin("id")).alias("y"))
    first = {r.id: (r.x_permuted, r.y_permuted) for r in permuted(df, ["x", "y"], ["id"], seed=1).collect()}
    again = {r.id: (r.x_permuted, r.y_permuted) for r in permuted(df.repartition(5), ["x", "y"], ["id"], seed=1).collect()}
    other = {r.id: (r.x_permuted, r.y_permuted) for r in permuted(df, ["x", "y"], ["id"], seed=2).collect()}
    given = {r.id: (r.x, r.y) for r in df.collect()}
    assert first == again != other
    assert sorted(map(str, first.values())) == sorted(map(str, given.values()))  # each pair of values once again
    assert sum(first[i] == given[i] for i in given) < 30
    assert permuted(df.limit(0), ["x"], ["id"]).count() == 0


def test_importance_tells_used_features(spark):
    n = F.col("id")
    df = spark.range(1500).select("id", (n % 13).cast("double").alias("a"), F.sin(n).alias("b"), (n % 7).cast("double").alias("c"))
    df = df.withColumn("RUL", F.col("a") * 10 + F.col("c")).persist()
    run = models.train_and_evaluate(models.FOREST, {"n_estimators": 3, "max_depth": 6, "max_features": None}, df, df, ["a", "b", "c"])
    rows = importance.permutation_importance(run.model, df, run.features, ["id"], repeats=2).collect()
    assert [r.feature for r in rows] == ["a", "c", "b"]
    assert rows[0].importance > 30 and abs(rows[2].importance) < 0.3
    again = importance.permutation_importance(run.model, df.repartition(3), run.features, ["id"], repeats=2).collect()
    assert [r.importance for r in rows] == pytest.approx([r.importance for r in again])
    r2 = importance.permutation_importance(run.model, df, run.features, ["id"], metric="R2").collect()
    assert r2[0].feature == "a" and 0.5 < r2[0].importance < 4 and not math.isnan(r2[0].importance)

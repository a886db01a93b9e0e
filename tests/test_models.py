import json

import pytest
from pyspark.sql import functions as F

from conftest import same
from fleetwane.learning import models, runs, search
from fleetwane.operators.columns import feature_columns
from fleetwane.operators.split import split_rows, split_units
from fleetwane.plans import jobs
from fleetwane.schema import MissingColumnsError

FOREST = {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 1, "max_features": "sqrt", "random_state": 42}


@pytest.fixture(scope="module")
def features(spark):
    n = F.col("id")
    telemetry = spark.range(1200).select(
        (n % 20).alias("unit"),
        F.floor(n / 20).alias("time_in_cycles"),
        (F.lit(100) - F.floor(n / 20) + F.sin(n) * 3).alias("sensor_2"),
        F.when(n % 13 != 0, F.cos(n) * 10).alias("sensor_3"),
    )
    return jobs.build_features(telemetry, ["sensor_2", "sensor_3"], with_score=True).persist()


def test_sampling_is_repeatable_and_from_the_grid():
    for grid in search.GRIDS.values():
        draws = search.sample_params(grid, 10, seed=1)
        assert draws == search.sample_params(grid, 10, seed=1) and len(draws) == 10
        assert all(d[k] in grid[k] for d in draws for k in grid)


def test_training_is_useful_and_repeatable(features):
    train, test = split_rows(features)
    names = feature_columns(features)
    first = models.train_and_evaluate(models.FOREST, FOREST, train, test, names)
    again = models.train_and_evaluate(models.FOREST, FOREST, train, test, names)
    assert first.metrics == again.metrics
    spread = test.agg(F.stddev_pop("RUL")).first()[0]
    assert first.metrics["RMSE"] < spread and first.metrics["R2"] > 0.5
    rows = first.importances.collect()
    assert sum(r.importance for r in rows) == pytest.approx(1) and {r.feature for r in rows} == set(names)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


@pytest.mark.parametrize(
    "family,params",
    [
        (models.BOOSTED, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.6, "random_state": 42}),
        (models.LEAFWISE, {"n_estimators": 3, "num_leaves": 15, "learning_rate": 0.3, "random_state": 42}),
    ],
)
def test_boosted_families(features, family, params):
    train, test = split_units(features)
    run = models.train_and_evaluate(family, params, train, test, feature_columns(features))
    assert run.metrics["MAE"] < 20
    rows = run.importances.collect()
    if family == models.LEAFWISE:
        assert sum(r.importance for r in rows) == sum(
            t.numNodes // 2 for t in run.model.stages[-1].trees
        )  # one split per inner node


def test_depth_and_leaves_are_mapped():
    assert models.train_forest({"max_depth": None}).estimator.getMaxDepth() == 30
    assert models.train_boosted_leafwise({"num_leaves": 50}).leaves == 50
    assert models.train_forest({"min_samples_split": 10}).min_samples_split == 10


def test_search_store_score(spark, features, folder):
    trials = [dict(FOREST, max_depth=1), dict(FOREST, max_depth=5)]
    table = jobs.train_family(spark, features, folder, family=models.FOREST, experiment="forest", trials=trials)
    best = runs.best_trial(table).first()
    assert json.loads(best.params)["max_depth"] == 5
    logged = runs.read_runs(spark, f"{folder}/runs")
    assert logged.count() == 2 and runs.require_best_run(logged)["run_id"] == best.run_id
    model, names = models.load_model(spark, folder, best.run_id)
    assert names == feature_columns(features)
    assert spark.read.parquet(f"{folder}/models/{best.run_id}/example").count() == 5
    predictions = jobs.score_with_best_run(spark, folder, features, f"{folder}/predictions")
    assert predictions.columns == ["unit", "time_in_cycles", "RUL", "risk_level"] and predictions.count() == 1200
    assert predictions.filter(F.abs(F.col("RUL") * 100 - F.round(F.col("RUL") * 100)) > 1e-6).count() == 0
    inference = runs.read_runs(spark, f"{folder}/inference").first()
    assert inference.params["num_predictions"] == "1200" and inference.params["model_run_id"] == best.run_id
    with pytest.raises(MissingColumnsError):
        jobs.score_batch(model, names, features.drop("sensor_2"))
    meta = runs.model_metadata(logged).first()
    assert meta.model_type == "forest" and meta.RMSE > 0


def run_row(experiment, run_id, status, **metrics):
    return (experiment, run_id, status, 0, 0, {}, metrics, {})


def test_best_runs(spark):
    table = spark.createDataFrame(
        [
            run_row("a", "1", "FAILED", RMSE=1.0),
            run_row("a", "2", "FINISHED", RMSE=5.0, MAE=2.0),
            run_row("a", "3", "FINISHED", MAE=0.1),
            run_row("b", "5", "FINISHED", RMSE=4.0, R2=0.5),
            run_row("b", "4", "FINISHED", RMSE=4.0),
            run_row("c", "6", "RUNNING", RMSE=0.5),
        ],
        runs.RUN_SCHEMA,
    )
    assert {(r.experiment, r.run_id) for r in runs.best_per_experiment(table).collect()} == {("a", "2"), ("b", "4")}
    assert runs.require_best_run(table)["run_id"] == "4"
    assert runs.compare_top_models(table).count() == 8
    with pytest.raises(runs.NoFinishedRunError):
        runs.require_best_run(table.filter("status <> 'FINISHED'"))


def test_best_trial_takes_the_earliest_of_equals(spark):
    table = spark.createDataFrame([(2, "x", 1.0), (1, "y", 1.0), (0, "z", 3.0), (3, "n", None)], "trial int, params string, MAE double")
    assert same(runs.best_trial(table).collect(), [(1, "y", 1.0)])
    assert runs.best_trial(table.filter("MAE IS NULL")).count() == 0

"""Runs, search results, and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.registry import r, register, rounded
from fleetwane.learning import models, runs, search
from fleetwane.operators import health, split
from fleetwane.operators.columns import feature_columns
from fleetwane.operators.metrics import METRICS
from fleetwane.plans import jobs
from fleetwane.session import store

R = f"WITH {T.RUNS}"
METRIC_SQL = {"RMSE": "RMSE", "MAE": "MAE", "R2": "R2", "Max Error": "max_error"}


@register("read_runs", f"{R} SELECT experiment, status, count(*) AS n, {r('min(RMSE)', 'lowest')} FROM runs GROUP BY experiment, status")
def _(spark, folder):
    df = T.runs(spark, folder).withColumn("RMSE", runs.metric_value("RMSE"))
    return rounded(df.groupBy("experiment", "status").agg(F.count(F.lit(1)).alias("n"), F.min("RMSE").alias("lowest")))


@register("best_per_experiment", f"{R} SELECT experiment, run_id, {r('RMSE', 'RMSE')} FROM best_runs")
def _(spark, folder):
    best = runs.best_per_experiment(T.runs(spark, folder))
    return rounded(best.select("experiment", "run_id", runs.metric_value("RMSE").alias("RMSE")))


@register("best_run", f"{R} SELECT experiment, run_id, {r('RMSE', 'RMSE')} FROM best_runs ORDER BY best_runs.RMSE, experiment LIMIT 1")
def _(spark, folder):
    best = runs.best_run(T.runs(spark, folder))
    return rounded(best.select("experiment", "run_id", runs.metric_value("RMSE").alias("RMSE")))


@register(
    "compare_top_models",
    f"{R} "
    + " UNION ALL ".join(
        f"SELECT experiment, run_id, '{m}' AS metric, {r(c, 'value')} FROM best_runs" for m, c in METRIC_SQL.items()
    ),
)
def _(spark, folder):
    return rounded(runs.compare_top_models(T.runs(spark, folder)))


@register(
    "model_metadata",
    f"{R} SELECT experiment, run_id, model_type, end_time AS trained_at, {r('MAE', 'MAE')}, {r('RMSE', 'RMSE')}, {r('R2', 'R2')}, "
    f"{r('max_error', 'Max Error')} FROM best_runs ORDER BY best_runs.RMSE, experiment LIMIT 1",
)
def _(spark, folder):
    df = runs.model_metadata(T.runs(spark, folder))
    return rounded(df.withColumn("trained_at", F.unix_millis("trained_at")))


@register("best_trial", f"WITH {T.TRIALS} SELECT trial, params, {r('MAE', 'MAE')} FROM trials ORDER BY trials.MAE, trial LIMIT 1")
def _(spark, folder):
    return rounded(runs.best_trial(T.trials(spark, folder)))


def _features(spark, folder):
    """Computed once, for both sides of the split and for scoring."""
    features = health.sensor_health_features(
        T.telemetry(spark, folder), T.TELEMETRY_SENSORS, failure_threshold=30, with_score=True, order=T.ORDER
    )
    return store(features, "features")


def _split(features):
    train, test = split.split_rows(features, key=("unit", *T.ORDER))
    return train, test, feature_columns(features)


SMALL = {
    models.FOREST: {"n_estimators": 10, "max_depth": 5, "min_samples_leaf": 2, "max_features": "sqrt", "random_state": 42},
    models.BOOSTED: {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.2, "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42},
    models.LEAFWISE: {"n_estimators": 5, "num_leaves": 15, "learning_rate": 0.1, "random_state": 42},
}


def _train(name: str, family: str) -> None:
    @register(name)
    def _(spark, folder):
        """Metrics of one model trained on the whole table."""
        run = models.train_and_evaluate(family, SMALL[family], *_split(_features(spark, folder)))
        row = [(family, *(float(run.metrics[m]) for m in METRICS))]
        return spark.createDataFrame(row, "family string, MAE double, RMSE double, R2 double, `Max Error` double")


_train("train_forest", models.FOREST)
_train("train_boosted", models.BOOSTED)
_train("train_boosted_leafwise", models.LEAFWISE)


@register("feature_importances")
def _(spark, folder):
    return models.train_and_evaluate(models.FOREST, SMALL[models.FOREST], *_split(_features(spark, folder))).importances


@register("split_count_importances")
def _(spark, folder):
    return models.train_and_evaluate(models.LEAFWISE, SMALL[models.LEAFWISE], *_split(_features(spark, folder))).importances


@register("random_search")
def _(spark, folder):
    grid = search.GRIDS[models.FOREST] | {"n_estimators": [5, 10], "max_depth": [3, 5]}
    _, table = search.random_search(models.FOREST, *_split(_features(spark, folder)), grid=grid, n=2)
    return runs.best_trial(table)


@register("score_batch")
def _(spark, folder):
    features = _features(spark, folder)
    run = models.train_and_evaluate(models.FOREST, SMALL[models.FOREST], *_split(features))
    return jobs.score_batch(run.model, run.features, features, keep=("unit", *T.ORDER))

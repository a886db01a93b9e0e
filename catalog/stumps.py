"""Models that SQL can compute: single trees of depth 1 on the hour of the reading.

The hour has 24 values, so all splits are candidates; without bootstrap the one tree splits
where the squared error is smallest and predicts the two group means. One boosting round of
rate 1 gives the same. These queries check the whole path: training, metrics, importances,
search, storing, loading and scoring.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.registry import r, register, rounded
from fleetwane.learning import models, runs, search
from fleetwane.operators.labels import label_failures
from fleetwane.operators.metrics import METRICS
from fleetwane.plans import jobs
from fleetwane.session import scratch_dir, store
from fleetwane.sources import readers, writers

FEATURES = ["op_setting_1", "sensor_1"]  # the second is constant
FOREST = {"n_estimators": 1, "max_depth": 1, "bootstrap": False, "max_features": None, "random_state": 42}
BOOSTED = {"n_estimators": 1, "max_depth": 1, "learning_rate": 1.0, "random_state": 42}
LEAFWISE = {"n_estimators": 1, "num_leaves": 2, "learning_rate": 1.0, "random_state": 42}

STUMP = (
    T.LABELED
    + """, hours AS (SELECT op_setting_1 AS h, count(*) AS n, CAST(sum(RUL) AS DOUBLE) AS s FROM labeled GROUP BY 1),
  cuts AS (SELECT a.h, sum(b.n) FILTER (b.h <= a.h) AS nl, sum(b.s) FILTER (b.h <= a.h) AS sl,
                  sum(b.n) FILTER (b.h > a.h) AS nr, sum(b.s) FILTER (b.h > a.h) AS sr FROM hours a, hours b GROUP BY a.h),
  best AS (SELECT *, sl / nl AS lo, sr / nr AS hi FROM cuts WHERE nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1),
  scored AS (SELECT labeled.*, CASE WHEN op_setting_1 <= best.h THEN lo ELSE hi END AS prediction FROM labeled, best),
  measured AS (SELECT avg(abs(RUL - prediction)) AS MAE, sqrt(avg((RUL - prediction) ** 2)) AS RMSE,
    1 - sum((RUL - prediction) ** 2) / (var_pop(RUL) * count(*)) AS R2, max(abs(RUL - prediction)) AS max_error FROM scored)"""
)
BY_HOUR = f"WITH {STUMP} SELECT DISTINCT op_setting_1, {r('prediction', 'prediction')} FROM scored"
METRICS_SQL = f"{r('MAE', 'MAE')}, {r('RMSE', 'RMSE')}, {r('R2', 'R2')}, {r('max_error', 'Max Error')}"
IMPORTANCES = "SELECT 'op_setting_1' AS feature, CAST(1 AS DOUBLE) AS importance UNION ALL SELECT 'sensor_1', 0 WHERE EXISTS (SELECT 1 FROM events)"


def _labelled(spark, folder):
    return store(label_failures(T.telemetry(spark, folder)).select(*T.ORDER, "unit", "RUL", *FEATURES), "labelled")


def _fit(spark, folder, family: str, params: dict):
    table = _labelled(spark, folder)
    return models.train_and_evaluate(family, params, table, table, FEATURES), table


def _by_hour(model, features, table):
    scored = model.transform(models.prepare_model_input(table, features))
    return rounded(scored.select("op_setting_1", "prediction").distinct())


def _stored(spark, folder) -> tuple[str, str]:
    run, _ = _fit(spark, folder, models.FOREST, FOREST)
    base = f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}"
    return base, models.save_run(spark, run, base, experiment="stumps")


for _name, _family, _params in (
    ("train_forest_stump", models.FOREST, FOREST),
    ("train_boosted_stump", models.BOOSTED, BOOSTED),
    ("train_boosted_leafwise_stump", models.LEAFWISE, LEAFWISE),
):

    @register(_name, BY_HOUR)
    def _(spark, folder, family=_family, params=_params):
        run, table = _fit(spark, folder, family, params)
        return _by_hour(run.model, run.features, table)


@register("train_and_evaluate_stump", f"WITH {STUMP} SELECT {METRICS_SQL} FROM measured")
def _(spark, folder):
    run, _table = _fit(spark, folder, models.FOREST, FOREST)
    row = [tuple(float(run.metrics[m]) for m in METRICS)]
    return rounded(spark.createDataFrame(row, "MAE double, RMSE double, R2 double, `Max Error` double"))


@register("feature_importances_stump", IMPORTANCES)
def _(spark, folder):
    return _fit(spark, folder, models.FOREST, FOREST)[0].importances


@register("split_count_importances_stump", IMPORTANCES)
def _(spark, folder):
    return _fit(spark, folder, models.LEAFWISE, LEAFWISE)[0].importances


@register("random_search_stumps", f"WITH {STUMP} SELECT CAST(t AS INTEGER) AS trial, {METRICS_SQL} FROM measured, range(3) x(t)")
def _(spark, folder):
    """Three draws from a grid in which all trees are the same."""
    table = _labelled(spark, folder)
    grid = {name: [value] for name, value in FOREST.items()} | {"min_samples_leaf": [1, 2, 3]}
    _, trials = search.random_search(models.FOREST, table, table, FEATURES, grid=grid, n=3, seed=7)
    return rounded(trials.select("trial", *METRICS))


@register(
    "score_batch_stump",
    f"WITH {STUMP}, rated AS (SELECT *, round(prediction, 2) AS predicted_rul FROM scored) "
    f"SELECT unit, time_in_cycles, reading_id, {r('predicted_rul', 'RUL')}, "
    "CASE WHEN predicted_rul < 30 THEN 'High' WHEN predicted_rul < 100 THEN 'Medium' ELSE 'Low' END AS risk_level FROM rated",
)
def _(spark, folder):
    run, table = _fit(spark, folder, models.FOREST, FOREST)
    return rounded(jobs.score_batch(run.model, run.features, table, keep=("unit", *T.ORDER)))


@register("load_model", BY_HOUR)
def _(spark, folder):
    """The stored model, loaded again, after its signature was checked."""
    base, run_id = _stored(spark, folder)
    model, features = models.load_model(spark, base, run_id)
    table = models.check_signature(_labelled(spark, folder), models.load_signature(spark, base, run_id))
    return _by_hour(model, features, table)


@register("write_importances", IMPORTANCES)
def _(spark, folder):
    base, run_id = _stored(spark, folder)
    return readers.read_csv_table(spark, f"{base}/models/{run_id}/importances").select("feature", "importance")


@register("write_feature_columns", "SELECT CAST(i AS INTEGER) AS place, ['op_setting_1', 'sensor_1'][i + 1] AS feature FROM range(2) x(i) WHERE EXISTS (SELECT 1 FROM events)")
def _(spark, folder):
    base, run_id = _stored(spark, folder)
    names = writers.read_feature_columns(spark, f"{base}/models/{run_id}/features")
    return spark.createDataFrame(list(enumerate(names)), "place int, feature string")


@register("append_run", f"WITH {STUMP} SELECT 'stumps' AS experiment, 'FINISHED' AS status, {METRICS_SQL} FROM measured")
def _(spark, folder):
    base, _run_id = _stored(spark, folder)
    table = runs.read_runs(spark, f"{base}/runs")
    return rounded(table.select("experiment", "status", *(F.col("metrics")[m].alias(m) for m in METRICS)))


@register("read_or_skip", f"WITH {T.LABELED} SELECT unit, max(RUL) AS longest FROM labeled GROUP BY unit")
def _(spark, folder):
    """A missing table and one without the needed column are skipped, the third is read."""
    path = f"{scratch_dir(spark)}/maybe-{uuid.uuid4().hex}"
    writers.write_table(_labelled(spark, folder), path)
    tried = [readers.read_or_skip(spark, p, ("unit", "RUL")) for p in (path + "-missing", f"{folder}/events.parquet", path)]
    (found,) = [t for t in tried if t is not None]
    return found.groupBy("unit").agg(F.max("RUL").alias("longest"))


@register("cached_load", f"WITH {T.TELEMETRY} SELECT unit, count(*) AS n, {r('max(sensor_2)', 'highest')} FROM telemetry GROUP BY unit")
def _(spark, folder):
    table = readers.cached(T.telemetry(spark, folder).select("unit", "sensor_2"))
    return rounded(table.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.max("sensor_2").alias("highest")))

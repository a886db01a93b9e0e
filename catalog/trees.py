"""Whole trees that SQL grows as well: minimum rows to split, columns per boosted tree, leaf-wise growth.

The features have at most 30 values each, so every cut between two values is a candidate. SQL
works on cells (one per combination of values, with the number of rows and the sum of labels)
and grows the same greedy trees level by level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.registry import r, register, rounded
from fleetwane.learning import models, nodes
from fleetwane.operators.labels import label_failures
from fleetwane.operators.metrics import METRICS
from fleetwane.plans import jobs
from fleetwane.session import store

FEATURES = ["op_setting_1", "op_setting_2", "op_setting_3"]  # hour, reading in steps of 5, day
FOREST = {"n_estimators": 1, "max_depth": 4, "min_samples_split": 400, "min_samples_leaf": 2, "bootstrap": False, "max_features": None, "random_state": 42}
BOOSTED = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "colsample_bytree": 0.67, "random_state": 7}
STUMPS = {"n_estimators": 3, "max_depth": 1, "learning_rate": 0.3, "random_state": 42}
LEAFWISE = {"n_estimators": 2, "num_leaves": 5, "learning_rate": 0.8, "min_child_samples": 20, "random_state": 42}

ROWS = f"""{T.LABELED}, leveled AS (
  SELECT unit, time_in_cycles, reading_id, CAST(RUL AS DOUBLE) AS y, op_setting_1, floor(sensor_3 / 5) AS op_setting_2,
    CAST(time_in_cycles // 24 AS DOUBLE) AS op_setting_3 FROM labeled
)"""
CELLS = f"{ROWS}, cells AS (SELECT {', '.join(FEATURES)}, count(*)::DOUBLE AS n, sum(y) AS s FROM leveled GROUP BY ALL)"
VALUE = "CASE feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in FEATURES) + " END"


def _best(name: str, source: str, features: Sequence[str], least: int, split: int) -> str:
    """CTE of the best split (node, feature, v, gain) of every node of a table of cells."""
    long = " UNION ALL ".join(
        f"SELECT node, '{f}' AS feature, {f} AS v, sum(n) AS n, sum(s) AS s FROM {source} GROUP BY node, {f}" for f in features
    )
    return f"""{name}_cuts AS (
      SELECT node, feature, v, sum(n) OVER low AS nl, sum(s) OVER low AS sl, sum(n) OVER whole AS n, sum(s) OVER whole AS s FROM ({long})
      WINDOW low AS (PARTITION BY node, feature ORDER BY v), whole AS (PARTITION BY node, feature)
    ), {name} AS (
      SELECT node, feature, v, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM {name}_cuts
      WHERE nl >= {least} AND n - nl >= {least} AND n >= {split}
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, v) = 1 AND gain > 1e-9
    )"""


def _step(name: str, source: str, splits: str) -> str:
    """CTE of the cells one level further down."""
    down = f"2 * {source}.node + CASE WHEN {VALUE} <= v THEN 0 ELSE 1 END"
    return (
        f"{name} AS (SELECT {source}.* EXCLUDE (node), CASE WHEN {splits}.node IS NULL THEN {source}.node ELSE {down} END AS node "
        f"FROM {source} LEFT JOIN {splits} ON {source}.node = {splits}.node)"
    )


def _tree(name: str, source: str, features: Sequence[str], depth: int, *, least: int = 1, split: int = 2, leaves: int | None = None) -> list[str]:
    """CTEs that end in ``name``: the cells of ``source`` with the tree's value (column p)."""
    ctes = [f"{name}_0 AS (SELECT *, 1 AS node FROM {source})"]
    for level in range(depth):
        ctes += [_best(f"{name}_b{level}", f"{name}_{level}", features, least, split), _step(f"{name}_{level + 1}", f"{name}_{level}", f"{name}_b{level}")]
    last = f"{name}_{depth}"
    if leaves is not None:  # the best splits first, each after its parent
        every = " UNION ".join(f"SELECT * FROM {name}_b{level}" for level in range(depth))
        ctes += [f"{name}_every AS ({every})", f"{name}_c1 AS (SELECT * FROM {name}_every WHERE node = 1)"]
        for k in range(2, leaves):
            before = f"{name}_c{k - 1}"
            ctes.append(
                f"{name}_c{k} AS (SELECT * FROM {before} UNION ALL (SELECT * FROM {name}_every WHERE node NOT IN (SELECT node FROM {before}) "
                f"AND node // 2 IN (SELECT node FROM {before}) ORDER BY gain DESC LIMIT 1))"
            )
        ctes.append(f"{name}_w0 AS (SELECT *, 1 AS node FROM {source})")
        ctes += [_step(f"{name}_w{level + 1}", f"{name}_w{level}", f"{name}_c{leaves - 1}") for level in range(depth)]
        last = f"{name}_w{depth}"
    ctes.append(f"{name} AS (SELECT * EXCLUDE (node), sum(s) OVER (PARTITION BY node) / sum(n) OVER (PARTITION BY node) AS p FROM {last})")
    return ctes


def _boosted(params: dict, *, leafwise: bool) -> str:
    """CTEs that end in ``fitted``: the cells with the model's prediction."""
    rate, ctes = params["learning_rate"], ["r0 AS (SELECT *, sum(s) OVER () / sum(n) OVER () AS prediction FROM cells)"]
    for k in range(params["n_estimators"]):
        ctes.append(f"left{k} AS (SELECT * REPLACE (cells.s - cells.n * prediction AS s) FROM r{k} AS cells)")
        if leafwise:
            leaves = params["num_leaves"]
            ctes += _tree(f"t{k}", f"left{k}", FEATURES, leaves - 1, least=params["min_child_samples"], leaves=leaves)
        else:
            chosen = models.columns_of_round(len(FEATURES), params.get("colsample_bytree", 1.0), params["random_state"], k)
            ctes += _tree(f"t{k}", f"left{k}", [FEATURES[i] for i in chosen], params["max_depth"])
        ctes.append(f"r{k + 1} AS (SELECT {', '.join(FEATURES)}, n, s + n * prediction AS s, prediction + {rate} * p AS prediction FROM t{k})")
    return ", ".join([*ctes, f"fitted AS (SELECT * FROM r{params['n_estimators']})"])


FOREST_SQL = ", ".join(
    _tree("tree", "cells", FEATURES, FOREST["max_depth"], least=FOREST["min_samples_leaf"], split=FOREST["min_samples_split"])
) + ", fitted AS (SELECT *, p AS prediction FROM tree)"
SCORED = f"scored AS (SELECT leveled.*, prediction FROM leveled JOIN fitted USING ({', '.join(FEATURES)}))"
MEASURED = """SELECT avg(abs(y - prediction)) AS MAE, sqrt(avg((y - prediction) ** 2)) AS RMSE,
  1 - sum((y - prediction) ** 2) / (var_pop(y) * count(*)) AS R2, max(abs(y - prediction)) AS max_error FROM scored"""
METRICS_SQL = f"{r('MAE', 'MAE')}, {r('RMSE', 'RMSE')}, {r('R2', 'R2')}, {r('max_error', 'Max Error')}"
BY_CELL = f"SELECT {', '.join(FEATURES)}, {r('prediction', 'prediction')} FROM fitted"


def _leveled(spark, folder):
    table = label_failures(T.telemetry(spark, folder))
    day = F.floor(F.col("time_in_cycles") / 24).cast("double")
    levels = table.withColumns({"op_setting_2": F.floor(F.col("sensor_3") / 5).cast("double"), "op_setting_3": day})
    return store(levels.select(*T.ORDER, "unit", "RUL", *FEATURES), "levels")


def _fit(spark, folder, family: str, params: dict):
    table = _leveled(spark, folder)
    return models.train_and_evaluate(family, params, table, table, FEATURES), table


FITTED = {
    "train_forest_min_split": (models.FOREST, FOREST, FOREST_SQL),
    "train_boosted_columns": (models.BOOSTED, BOOSTED, _boosted(BOOSTED, leafwise=False)),
    "train_boosted_rounds": (models.BOOSTED, STUMPS, _boosted(STUMPS, leafwise=False)),
    "train_boosted_leafwise_best_first": (models.LEAFWISE, LEAFWISE, _boosted(LEAFWISE, leafwise=True)),
}
for _name, (_family, _params, _sql) in FITTED.items():

    @register(_name, f"WITH {CELLS}, {_sql} {BY_CELL}")
    def _(spark, folder, family=_family, params=_params):
        """The prediction for every combination of values."""
        run, table = _fit(spark, folder, family, params)
        scored = run.model.transform(models.prepare_model_input(table, run.features))
        return rounded(scored.select(*FEATURES, "prediction").distinct())

    @register(_name.replace("train_", "evaluate_"), f"WITH {CELLS}, {_sql}, {SCORED}, measured AS ({MEASURED}) SELECT {METRICS_SQL} FROM measured")
    def _(spark, folder, family=_family, params=_params):
        run, _table = _fit(spark, folder, family, params)
        row = [tuple(float(run.metrics[m]) for m in METRICS)]
        return rounded(spark.createDataFrame(row, "MAE double, RMSE double, R2 double, `Max Error` double"))


@register(
    "score_batch_boosted",
    f"WITH {CELLS}, {FITTED['train_boosted_columns'][2]}, {SCORED}, rated AS (SELECT *, round(prediction, 2) AS predicted_rul FROM scored) "
    f"SELECT unit, time_in_cycles, reading_id, {r('predicted_rul', 'RUL')}, "
    "CASE WHEN predicted_rul < 30 THEN 'High' WHEN predicted_rul < 100 THEN 'Medium' ELSE 'Low' END AS risk_level FROM rated",
)
def _(spark, folder):
    run, table = _fit(spark, folder, models.BOOSTED, BOOSTED)
    return rounded(jobs.score_batch(run.model, run.features, table, keep=("unit", *T.ORDER)))


@register(
    "split_count_importances_best_first",
    f"WITH {CELLS}, {FITTED['train_boosted_leafwise_best_first'][2]}, splits AS ("
    + " UNION ALL ".join(f"SELECT feature FROM t{k}_c{LEAFWISE['num_leaves'] - 1}" for k in range(LEAFWISE["n_estimators"]))
    + ") SELECT f.feature, count(splits.feature)::DOUBLE AS importance FROM (SELECT unnest(["
    + ", ".join(f"'{f}'" for f in FEATURES)
    + "]) AS feature) f LEFT JOIN splits USING (feature) GROUP BY f.feature",
)
def _(spark, folder):
    return _fit(spark, folder, models.LEAFWISE, LEAFWISE)[0].importances


WALKED = {
    "walk_forest": (models.FOREST, {"n_estimators": 10, "max_depth": 6, "min_samples_split": 10, "max_features": "sqrt", "random_state": 42}),
    "walk_boosted": (models.BOOSTED, {"n_estimators": 4, "max_depth": 4, "learning_rate": 0.2, "subsample": 0.8, "colsample_bytree": 0.6, "random_state": 42}),
    "walk_boosted_leafwise": (models.LEAFWISE, {"n_estimators": 4, "num_leaves": 15, "learning_rate": 0.1, "random_state": 42}),
}
for _name, (_family, _params) in WALKED.items():

    @register(_name, f"WITH {T.LABELED} SELECT count(*) AS n, 0::BIGINT AS differ FROM labeled")
    def _(spark, folder, family=_family, params=_params):
        """Every reading is led through the stored trees by joins; how many get another prediction than from the model."""
        run, table = _fit(spark, folder, family, params)
        scored = store(run.model.transform(models.prepare_model_input(table, run.features, keep=("reading_id",))), "scored")
        trees = run.model.stages[-1]
        walked = nodes.walk(scored, "reading_id", "features", nodes.node_table(trees), list(trees.treeWeights), mean=family == models.FOREST)
        both = scored.join(walked.withColumnRenamed("prediction", "walked"), "reading_id")
        close = F.abs(F.col("walked") - F.col("prediction")) <= 1e-9 * (1 + F.abs("prediction"))
        return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~close).alias("differ"))

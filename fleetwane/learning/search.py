"""Random search over model parameters."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from fleetwane.learning.models import BOOSTED, FOREST, LEAFWISE, TrainedRun, fit_and_measure, model_inputs

# The parameter grids of the three model families.
GRIDS: dict[str, dict[str, list]] = {
    FOREST: {
        "n_estimators": [50, 100, 150, 200],
        "max_depth": [None, 5, 10, 15],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
        "random_state": [42],
    },
    BOOSTED: {
        "n_estimators": [50, 100, 150, 200],
        "max_depth": [3, 5, 7, 10],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "subsample": [0.6, 0.8, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
        "random_state": [42],
    },
    LEAFWISE: {
        "num_leaves": [15, 31, 50],
        "learning_rate": [0.01, 0.05, 0.1],
        "n_estimators": [50, 100, 150],
        "random_state": [42],
    },
}


def sample_params(grid: Mapping[str, Sequence], n: int = 10, *, seed: int = 42) -> list[dict]:
    """``n`` independent draws from a grid, repeatable by seed."""
    draw = random.Random(seed)
    return [{name: draw.choice(list(choices)) for name, choices in grid.items()} for _ in range(n)]


def random_search(
    family: str,
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    *,
    trials: Sequence[Mapping] | None = None,
    grid: Mapping[str, Sequence] | None = None,
    n: int = 10,
    seed: int = 42,
    parallel: int = 2,
) -> tuple[list[TrainedRun], DataFrame]:
    """Train every trial on the same prepared tables.

    Returns the runs and the trial table (trial, params, metrics); the best trial is
    ``runs.best_trial(table)``. Each fit is itself a distributed job; a few run at once
    so that the cluster stays busy between the stages of one fit.
    """
    trials = sample_params(grid or GRIDS[family], n, seed=seed) if trials is None else list(trials)
    spark = train.sparkSession
    with model_inputs(train, test, features) as inputs, ThreadPoolExecutor(parallel) as pool:
        in_session = inheritable_thread_target(spark)
        fit = in_session(lambda params: fit_and_measure(family, params, inputs))
        runs = list(pool.map(fit, trials))
    rows = [
        (i, json.dumps(r.params, sort_keys=True), r.run_id, *(r.metrics[m] for m in ("MAE", "RMSE", "R2", "Max Error")))
        for i, r in enumerate(runs)
    ]
    schema = "trial int, params string, run_id string, MAE double, RMSE double, R2 double, `Max Error` double"
    return runs, spark.createDataFrame(rows, schema)

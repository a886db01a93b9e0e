"""The table of training and inference runs, and queries over it."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fleetwane.operators.metrics import METRICS
from fleetwane.sources.readers import read_required

RUN_SCHEMA = (
    "experiment string, run_id string, status string, start_time bigint, end_time bigint, "
    "params map<string,string>, metrics map<string,double>, tags map<string,string>"
)
FINISHED = "FINISHED"


class NoFinishedRunError(RuntimeError):
    """No experiment has a finished run with the metric."""


def new_run_id() -> str:
    return uuid.uuid4().hex


def append_run(
    spark: SparkSession,
    path: str,
    *,
    experiment: str,
    params: Mapping,
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
    run_id: str | None = None,
    status: str = FINISHED,
    start_time: float | None = None,
) -> str:
    """Append one run; returns its id."""
    now = time.time()
    run_id = run_id or new_run_id()
    row = (
        experiment,
        run_id,
        status,
        int(1000 * (start_time or now)),
        int(1000 * now),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
        dict(tags or {}),
    )
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str, *, experiments: Sequence[str] | None = None) -> DataFrame:
    """The runs, optionally of some experiments only."""
    runs = read_required(spark, path, ("experiment", "run_id", "status", "metrics"))
    return runs if experiments is None else runs.filter(F.col("experiment").isin(list(experiments)))


def metric_value(metric: str) -> Column:
    return F.try_element_at("metrics", F.lit(metric))


def best_per_experiment(runs: DataFrame, metric: str = "RMSE") -> DataFrame:
    """The finished run with the lowest metric of each experiment (ties: lowest run id).

    Runs without the metric never win. Combined on the map side, so an experiment with
    very many runs is no hot group.
    """
    value = metric_value(metric)
    candidates = runs.filter((F.col("status") == FINISHED) & value.isNotNull() & ~F.isnan(value))
    row = F.min_by(F.struct(*runs.columns), F.struct(value, F.col("run_id")))
    return candidates.groupBy("experiment").agg(row.alias("row")).select("row.*")


def best_run(runs: DataFrame, metric: str = "RMSE") -> DataFrame:
    """The best of the best runs (ties: first experiment by name)."""
    return best_per_experiment(runs, metric).orderBy(metric_value(metric), "experiment").limit(1)


def require_best_run(runs: DataFrame, metric: str = "RMSE") -> Row:
    """The best run as a row; an error if no run is finished."""
    row = best_run(runs, metric).first()
    if row is None:
        raise NoFinishedRunError(f"no finished run with {metric}")
    return row


def compare_top_models(runs: DataFrame, metric: str = "RMSE", metrics: Sequence[str] = METRICS) -> DataFrame:
    """(experiment, run_id, metric, value) of each experiment's best run."""
    entries = F.array(*(F.struct(F.lit(m).alias("metric"), metric_value(m).alias("value")) for m in metrics))
    return best_per_experiment(runs, metric).select("experiment", "run_id", F.inline(entries))


def best_trial(trials: DataFrame, *, metric: str = "MAE") -> DataFrame:
    """The trial with the lowest metric; the earliest of equals. Needs ``trial`` and ``params``."""
    usable = trials.filter(F.col(metric).isNotNull())
    row = F.min_by(F.struct(*trials.columns), F.struct(F.col(metric), F.col("trial")))
    return usable.agg(row.alias("row")).filter("row IS NOT NULL").select("row.*")


def model_metadata(runs: DataFrame, metric: str = "RMSE") -> DataFrame:
    """Type, training time and metrics of the model in use."""
    kind = F.try_element_at("tags", F.lit("model_type"))
    return best_run(runs, metric).select(
        "experiment",
        "run_id",
        kind.alias("model_type"),
        F.timestamp_millis("end_time").alias("trained_at"),
        *(metric_value(m).alias(m) for m in METRICS),
    )

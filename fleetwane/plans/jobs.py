"""The jobs a fleet team runs: ingest, features, training, scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.learning import runs as R
from fleetwane.learning.models import check_signature, load_model, load_signature, prepare_model_input, save_run
from fleetwane.learning.search import random_search
from fleetwane.operators.columns import feature_columns
from fleetwane.operators.health import sensor_health_features
from fleetwane.operators.risk import inference_summary
from fleetwane.operators.split import split_rows, split_units
from fleetwane.schema import FAILURE_THRESHOLD, HEALTH_SENSORS, RISK, RUL, TIME, UNIT, MissingTableError
from fleetwane.session import store
from fleetwane.sources.readers import existing, read_whitespace_text
from fleetwane.sources.writers import write_table


def ingest(spark: SparkSession, inputs: Mapping[str, str], folder: str, *, format: str = "parquet") -> dict[str, str]:
    """Raw text files -> named tables under ``folder``; missing inputs are skipped.

    Returns name -> written path.
    """
    written = {}
    for name, path in inputs.items():
        try:
            df = existing(lambda: read_whitespace_text(spark, path), path)
        except MissingTableError:
            print(f"skipped {name}: nothing at {path}")
            continue
        written[name] = write_table(df, f"{folder}/{name}", format=format)
    return written


def build_features(
    telemetry: DataFrame,
    sensors: Sequence[str] = HEALTH_SENSORS,
    *,
    failure_threshold: int = FAILURE_THRESHOLD,
    **options,
) -> DataFrame:
    """Labels and health features of a telemetry table, in one pass."""
    return sensor_health_features(telemetry, sensors, failure_threshold=failure_threshold, **options)


def train_family(
    spark: SparkSession,
    features: DataFrame,
    folder: str,
    *,
    family: str,
    experiment: str,
    by_unit: bool = False,
    key: Sequence[str] = (UNIT, TIME),
    trials: Sequence[Mapping] | None = None,
    n: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Split, search, store all runs; returns the trial table. The features are computed once, for both sides."""
    features = store(features, "features")
    train, test = split_units(features) if by_unit else split_rows(features, key=key)
    trained, table = random_search(
        family, train, test, feature_columns(features), trials=trials, n=n, seed=seed
    )
    for run in trained:
        save_run(spark, run, folder, experiment=experiment)
    return table


def score_batch(model: PipelineModel, features: Sequence[str], df: DataFrame, *, keep: Sequence[str] = (UNIT, TIME)) -> DataFrame:
    """Predictions per row: keys, RUL rounded to 2 decimals, risk level."""
    scored = model.transform(prepare_model_input(df, features, keep=keep))
    rul = H.round_half_even(F.col("prediction"), 2)
    return scored.select(*keep, rul.alias(RUL)).withColumn(RISK, H.classify_risk(F.col(RUL)))


def score_with_best_run(
    spark: SparkSession,
    folder: str,
    df: DataFrame,
    output: str,
    *,
    metric: str = "RMSE",
    experiments: Sequence[str] | None = None,
    inference_experiment: str = "inference",
) -> DataFrame:
    """Score with the best stored model, write the predictions, log the inference run."""
    best = R.require_best_run(R.read_runs(spark, f"{folder}/runs", experiments=experiments), metric)
    model, features = load_model(spark, folder, best["run_id"])
    check_signature(df, load_signature(spark, folder, best["run_id"]))
    write_table(score_batch(model, features, df), output)
    predictions = spark.read.parquet(output)
    summary = inference_summary(predictions).first()
    R.append_run(
        spark,
        f"{folder}/inference",
        experiment=inference_experiment,
        params={"model_run_id": best["run_id"], "num_predictions": summary["num_predictions"]},
        metrics={"mean_RUL": summary["mean_RUL"], "high_risk_count": summary["high_risk_count"]},
    )
    return predictions

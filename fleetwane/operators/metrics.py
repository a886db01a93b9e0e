"""Regression metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.schema import RUL

METRICS = ("MAE", "RMSE", "R2", "Max Error")


def _metric_columns(truth: Column, predicted: Column) -> dict[str, Column]:
    error = truth - predicted
    squared = F.sum(error * error)
    # Sum of squares about the mean, by the numerically stable built-in variance.
    total = F.var_pop(F.when(predicted.isNotNull(), truth)) * F.count(error)
    return {
        "MAE": F.avg(F.abs(error)),
        "RMSE": F.sqrt(F.avg(error * error)),
        "R2": 1 - F.try_divide(squared, total),
        "Max Error": F.max(F.abs(error)),
    }


def regression_metrics(df: DataFrame, *, truth: str = RUL, predicted: str = "prediction") -> DataFrame:
    """One row: MAE, RMSE, R2, Max Error. R2 is NULL where the truth does not vary."""
    columns = _metric_columns(F.col(truth).cast("double"), F.col(predicted).cast("double"))
    return df.agg(*(metric.alias(name) for name, metric in columns.items()))

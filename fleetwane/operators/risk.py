"""Risk tables, truth comparison and rankings over predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.operators.columns import filter_unit
from fleetwane.operators.panel import ascending, join_per_unit
from fleetwane.schema import RISK, RISK_LEVELS, RUL, TIME, UNIT


def risk_distribution(df: DataFrame) -> DataFrame:
    """(risk_level, n) for every level in fixed order, absent levels with 0."""
    counts = df.agg(*(F.count_if(F.col(RISK) == level).alias(level) for level in RISK_LEVELS))
    return counts.unpivot([], list(RISK_LEVELS), RISK, "n")


def top_high_risk(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` predictions with the lowest RUL."""
    return df.orderBy(*_urgency(df)).limit(n)


def _urgency(df: DataFrame) -> list[str]:
    """Lowest RUL first. The cycle also keeps equal predictions of one unit sortable in parallel."""
    return [c for c in (RUL, UNIT, TIME) if c in df.columns]


def prediction_table(df: DataFrame) -> DataFrame:
    """unit, RUL and alert text, lowest RUL first."""
    return df.orderBy(*_urgency(df)).select(UNIT, RUL, H.alert_label(F.col(RISK)).alias("Alert"))


def edge_per_unit(df: DataFrame, *, last: bool = True, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """One row per unit: its last (or first) cycle. Combined on the map side."""
    row = F.struct(*df.columns)
    position = F.struct(TIME, *tiebreak)
    pick = F.max_by(row, position) if last else F.min_by(row, position)
    return df.filter(F.col(UNIT).isNotNull()).groupBy(UNIT).agg(pick.alias("row")).select("row.*")


def compare_with_truth(
    predictions: DataFrame, truth: DataFrame, *, grain: str = "last", tiebreak: tuple[str, ...] = ()
) -> DataFrame:
    """Predictions beside the true RUL with absolute and signed error.

    ``grain`` 'first' or 'last' compares one prediction per unit, 'all' every prediction.
    Each unit has one truth: where ``truth`` lists a unit at several points of its life
    (RUL falls by the cycle), the earliest, or with 'last' the latest, so that rows are
    never multiplied. Units without a partner are left out.
    """
    if grain != "all":
        predictions = edge_per_unit(predictions, last=grain == "last", tiebreak=tiebreak)
    left = predictions.withColumnRenamed(RUL, "RUL_pred")
    point = F.min(RUL) if grain == "last" else F.max(RUL)
    right = truth.filter(F.col(UNIT).isNotNull()).groupBy(UNIT).agg(point.alias("RUL_true"))
    pred, true = F.col("RUL_pred"), F.col("RUL_true")
    return join_per_unit(left, right, how="inner").select(
        *left.columns, "RUL_true", H.absolute_error(true, pred).alias("error"), H.signed_error(true, pred).alias("delta")
    )


def first_match(df: DataFrame, unit, *, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The first row of a unit."""
    return filter_unit(df, unit).orderBy(*ascending((TIME, *tiebreak))).limit(1)


def inference_summary(df: DataFrame) -> DataFrame:
    """Number of predictions, mean RUL, number of High."""
    return df.agg(
        F.count(F.lit(1)).alias("num_predictions"),
        F.avg(RUL).alias("mean_RUL"),
        F.count_if(F.col(RISK) == "High").alias("high_risk_count"),
    )

"""The tables behind the service and the dashboard, as batch queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.operators.columns import filter_unit, filter_units, to_records, trend_series
from fleetwane.operators.health import rolling_features, sensor_health_features
from fleetwane.operators.labels import ensure_risk_level
from fleetwane.operators.risk import compare_with_truth, first_match, prediction_table, risk_distribution, top_high_risk
from fleetwane.schema import FAILURE_THRESHOLD, RISK, RUL, TIME, UNIT, UnknownUnitError, require_columns

# The fields of a served prediction.
PREDICTION_FIELDS = {UNIT: "bigint", RUL: "double", RISK: "string"}


def all_predictions(predictions: DataFrame) -> DataFrame:
    """Every prediction with a risk level, as typed records."""
    require_columns(predictions, (UNIT, RUL))
    return to_records(ensure_risk_level(predictions), PREDICTION_FIELDS)


def unit_prediction(predictions: DataFrame, unit, *, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The first prediction of a unit (no row if there is none)."""
    require_columns(predictions, (UNIT, RUL))
    first = first_match(ensure_risk_level(predictions), unit, tiebreak=tiebreak)
    return first.select(*(F.col(c).cast(t).alias(c) for c, t in PREDICTION_FIELDS.items()))


def require_unit_prediction(predictions: DataFrame, unit, *, tiebreak: tuple[str, ...] = ()) -> Row:
    """The first prediction of a unit; an error if there is none."""
    row = unit_prediction(predictions, unit, tiebreak=tiebreak).first()
    if row is None:
        raise UnknownUnitError(f"no prediction for unit {unit}")
    return row


def summary_view(predictions: DataFrame, n: int = 5) -> dict[str, DataFrame]:
    """The most urgent predictions with colour and text, and the risk distribution."""
    levels = ensure_risk_level(predictions)
    urgent = top_high_risk(levels, n).select(
        UNIT,
        RUL,
        RISK,
        H.risk_colour(F.col(RISK)).alias("colour"),
        H.format_metric(F.col(RUL), 1).alias("remaining"),
    )
    return {"top_high_risk": urgent, "risk_distribution": risk_distribution(levels)}


def overview_view(
    features: DataFrame, column: str, *, unit=None, units: Sequence | None = None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The trend of a derived column with its display title."""
    title = H.sensor_title(F.lit(column))
    return trend_series(features, column, unit=unit, units=units, tiebreak=tiebreak).withColumn("title", title)


def overview_title(column: str, units: Sequence) -> str:
    """The heading of a comparison of units."""
    return f"Trend of {column} for Units {', '.join(map(str, units))}"


def unit_analysis_view(
    df: DataFrame,
    sensors: Sequence[str],
    *,
    units: Sequence | DataFrame | None = None,
    window: int = 5,
    threshold: int = FAILURE_THRESHOLD,
    order: Sequence[str] = (TIME,),
    hot_rows: int | None = None,
) -> DataFrame:
    """Raw and rolling-mean series per unit with the unit's failure interval.

    The unit filter is on the partition key, so it is applied before the windows.
    """
    slim = df.select(UNIT, *order, *sensors)
    chosen = slim if units is None else filter_units(slim, units)
    rolled = rolling_features(
        chosen,
        sensors,
        window=window,
        features=("_rolling_mean",),
        per_unit={"failure_end": F.max(TIME)},
        order=order,
        hot_rows=hot_rows,
    )
    return rolled.withColumn("failure_start", F.col("failure_end") - threshold)


def rul_view(
    predictions: DataFrame,
    truth: DataFrame | None = None,
    *,
    grain: str = "first",
    high: float = 30,
    tiebreak: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """The prediction table by urgency, and the comparison with the truth with texts."""
    levels = ensure_risk_level(predictions)
    tables = {"predictions": prediction_table(levels)}
    if truth is not None:
        compared = compare_with_truth(levels, truth, grain=grain, tiebreak=tiebreak)
        tables["comparison"] = compared.select(
            *compared.columns,
            F.concat(F.col("RUL_true").cast("string"), F.lit(" cycles")).alias("true_text"),
            H.format_metric(F.col("RUL_pred"), 2).alias("predicted_text"),
            H.format_metric(F.col("error"), 2).alias("error_text"),
            H.format_metric(F.col("delta"), 2, "").alias("delta_text"),
            H.low_rul_warning(F.col("RUL_pred"), high).alias("is_urgent"),
        )
    return tables


def unit_health_indicators(telemetry: DataFrame, unit, sensors: Sequence[str], **options) -> DataFrame:
    """The health features of one unit; only its rows are read."""
    return sensor_health_features(filter_unit(telemetry, unit), sensors, **options)

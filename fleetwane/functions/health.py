"""Column expressions for labels, flags, risk and errors.

All of them stay inside Spark's generated code, and missing inputs give the result
stated in each docstring rather than an unexpected NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetwane.schema import FAILURE_THRESHOLD, HIGH_RISK_THRESHOLD, MEDIUM_RISK_THRESHOLD

# What the alert column shows for each risk level, and the colours.
ALERTS = {"High": "🔴 High", "Medium": "🟠 Medium", "Low": "🟢 Low"}
RISK_COLOURS = {"High": "#d9534f", "Medium": "#f0ad4e", "Low": "#5cb85c"}


def null_if_nan(value: Column) -> Column:
    """NaN becomes NULL, so that aggregates skip it."""
    return F.when(~F.isnan(value), value)


def coerce_integer(value: Column) -> Column:
    """Parse as a whole number; anything else (text, fractions) becomes NULL."""
    number = value.try_cast("double")
    return F.when(number == F.floor(number), F.coalesce(value.try_cast("bigint"), number.try_cast("bigint")))


def failure_flag(rul: Column, threshold: int = FAILURE_THRESHOLD) -> Column:
    """1 within ``threshold`` cycles of the end of life (inclusive), else 0; missing is 0."""
    return F.coalesce(rul <= threshold, F.lit(False)).cast("int")


def failure_zone(time: Column, max_cycle: Column, threshold: int = FAILURE_THRESHOLD) -> Column:
    """True from ``threshold`` cycles before the last cycle on."""
    return F.coalesce(time >= max_cycle - threshold, F.lit(False))


def classify_risk(rul: Column, high: float = HIGH_RISK_THRESHOLD, medium: float = MEDIUM_RISK_THRESHOLD) -> Column:
    """High below ``high``, Medium below ``medium``, else (also when missing) Low."""
    return (
        F.when(~F.isnan(rul) & (rul < high), "High")
        .when(~F.isnan(rul) & (rul < medium), "Medium")
        .otherwise("Low")
    )


def degraded_flag(value: Column, baseline: Column, threshold: float = 0.75) -> Column:
    """1 where the value is strictly below ``threshold`` x baseline; missing is 0."""
    return F.coalesce(value < baseline * threshold, F.lit(False)).cast("int")


def outlier_flag(z: Column, threshold: float = 3.0) -> Column:
    """True where the absolute z-score is strictly above ``threshold``; missing is False."""
    return F.coalesce(F.abs(z) > threshold, F.lit(False))


def near_end_threshold(max_cycle: Column, fraction: float = 0.2) -> Column:
    """How many remaining cycles still count as the end of life."""
    return max_cycle * F.lit(fraction)


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round to ``digits`` decimals, halves to the even neighbour."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def absolute_error(truth: Column, predicted: Column) -> Column:
    return F.abs(truth - predicted)


def signed_error(truth: Column, predicted: Column) -> Column:
    """Positive where the prediction is too long."""
    return predicted - truth


def low_rul_warning(predicted: Column, high: float = HIGH_RISK_THRESHOLD) -> Column:
    return F.coalesce(predicted < high, F.lit(False))


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def alert_label(risk: Column, mapping: dict[str, str] | None = None) -> Column:
    """The alert text of a risk level; NULL for an unknown level."""
    return _lookup(risk, mapping or ALERTS)


def risk_colour(risk: Column, mapping: dict[str, str] | None = None) -> Column:
    """The colour of a risk level; black for an unknown level."""
    return F.coalesce(_lookup(risk, mapping or RISK_COLOURS), F.lit("black"))


def format_metric(value: Column, digits: int = 2, suffix: str = "cycles") -> Column:
    """Text with a fixed number of decimals and a unit.

    ``format_number`` rounds the exact binary value, halves to even, which is what
    most languages print; ``format_string`` would round the decimal text half up.
    """
    text = F.call_function("format_number", value, F.lit("0." + "0" * digits))
    return F.concat(text, F.lit(f" {suffix}")) if suffix else text


def sensor_kind(name: Column) -> Column:
    """Classify a feature name by its suffix; anything else is a raw reading."""
    kinds = ("baseline", "degraded", "rolling_mean", "rolling_std", "cycle_change")
    return F.coalesce(*(F.when(name.endswith(kind), kind) for kind in kinds), F.lit("raw"))


def sensor_title(name: Column) -> Column:
    """The display name of a feature: ``name (kind)``."""
    return F.concat(name, F.lit(" ("), sensor_kind(name), F.lit(")"))

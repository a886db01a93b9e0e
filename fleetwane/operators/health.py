"""Health features: baselines, degradation flags, rolling statistics, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.operators.panel import first_n_per_unit, join_per_unit, over_units
from fleetwane.schema import FAILURE, RUL, TIME, UNIT, require_columns

BASELINE, DEGRADED = "_baseline", "_degraded"
ROLLING_MEAN, ROLLING_STD, CYCLE_CHANGE = "_rolling_mean", "_rolling_std", "_cycle_change"
ROLLING_SUFFIXES = (ROLLING_MEAN, ROLLING_STD, CYCLE_CHANGE)


def sensor_baselines(
    df: DataFrame, sensors: Sequence[str], *, window: int = 5, order: Sequence[str] = (TIME,)
) -> DataFrame:
    """One row per unit: the mean of each sensor over the unit's first ``window`` rows."""
    start = first_n_per_unit(df.select(UNIT, *order, *sensors), window, order=order)
    return start.groupBy(UNIT).agg(*(F.avg(s).alias(s) for s in sensors))


def merge_baselines(df: DataFrame, baselines: DataFrame) -> DataFrame:
    """Join per-unit baselines to the rows, with the suffix ``_baseline``."""
    named = {c: f"{c}{BASELINE}" for c in baselines.columns if c != UNIT}
    return join_per_unit(df, baselines.withColumnsRenamed(named), how="inner").select(*df.columns, *named.values())


def degraded_flags(df: DataFrame, sensors: Sequence[str], *, threshold: float = 0.75) -> DataFrame:
    """Add a 0/1 flag per sensor: below ``threshold`` x its baseline column."""
    return df.select(
        "*",
        *(
            H.degraded_flag(F.col(s), F.col(f"{s}{BASELINE}"), threshold).alias(f"{s}{DEGRADED}")
            for s in sensors
        ),
    )


def health_score(df: DataFrame, *, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Add the sum of the degradation flags; with ``weights``, a weighted sum (default weight 1)."""
    flags = [c for c in df.columns if c.endswith(DEGRADED)]
    return df.withColumn("health_score", _score(flags, weights))


def _score(flags: Sequence[str], weights: Mapping[str, float] | None) -> Column:
    if weights is None:
        return sum((F.col(f) for f in flags), F.lit(0)).cast("int")
    terms = (F.col(f) * float(weights.get(f.removesuffix(DEGRADED), 1.0)) for f in flags)
    return sum(terms, F.lit(0.0))


def _rolling(sensor: str, window: int) -> dict:
    """The three rolling features of a sensor, as functions of the unit's ordered window."""
    back = -(window - 1)
    return {
        f"{sensor}{ROLLING_MEAN}": lambda w: F.avg(sensor).over(w.rowsBetween(back, 0)),
        f"{sensor}{ROLLING_STD}": lambda w: F.stddev_samp(sensor).over(w.rowsBetween(back, 0)),
        f"{sensor}{CYCLE_CHANGE}": lambda w: F.col(sensor) - F.lag(sensor, 1).over(w),
    }


def rolling_features(
    df: DataFrame,
    sensors: Sequence[str],
    *,
    window: int = 5,
    features: Sequence[str] = ROLLING_SUFFIXES,
    per_unit: Mapping[str, Column] | None = None,
    order: Sequence[str] = (TIME,),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add rolling mean, rolling sample deviation and change from the previous row.

    The frame is the last ``window`` rows of the unit including the current one; missing
    readings are skipped. ``per_unit`` adds aggregates of the unit from the same pass.
    """
    columns = {
        name: build
        for s in sensors
        for name, build in _rolling(s, window).items()
        if name.removeprefix(s) in features
    }
    lookback = max(window - 1, 1)
    return over_units(df, columns, lookback=lookback, per_unit=per_unit, order=order, hot_rows=hot_rows)


def rolling_band(
    df: DataFrame,
    sensor: str,
    *,
    window: int = 10,
    order: Sequence[str] = (TIME,),
    hot_rows: int | None = None,
) -> DataFrame:
    """The raw series of a sensor with rolling mean and mean -/+ one rolling deviation."""
    rolled = rolling_features(
        df, [sensor], window=window, features=(ROLLING_MEAN, ROLLING_STD), order=order, hot_rows=hot_rows
    )
    mean, std = F.col(f"{sensor}{ROLLING_MEAN}"), F.col(f"{sensor}{ROLLING_STD}")
    return rolled.select(*rolled.columns, (mean - std).alias("band_low"), (mean + std).alias("band_high"))


def sensor_health_features(
    df: DataFrame,
    sensors: Sequence[str],
    *,
    baseline_window: int = 5,
    rolling_window: int = 5,
    threshold: float = 0.75,
    failure_threshold: int | None = None,
    with_score: bool = False,
    order: Sequence[str] = (TIME,),
    hot_rows: int | None = None,
) -> DataFrame:
    """All health features in one pass: baseline, flag and rolling features per sensor.

    Everything that is per unit shares one shuffle and one sort. With
    ``failure_threshold`` the RUL label and the near-failure flag are added from the
    same pass; with ``with_score`` the sum of the flags. Rows without a unit are dropped.
    """
    require_columns(df, (UNIT, TIME, *sensors))
    labelled = failure_threshold is not None
    ordered: dict = {}
    for s in sensors:
        ordered |= _rolling(s, rolling_window)
    panel = over_units(
        df,
        ordered,
        lookback=max(rolling_window - 1, 1),
        per_unit={"__last": F.max(TIME)} if labelled else None,
        head={f"{s}{BASELINE}": (F.avg, s) for s in sensors},
        head_rows=baseline_window,
        order=order,
        hot_rows=hot_rows,
    )
    rul = F.col("__last") - F.col(TIME)
    labels = [rul.alias(RUL), H.failure_flag(rul, failure_threshold).alias(FAILURE)] if labelled else []
    flags = {
        f"{s}{DEGRADED}": H.degraded_flag(F.col(s), F.col(f"{s}{BASELINE}"), threshold) for s in sensors
    }
    score = [sum(flags.values(), F.lit(0)).cast("int").alias("health_score")] if with_score else []
    return panel.select(
        *df.columns,
        *labels,
        *(f"{s}{BASELINE}" for s in sensors),
        *(flag.alias(name) for name, flag in flags.items()),
        *ordered,
        *score,
    )

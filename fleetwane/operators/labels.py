"""Remaining-useful-life labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.operators.panel import with_unit_aggregates
from fleetwane.schema import FAILURE, FAILURE_THRESHOLD, RISK, RUL, TIME, UNIT, require_columns


def unit_max_cycle(df: DataFrame, *, name: str = "max_cycle") -> DataFrame:
    """Add the last cycle of the unit to every row."""
    return with_unit_aggregates(df, {name: F.max(TIME)})


def label_rul(df: DataFrame, *, name: str = RUL) -> DataFrame:
    """Add the cycles remaining until the unit's last recorded cycle."""
    require_columns(df, (UNIT, TIME))
    labelled = unit_max_cycle(df, name="__last")
    return labelled.select(*df.columns, (F.col("__last") - F.col(TIME)).alias(name))


def label_failure(df: DataFrame, *, threshold: int = FAILURE_THRESHOLD) -> DataFrame:
    """Add the near-failure flag to a table with RUL."""
    require_columns(df, (RUL,))
    return df.withColumn(FAILURE, H.failure_flag(F.col(RUL), threshold))


def label_failures(df: DataFrame, *, threshold: int = FAILURE_THRESHOLD) -> DataFrame:
    """RUL and the near-failure flag."""
    return label_failure(label_rul(df), threshold=threshold)


def mark_failure_zone(df: DataFrame, *, threshold: int = FAILURE_THRESHOLD) -> DataFrame:
    """Add ``max_cycle`` and whether the row lies in the last ``threshold`` cycles."""
    return unit_max_cycle(df).withColumn(
        "failure_zone", H.failure_zone(F.col(TIME), F.col("max_cycle"), threshold)
    )


def mark_near_end(df: DataFrame, *, fraction: float = 0.2) -> DataFrame:
    """Add ``cycles_remaining`` and ``near_end_cycles``, the limit of the unit's last stretch."""
    last = F.col("__last")
    return with_unit_aggregates(df, {"__last": F.max(TIME)}).select(
        *df.columns,
        (last - F.col(TIME)).alias("cycles_remaining"),
        H.near_end_threshold(last, fraction).alias("near_end_cycles"),
    )


def ensure_risk_level(df: DataFrame, *, high: float = 30, medium: float = 100) -> DataFrame:
    """Keep the risk level if the table has one, else derive it from RUL."""
    if RISK in df.columns:
        return df
    require_columns(df, (RUL,))
    return df.withColumn(RISK, H.classify_risk(F.col(RUL), high, medium))


def failure_window_per_unit(df: DataFrame, *, threshold: int = FAILURE_THRESHOLD, units: Sequence | None = None) -> DataFrame:
    """(start, end) of the last ``threshold`` cycles of each unit."""
    if units is not None:
        df = df.filter(F.col(UNIT).isin(list(units)))
    return (
        df.filter(F.col(UNIT).isNotNull())
        .groupBy(UNIT)
        .agg(F.max(TIME).alias("failure_end"))
        .select(UNIT, (F.col("failure_end") - threshold).alias("failure_start"), "failure_end")
    )

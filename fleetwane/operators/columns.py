"""Column selection, renaming, casting, alignment and simple row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.operators.panel import join_per_unit
from fleetwane.schema import FAILURE, RUL, TIME, UNIT, MissingColumnsError


def rename_columns(df: DataFrame, names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rename by mapping, or assign all names in order."""
    return df.withColumnsRenamed(dict(names)) if isinstance(names, Mapping) else df.toDF(*names)


def coerce_integer(df: DataFrame, columns: Iterable[str] = (UNIT, TIME)) -> DataFrame:
    """Parse columns as whole numbers; unusable values become NULL."""
    return df.withColumns({c: H.coerce_integer(F.col(c)) for c in columns})


def drop_missing(df: DataFrame, columns: Iterable[str] = (UNIT, TIME)) -> DataFrame:
    """Drop rows with a missing key."""
    return df.na.drop(subset=list(columns))


def feature_columns(df: DataFrame) -> list[str]:
    """Names of the model inputs, in table order."""
    return [c for c in df.columns if ("sensor" in c or "health_score" in c) and c != FAILURE]


def derived_columns(df: DataFrame) -> list[str]:
    """Names of flags and rolling features."""
    return [c for c in df.columns if any(p in c for p in ("degraded", "rolling_mean", "rolling_std"))]


def base_sensor_columns(df: DataFrame) -> list[str]:
    """Sensor names without rolling statistics and slopes, sorted by name."""
    derived = ("_rolling_mean", "_rolling_std", "_slope")
    return sorted(c for c in df.columns if c.startswith("sensor_") and not any(d in c for d in derived))


def measurement_columns(df: DataFrame, *, settings: bool = True) -> list[str]:
    """Sensor columns and, by default, operating settings."""
    prefixes = ("sensor_", "op_setting_") if settings else ("sensor_",)
    return [c for c in df.columns if c.startswith(prefixes)]


def select_features(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *feature_columns(df))


def select_derived_columns(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *derived_columns(df))


def select_base_sensors(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *base_sensor_columns(df))


def select_measurements(df: DataFrame, *keep: str, settings: bool = True) -> DataFrame:
    return df.select(*keep, *measurement_columns(df, settings=settings))


def cast_features(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Cast the model inputs to double."""
    wanted = set(feature_columns(df) if columns is None else columns)
    return df.select(*(F.col(c).cast("double").alias(c) if c in wanted else F.col(c) for c in df.columns))


def align_columns(df: DataFrame, features: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training features in training order; missing ones are an error."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"the table to score lacks the training features {missing}")
    return df.select(*keep, *features)


def fill_missing_features(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Zero where rolling deviation or change is undefined (first row of a unit)."""
    names = feature_columns(df) if features is None else features
    undefined = [c for c in names if c.endswith(("_rolling_std", "_cycle_change"))]
    return df.na.fill(0.0, subset=undefined) if undefined else df


def filter_unit(df: DataFrame, unit) -> DataFrame:
    return df.filter(F.col(UNIT) == F.lit(unit))


def filter_units(df: DataFrame, units: Iterable | DataFrame) -> DataFrame:
    """Rows of the chosen units: a list of them, or a table with a unit column."""
    if isinstance(units, DataFrame):
        return join_per_unit(df, units.select(UNIT).distinct(), how="left_semi")
    return df.filter(F.col(UNIT).isin(list(units)))


def distinct_units(df: DataFrame, n: int | None = None) -> DataFrame:
    """Sorted distinct units, optionally only the first ``n`` (the default choice of a view)."""
    units = df.select(UNIT).filter(F.col(UNIT).isNotNull()).distinct().orderBy(UNIT)
    return units if n is None else units.limit(n)


def unit_list(df: DataFrame, n: int) -> DataFrame:
    """One text with the first ``n`` units, as a comparison heading names them."""
    chosen = distinct_units(df, n)
    return chosen.agg(F.concat_ws(", ", F.array_sort(F.collect_list(UNIT)).cast("array<string>")).alias("units"))


def distinct_truth(df: DataFrame) -> DataFrame:
    """Distinct (unit, RUL)."""
    return df.select(UNIT, RUL).dropDuplicates()


def preview(df: DataFrame, n: int = 5, *, order: Sequence[str] = (UNIT, TIME)) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def melt_sensors(
    df: DataFrame,
    sensors: Sequence[str],
    *,
    ids: Sequence[str] = (UNIT, TIME),
    name: str = "Sensor",
    value: str = "Value",
) -> DataFrame:
    """Wide to long: one row per reading."""
    doubles = [F.col(s).cast("double").alias(s) for s in sensors]
    return df.select(*ids, *doubles).unpivot(list(ids), list(sensors), name, value)


def trend_series(
    df: DataFrame, sensor: str, *, unit=None, units: Sequence | None = None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The series of one column for one unit, several, or all."""
    if unit is not None:
        df = filter_unit(df, unit)
    elif units is not None:
        df = filter_units(df, units)
    return df.select(UNIT, TIME, *tiebreak, sensor).orderBy(UNIT, TIME, *tiebreak)


def to_records(df: DataFrame, fields: Mapping[str, str], *, name: str = "record") -> DataFrame:
    """One typed struct per row; ``fields`` maps column to type."""
    record: list[Column] = [F.col(c).cast(t).alias(c) for c, t in fields.items()]
    return df.select(F.struct(*record).alias(name))

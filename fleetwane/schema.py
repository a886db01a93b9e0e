"""Names and types of the data model, and errors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

UNIT = "unit"
TIME = "time_in_cycles"
RUL = "RUL"
FAILURE = "failure_binary"
RISK = "risk_level"

# The column layout of the raw sensor files.
SETTINGS = tuple(f"op_setting_{i}" for i in range(1, 4))
SENSORS = tuple(f"sensor_{i}" for i in range(1, 22))
TELEMETRY_COLUMNS = (UNIT, TIME, *SETTINGS, *SENSORS)

# The sensors that get health features by default.
HEALTH_SENSORS = (
    "sensor_2",
    "sensor_3",
    "sensor_4",
    "sensor_6",
    "sensor_7",
    "sensor_8",
    "sensor_9",
    "sensor_11",
    "sensor_12",
    "sensor_13",
    "sensor_14",
    "sensor_15",
    "sensor_17",
    "sensor_20",
    "sensor_21",
)

# Thresholds in cycles.
FAILURE_THRESHOLD = 30
HIGH_RISK_THRESHOLD = 30
MEDIUM_RISK_THRESHOLD = 100

RISK_LEVELS = ("High", "Medium", "Low")


class MissingColumnsError(ValueError):
    """A table lacks columns an operator needs."""


class MissingTableError(FileNotFoundError):
    """A required input does not exist."""


class UnknownUnitError(LookupError):
    """No row exists for the requested unit."""


def column_type(name: str) -> T.DataType:
    """The Spark type of a column of the data model, by its name."""
    if name in (UNIT, TIME, "max_cycle"):
        return T.LongType()
    if name == RISK:
        return T.StringType()
    if name in (FAILURE, "health_score") or name.endswith("_degraded"):
        return T.IntegerType()
    return T.DoubleType()


def is_known(name: str) -> bool:
    """Whether the data model says what a column of this name holds."""
    whole = {UNIT, TIME, RUL, FAILURE, RISK, "max_cycle", "health_score", "importance", "prediction"}
    return name in whole or name.startswith(("sensor_", "op_setting_"))


def schema_for(columns: Iterable[str]) -> T.StructType:
    """A schema for a table of the data model with the given columns."""
    return T.StructType([T.StructField(c, column_type(c), True) for c in columns])


def require_columns(df: DataFrame, required: Iterable[str], *, mode: str = "raise") -> DataFrame | None:
    """Return ``df`` if it has all ``required`` columns.

    Otherwise raise (``mode='raise'``) or return None (``mode='none'``).
    """
    missing = [c for c in required if c not in df.columns]
    if not missing:
        return df
    if mode == "none":
        return None
    raise MissingColumnsError(f"missing columns {missing}; the table has {df.columns}")

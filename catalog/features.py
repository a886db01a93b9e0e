"""Columns: renaming, casting, selection, filters, reshaping, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.health import FAMILIES, KEYS, S
from catalog.registry import r, register, rounded
from fleetwane.functions import health as H
from fleetwane.operators import columns, health, split

FEATURE_NAMES = [*T.ALL_SENSORS, *(f"{s}_{f}" for f in FAMILIES for s in S)]


def _features(spark, folder, **options):
    return health.sensor_health_features(
        T.telemetry(spark, folder), S, failure_threshold=30, order=T.ORDER, **options
    )


def _sql_list(names) -> str:
    return ", ".join(n if n.endswith("_degraded") else r(n, n) for n in names)


@register("rename_columns", f"WITH {T.TELEMETRY} SELECT unit AS engine, time_in_cycles AS time, reading_id FROM telemetry")
def _(spark, folder):
    df = columns.rename_columns(T.telemetry(spark, folder), {"unit": "engine", "time_in_cycles": "time"})
    return df.select("engine", "time", "reading_id")


TEXT_KEYS = """text_keys AS (
  SELECT event_id AS reading_id,
         CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR)
              WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR) || '.5' ELSE event_type END AS unit,
         CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS VARCHAR) || '.0' END AS time_in_cycles
  FROM events)"""
INTEGERS = """integers AS (
  SELECT reading_id,
         CASE WHEN TRY_CAST(unit AS DOUBLE) = floor(TRY_CAST(unit AS DOUBLE)) THEN CAST(TRY_CAST(unit AS DOUBLE) AS BIGINT) END AS unit,
         CASE WHEN TRY_CAST(time_in_cycles AS DOUBLE) = floor(TRY_CAST(time_in_cycles AS DOUBLE))
              THEN CAST(TRY_CAST(time_in_cycles AS DOUBLE) AS BIGINT) END AS time_in_cycles
  FROM text_keys)"""


def _text_keys(spark, folder):
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    third = F.col("event_id") % 3
    return T.read(spark, folder, "events").select(
        F.col("event_id").alias("reading_id"),
        F.when(third == 0, user).when(third == 1, F.concat(user, F.lit(".5"))).otherwise(F.col("event_type")).alias("unit"),
        F.when(F.col("event_id") % 5 != 0, F.concat(event, F.lit(".0"))).alias("time_in_cycles"),
    )


@register("coerce_integer", f"WITH {TEXT_KEYS}, {INTEGERS} SELECT * FROM integers")
def _(spark, folder):
    return columns.coerce_integer(_text_keys(spark, folder))


@register(
    "drop_missing",
    f"WITH {TEXT_KEYS}, {INTEGERS} SELECT * FROM integers WHERE unit IS NOT NULL AND time_in_cycles IS NOT NULL",
)
def _(spark, folder):
    return columns.drop_missing(columns.coerce_integer(_text_keys(spark, folder)))


@register(
    "cast_features",
    f"WITH {T.FEATURES} SELECT {KEYS}, "
    + ", ".join(f"CAST({s}_degraded AS DOUBLE) AS {s}_degraded, {r(s, s)}" for s in S)
    + " FROM features",
)
def _(spark, folder):
    df = columns.cast_features(_features(spark, folder))
    return rounded(df.select("unit", "time_in_cycles", "reading_id", *S, *(f"{s}_degraded" for s in S)))


@register("select_features", f"WITH {T.FEATURES} SELECT reading_id, {_sql_list(FEATURE_NAMES)} FROM features")
def _(spark, folder):
    return rounded(columns.select_features(_features(spark, folder), "reading_id"))


ALIGNED = ["sensor_9", "sensor_2_rolling_mean", "sensor_2", "sensor_4_degraded"]


@register("align_columns", f"WITH {T.FEATURES} SELECT reading_id, {_sql_list(ALIGNED)} FROM features")
def _(spark, folder):
    return rounded(columns.align_columns(_features(spark, folder), ALIGNED, keep=["reading_id"]))


@register(
    "handle_missing_features",
    f"WITH {T.FEATURES} SELECT reading_id, "
    + ", ".join(r(f"coalesce({s}_{f}, 0)", f"{s}_{f}") for s in S for f in ("rolling_std", "cycle_change"))
    + " FROM features",
)
def _(spark, folder):
    df = columns.fill_missing_features(_features(spark, folder))
    return rounded(df.select("reading_id", *(f"{s}_{f}" for s in S for f in ("rolling_std", "cycle_change"))))


DERIVED = [f"{s}_{f}" for f in ("degraded", "rolling_mean", "rolling_std") for s in S]


@register("select_derived_columns", f"WITH {T.FEATURES} SELECT reading_id, {_sql_list(DERIVED)} FROM features")
def _(spark, folder):
    return rounded(columns.select_derived_columns(_features(spark, folder), "reading_id"))


@register(
    "select_base_sensors",
    f"WITH {T.FEATURES} SELECT reading_id, {', '.join(r(s, s) for s in T.ALL_SENSORS)}, "
    + _sql_list([f"{s}_{f}" for s in S for f in ("baseline", "degraded", "cycle_change")])
    + " FROM features",
)
def _(spark, folder):
    return rounded(columns.select_base_sensors(_features(spark, folder), "reading_id"))


@register(
    "select_measurements",
    f"WITH {T.TELEMETRY} SELECT reading_id, {', '.join(r(s, s) for s in ('op_setting_1', *T.ALL_SENSORS))} FROM telemetry",
)
def _(spark, folder):
    return rounded(columns.select_measurements(T.telemetry(spark, folder), "reading_id"))


@register(
    "sensor_kind",
    f"WITH {T.FEATURES} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, '{k}' AS kind, '{n} ({k})' AS title, count({n}) AS readings FROM features"
        for n, k in [(s, "raw") for s in S] + [(f"{s}_{f}", f) for s in S for f in FAMILIES]
    ),
)
def _(spark, folder):
    names = [*S, *(f"{s}_{f}" for s in S for f in FAMILIES)]
    counts = _features(spark, folder).agg(*(F.count(n).alias(n) for n in names))
    rows = F.array(*(F.struct(F.lit(n).alias("feature"), F.col(n).alias("readings")) for n in names))
    return counts.select(F.inline(rows)).select(
        "feature",
        H.sensor_kind(F.col("feature")).alias("kind"),
        H.sensor_title(F.col("feature")).alias("title"),
        "readings",
    )


@register(
    "preview",
    f"WITH {T.TELEMETRY} SELECT {KEYS}, {r('sensor_2', 'sensor_2')} FROM telemetry ORDER BY unit, time_in_cycles, reading_id LIMIT 5",
)
def _(spark, folder):
    df = columns.preview(T.telemetry(spark, folder), order=("unit", *T.ORDER))
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "sensor_2"))


@register("filter_unit", f"WITH {T.TELEMETRY} SELECT {KEYS}, {r('sensor_2', 'sensor_2')} FROM telemetry WHERE unit = 7")
def _(spark, folder):
    df = columns.filter_unit(T.telemetry(spark, folder), 7)
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "sensor_2"))


@register(
    "filter_units",
    f"WITH {T.TELEMETRY}, {T.TRUTH} SELECT {KEYS} FROM telemetry WHERE unit IN (SELECT unit FROM truth WHERE RUL < 5)",
)
def _(spark, folder):
    """The readings of the units that end within 5 cycles: a chosen set given as a table."""
    chosen = T.truth(spark, folder).filter("RUL < 5")
    return columns.filter_units(T.telemetry(spark, folder), chosen).select("unit", "time_in_cycles", "reading_id")


@register(
    "trend_series",
    f"WITH {T.FEATURES} SELECT {KEYS}, {r('sensor_2_rolling_mean', 'sensor_2_rolling_mean')} FROM features",
)
def _(spark, folder):
    return rounded(columns.trend_series(_features(spark, folder), "sensor_2_rolling_mean", tiebreak=("reading_id",)))


@register("distinct_units", f"WITH {T.TELEMETRY} SELECT DISTINCT unit FROM telemetry")
def _(spark, folder):
    return columns.distinct_units(T.telemetry(spark, folder))


@register("default_units", f"WITH {T.TELEMETRY} SELECT DISTINCT unit FROM telemetry ORDER BY unit LIMIT 2")
def _(spark, folder):
    return columns.distinct_units(T.telemetry(spark, folder), 2)


@register(
    "unit_list",
    f"WITH {T.TELEMETRY} SELECT string_agg(CAST(unit AS VARCHAR), ', ' ORDER BY unit) AS units "
    "FROM (SELECT DISTINCT unit FROM telemetry ORDER BY unit LIMIT 3) u",
)
def _(spark, folder):
    return columns.unit_list(T.telemetry(spark, folder), 3)


@register("distinct_truth", f"WITH {T.LABELED} SELECT DISTINCT unit, RUL FROM labeled")
def _(spark, folder):
    from fleetwane.operators.labels import label_rul

    return columns.distinct_truth(label_rul(T.telemetry(spark, folder)))


@register(
    "melt_sensors",
    f"WITH {T.TELEMETRY} "
    + " UNION ALL ".join(
        f"SELECT {KEYS}, '{s}' AS \"Sensor\", {r(s, 'Value')} FROM telemetry" for s in T.ALL_SENSORS
    ),
)
def _(spark, folder):
    return rounded(columns.melt_sensors(T.telemetry(spark, folder), T.ALL_SENSORS, ids=("unit", *T.ORDER)))


def _bucket(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % 10000 < 2000"


@register(
    "split_rows",
    f"WITH {T.TELEMETRY} SELECT {KEYS}, {_bucket('concat_ws(chr(45), unit, time_in_cycles, reading_id, 42)')} AS is_test FROM telemetry",
)
def _(spark, folder):
    df = split.mark_split(T.telemetry(spark, folder), ("unit", *T.ORDER))
    return df.select("unit", "time_in_cycles", "reading_id", "is_test")


@register("split_units", f"WITH {T.TELEMETRY} SELECT {KEYS}, {_bucket('concat_ws(chr(45), unit, 42)')} AS is_test FROM telemetry")
def _(spark, folder):
    train, test = split.split_units(T.telemetry(spark, folder))
    keys = ["unit", "time_in_cycles", "reading_id"]
    return train.select(*keys, F.lit(False).alias("is_test")).unionByName(test.select(*keys, F.lit(True).alias("is_test")))

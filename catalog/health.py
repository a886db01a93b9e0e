"""Labels and health features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.registry import r, register, rounded
from fleetwane.operators import health, labels, outliers, panel

S = T.TELEMETRY_SENSORS
KEYS = "unit, time_in_cycles, reading_id"
FAMILIES = ("baseline", "degraded", "rolling_mean", "rolling_std", "cycle_change")


def _feature_list(sensors, families=FAMILIES) -> str:
    return ", ".join(
        f"{s}_{f}" if f == "degraded" else r(f"{s}_{f}", f"{s}_{f}") for s in sensors for f in families
    )


@register("label_rul", f"WITH {T.LABELED} SELECT {KEYS}, RUL FROM labeled")
def _(spark, folder):
    return labels.label_rul(T.telemetry(spark, folder)).select("unit", "time_in_cycles", "reading_id", "RUL")


@register("label_failure", f"WITH {T.LABELED} SELECT {KEYS}, RUL, failure_binary FROM labeled")
def _(spark, folder):
    df = labels.label_failures(T.telemetry(spark, folder))
    return df.select("unit", "time_in_cycles", "reading_id", "RUL", "failure_binary")


@register(
    "label_failure_bulk",
    f"WITH {T.BULK} SELECT failure_binary, count(*) AS n, CAST(sum(RUL) AS BIGINT) AS total_RUL FROM (SELECT "
    "max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles AS RUL, "
    "CAST(max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles <= 365 AS INTEGER) AS failure_binary "
    "FROM bulk) b GROUP BY failure_binary",
)
def _(spark, folder):
    df = labels.label_failures(T.bulk(spark, folder), threshold=365)
    return df.groupBy("failure_binary").agg(F.count(F.lit(1)).alias("n"), F.sum("RUL").alias("total_RUL"))


@register("unit_max_cycle", f"WITH {T.TELEMETRY} SELECT {KEYS}, max(time_in_cycles) OVER (PARTITION BY unit) AS max_cycle FROM telemetry")
def _(spark, folder):
    df = labels.unit_max_cycle(T.telemetry(spark, folder))
    return df.select("unit", "time_in_cycles", "reading_id", "max_cycle")


@register(
    "broadcast_unit_aggregate",
    f"WITH {T.TELEMETRY} SELECT {KEYS}, count(*) OVER (PARTITION BY unit) AS readings, "
    f"{r('avg(sensor_2) OVER (PARTITION BY unit)', 'mean_value')} FROM telemetry",
)
def _(spark, folder):
    df = panel.with_unit_aggregates(
        T.telemetry(spark, folder), {"readings": F.count(F.lit(1)), "mean_value": F.avg("sensor_2")}
    )
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "readings", "mean_value"))


@register(
    "failure_zone",
    f"WITH {T.TELEMETRY} SELECT {KEYS}, max(time_in_cycles) OVER (PARTITION BY unit) AS max_cycle, "
    "time_in_cycles >= max(time_in_cycles) OVER (PARTITION BY unit) - 30 AS failure_zone FROM telemetry",
)
def _(spark, folder):
    df = labels.mark_failure_zone(T.telemetry(spark, folder))
    return df.select("unit", "time_in_cycles", "reading_id", "max_cycle", "failure_zone")


@register(
    "near_end_threshold",
    f"WITH {T.TELEMETRY} SELECT {KEYS}, max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles AS cycles_remaining, "
    f"{r('max(time_in_cycles) OVER (PARTITION BY unit) * CAST(0.2 AS DOUBLE)', 'near_end_cycles')} FROM telemetry",
)
def _(spark, folder):
    df = labels.mark_near_end(T.telemetry(spark, folder))
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "cycles_remaining", "near_end_cycles"))


@register(
    "failure_window_per_unit",
    f"WITH {T.TELEMETRY} SELECT unit, max(time_in_cycles) - 30 AS failure_start, max(time_in_cycles) AS failure_end "
    "FROM telemetry GROUP BY unit",
)
def _(spark, folder):
    return labels.failure_window_per_unit(T.telemetry(spark, folder))


@register(
    "first_n_per_unit",
    f"WITH {T.TELEMETRY} SELECT {KEYS}, {r('sensor_2', 'sensor_2')} FROM (SELECT *, row_number() OVER "
    "(PARTITION BY unit ORDER BY time_in_cycles, reading_id) AS rn FROM telemetry) t WHERE rn <= 5",
)
def _(spark, folder):
    df = panel.first_n_per_unit(T.telemetry(spark, folder), 5, order=T.ORDER)
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "sensor_2"))


BASELINES = (
    "baselines AS (SELECT unit, "
    + ", ".join(f"avg({s}) AS {s}" for s in S)
    + " FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY time_in_cycles, reading_id) AS rn FROM telemetry) t "
    "WHERE rn <= 5 GROUP BY unit)"
)


@register(
    "sensor_baselines",
    f"WITH {T.TELEMETRY}, {BASELINES} SELECT unit, {', '.join(r(s, s) for s in S)} FROM baselines",
)
def _(spark, folder):
    return rounded(health.sensor_baselines(T.telemetry(spark, folder), S, order=T.ORDER))


@register(
    "merge_baselines",
    f"WITH {T.TELEMETRY}, {BASELINES} SELECT t.unit, time_in_cycles, reading_id, "
    + ", ".join(r(f"b.{s}", f"{s}_baseline") for s in S)
    + " FROM telemetry t JOIN baselines b ON t.unit = b.unit",
)
def _(spark, folder):
    df = T.telemetry(spark, folder)
    merged = health.merge_baselines(df, health.sensor_baselines(df, S, order=T.ORDER))
    return rounded(merged.select("unit", "time_in_cycles", "reading_id", *(f"{s}_baseline" for s in S)))


@register("degraded_flags", f"WITH {T.FEATURES} SELECT {KEYS}, {', '.join(f'{s}_degraded' for s in S)} FROM features")
def _(spark, folder):
    df = T.telemetry(spark, folder)
    merged = health.merge_baselines(df, health.sensor_baselines(df, S, order=T.ORDER))
    flagged = health.degraded_flags(merged, S)
    return flagged.select("unit", "time_in_cycles", "reading_id", *(f"{s}_degraded" for s in S))


@register(
    "health_score",
    f"WITH {T.FEATURES} SELECT {KEYS}, CAST({' + '.join(f'{s}_degraded' for s in S)} AS INTEGER) AS health_score, "
    + r("CAST(0.5 AS DOUBLE) * sensor_2_degraded + sensor_3_degraded + sensor_4_degraded", "weighted_score")
    + " FROM features",
)
def _(spark, folder):
    df = T.telemetry(spark, folder)
    flagged = health.degraded_flags(
        health.merge_baselines(df, health.sensor_baselines(df, S, order=T.ORDER)), S
    )
    weighted = health.health_score(flagged, weights={"sensor_2": 0.5}).withColumnRenamed("health_score", "weighted_score")
    return rounded(
        health.health_score(weighted).select("unit", "time_in_cycles", "reading_id", "health_score", "weighted_score")
    )


def _single_family(name: str, suffix: str) -> None:
    sql = f"WITH {T.FEATURES} SELECT {KEYS}, {_feature_list(S, [suffix])} FROM features"

    @register(name, sql)
    def _(spark, folder):
        df = health.rolling_features(T.telemetry(spark, folder), S, features=(f"_{suffix}",), order=T.ORDER)
        return rounded(df.select("unit", "time_in_cycles", "reading_id", *(f"{s}_{suffix}" for s in S)))


_single_family("rolling_mean", "rolling_mean")
_single_family("rolling_std", "rolling_std")
_single_family("cycle_change", "cycle_change")

FULL = f"WITH {T.FEATURES} SELECT {KEYS}, RUL, failure_binary, {_feature_list(S)} FROM features"


def _full(spark, folder, **options):
    df = health.sensor_health_features(
        T.telemetry(spark, folder), S, failure_threshold=30, order=T.ORDER, **options
    )
    names = [f"{s}_{f}" for s in S for f in FAMILIES]
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "RUL", "failure_binary", *names))


@register("sensor_health_features", FULL)
def _(spark, folder):
    return _full(spark, folder)


@register("sensor_health_features_split_units", FULL)
def _(spark, folder):
    """The same features when units above 70 readings count as hot and are cut into segments."""
    return _full(spark, folder, hot_rows=70)


BULK_S = T.BULK_SENSORS


# Deviations of prices in the ten thousands: the last exact decimals are fewer.
COARSE = {"sensor_3_rolling_std": 3}


@register(
    "sensor_health_features_bulk",
    f"WITH {T.BULK}, {T.feature_sql('bulk', BULK_S, T.BULK_ORDER, window=10)} "
    "SELECT unit, time_in_cycles, l_orderkey, l_linenumber, RUL, failure_binary, "
    + ", ".join(
        f"{s}_{f}" if f == "degraded" else r(f"{s}_{f}", f"{s}_{f}", COARSE.get(f"{s}_{f}", 6))
        for s in BULK_S
        for f in FAMILIES
    )
    + " FROM features",
)
def _(spark, folder):
    df = health.sensor_health_features(
        T.bulk(spark, folder), BULK_S, rolling_window=10, failure_threshold=30, order=T.BULK_ORDER
    )
    names = [f"{s}_{f}" for s in BULK_S for f in FAMILIES]
    keys = ("unit", "time_in_cycles", "l_orderkey", "l_linenumber")
    return rounded(df.select(*keys, "RUL", "failure_binary", *names), **COARSE)


@register(
    "rolling_band",
    f"WITH {T.TELEMETRY}, {T.feature_sql('telemetry', ['sensor_2'], T.ORDER, window=10)} SELECT {KEYS}, "
    f"{r('sensor_2', 'sensor_2')}, {r('sensor_2_rolling_mean', 'sensor_2_rolling_mean')}, "
    f"{r('sensor_2_rolling_mean - sensor_2_rolling_std', 'band_low')}, "
    f"{r('sensor_2_rolling_mean + sensor_2_rolling_std', 'band_high')} FROM features",
)
def _(spark, folder):
    df = health.rolling_band(T.telemetry(spark, folder), "sensor_2", order=T.ORDER)
    return rounded(
        df.select("unit", "time_in_cycles", "reading_id", "sensor_2", "sensor_2_rolling_mean", "band_low", "band_high")
    )


def _z(s: str) -> str:
    return (
        f"CASE WHEN count({s}) OVER u = count(*) OVER u AND max({s}) OVER u > min({s}) OVER u "
        f"THEN ({s} - avg({s}) OVER u) / nullif(stddev_pop({s}) OVER u, 0) END AS {s}_zscore"
    )


ZSCORES = (
    "zscores AS (SELECT *, max(time_in_cycles) OVER u AS last_cycle, "
    + ", ".join(_z(s) for s in T.ALL_SENSORS)
    + " FROM telemetry WINDOW u AS (PARTITION BY unit))"
)


@register(
    "unit_zscores",
    f"WITH {T.TELEMETRY}, {ZSCORES} SELECT {KEYS}, {', '.join(r(f'{s}_zscore', f'{s}_zscore') for s in T.ALL_SENSORS)} FROM zscores",
)
def _(spark, folder):
    df = outliers.unit_zscores(T.telemetry(spark, folder), T.ALL_SENSORS, flags=False)
    return rounded(df.select("unit", "time_in_cycles", "reading_id", *(f"{s}_zscore" for s in T.ALL_SENSORS)))


@register(
    "outlier_flag",
    f"WITH {T.TELEMETRY}, {ZSCORES} SELECT {KEYS}, "
    + ", ".join(f"coalesce(abs({s}_zscore) > 3, false) AS {s}_outlier" for s in T.ALL_SENSORS)
    + " FROM zscores",
)
def _(spark, folder):
    df = outliers.unit_zscores(T.telemetry(spark, folder), T.ALL_SENSORS)
    return df.select("unit", "time_in_cycles", "reading_id", *(f"{s}_outlier" for s in T.ALL_SENSORS))


NEAR = "last_cycle - time_in_cycles <= last_cycle * CAST(0.2 AS DOUBLE)"


@register(
    "filter_near_end_outliers",
    f"WITH {T.TELEMETRY}, {ZSCORES} SELECT {KEYS}, {r('sensor_2_zscore', 'sensor_2_zscore')}, "
    f"last_cycle - time_in_cycles AS cycles_remaining FROM zscores WHERE abs(sensor_2_zscore) > 3 AND {NEAR}",
)
def _(spark, folder):
    df = outliers.filter_near_end_outliers(T.telemetry(spark, folder), "sensor_2")
    return rounded(df.select("unit", "time_in_cycles", "reading_id", "sensor_2_zscore", "cycles_remaining"))


@register(
    "outliers_near_end",
    f"WITH {T.TELEMETRY}, {ZSCORES} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, count(*) FILTER (WHERE abs({s}_zscore) > 3 AND {NEAR}) AS outliers FROM zscores"
        for s in T.ALL_SENSORS
    ),
)
def _(spark, folder):
    return outliers.outliers_near_end(T.telemetry(spark, folder), T.ALL_SENSORS)


@register(
    "unit_health_indicators",
    f"WITH {T.FEATURES} SELECT {KEYS}, {_feature_list(S)} FROM features WHERE unit = 7",
)
def _(spark, folder):
    from fleetwane.plans.views import unit_health_indicators

    df = unit_health_indicators(T.telemetry(spark, folder), 7, S, order=T.ORDER)
    return rounded(df.select("unit", "time_in_cycles", "reading_id", *(f"{s}_{f}" for s in S for f in FAMILIES)))

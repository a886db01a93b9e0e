"""How the given tables are read as fleet data, in Spark and in SQL.

events   -> telemetry: one reading per event; the cycle is the hour since 2024-01-01,
            readings within an hour are ordered by ``reading_id``.
events   -> predictions and truth: a stand-in for model output, computed per row, and the
            hours from a unit's last reading to the end of the observed 720 hours.
lineitem -> bulk: long units (suppliers) with one reading per line, ordered by ship day.
orders   -> runs and trials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.functions import health as H

ORDER = ("time_in_cycles", "reading_id")
TELEMETRY_SENSORS = ("sensor_2", "sensor_3", "sensor_4")
ALL_SENSORS = ("sensor_1", "sensor_2", "sensor_3", "sensor_4", "sensor_9")
HORIZON = 720

BULK_SENSORS = ("sensor_2", "sensor_3", "sensor_4", "sensor_7")
BULK_ORDER = ("time_in_cycles", "l_orderkey", "l_linenumber", "l_partkey", *BULK_SENSORS, "l_returnflag", "l_linestatus")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    k = F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("double")
    return events.select(
        F.col("user_id").alias("unit"),
        _hours("ts").alias("time_in_cycles"),
        F.col("event_id").alias("reading_id"),
        F.hour("ts").cast("double").alias("op_setting_1"),
        F.lit(100.0).alias("sensor_1"),
        F.col("value").alias("sensor_2"),
        k.alias("sensor_3"),
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("sensor_4"),
        (F.col("value") * 2 + k).alias("sensor_9"),
    )


def _hours(ts: str):
    days = F.datediff(F.to_date(ts), F.lit("2024-01-01").cast("date"))
    return (days * 24 + F.hour(ts)).cast("bigint")


TELEMETRY = """telemetry AS (
  SELECT user_id AS unit,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS time_in_cycles,
         event_id AS reading_id,
         CAST(hour(ts) AS DOUBLE) AS op_setting_1,
         CAST(100.0 AS DOUBLE) AS sensor_1,
         value AS sensor_2,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS sensor_3,
         CASE WHEN event_id % 17 <> 0 THEN value END AS sensor_4,
         value * 2 + CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS sensor_9
  FROM events)"""

LABELED = (
    TELEMETRY
    + """, labeled AS (
  SELECT *, max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles AS RUL,
         CAST(max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles <= 30 AS INTEGER) AS failure_binary
  FROM telemetry)"""
)


def bulk(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("unit"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("bigint").alias("time_in_cycles"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").alias("sensor_2"),
        F.col("l_extendedprice").alias("sensor_3"),
        F.col("l_discount").alias("sensor_4"),
        F.col("l_tax").alias("sensor_7"),
        "l_returnflag",
        "l_linestatus",
    )


BULK = """bulk AS (
  SELECT l_suppkey AS unit,
         date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS time_in_cycles,
         l_orderkey, l_linenumber, l_partkey,
         l_quantity AS sensor_2, l_extendedprice AS sensor_3, l_discount AS sensor_4, l_tax AS sensor_7,
         l_returnflag, l_linestatus
  FROM lineitem)"""


def feature_sql(source: str, sensors, order, *, window: int = 5, baseline: int = 5, name: str = "features") -> str:
    """CTEs with the label, the flags and all health features of ``source``."""
    keys = ", ".join(order)
    frame = f"(PARTITION BY unit ORDER BY {keys} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    parts = []
    for s in sensors:
        parts += [
            f"avg(CASE WHEN rn <= {baseline} THEN {s} END) OVER (PARTITION BY unit) AS {s}_baseline",
            f"avg({s}) OVER {frame} AS {s}_rolling_mean",
            f"stddev_samp({s}) OVER {frame} AS {s}_rolling_std",
            f"{s} - lag({s}) OVER (PARTITION BY unit ORDER BY {keys}) AS {s}_cycle_change",
        ]
    flags = [f"CAST(coalesce({s} < 0.75 * {s}_baseline, false) AS INTEGER) AS {s}_degraded" for s in sensors]
    return f"""{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY unit ORDER BY {keys}) AS rn,
         max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles AS RUL,
         CAST(max(time_in_cycles) OVER (PARTITION BY unit) - time_in_cycles <= 30 AS INTEGER) AS failure_binary
  FROM {source}), {name}_windows AS (
  SELECT *, {', '.join(parts)} FROM {name}_ranked), {name} AS (
  SELECT *, {', '.join(flags)} FROM {name}_windows)"""


FEATURES = TELEMETRY + ", " + feature_sql("telemetry", TELEMETRY_SENSORS, ORDER)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in predictions, one per reading."""
    events = read(spark, folder, "events")
    hours = _hours("ts")
    noise = ((F.col("event_id") * 37) % 41 - 20) * F.lit(0.375)
    return events.select(
        F.col("user_id").alias("unit"),
        hours.alias("time_in_cycles"),
        F.col("event_id").alias("reading_id"),
        H.round_half_even((F.lit(HORIZON) - hours) * F.lit(0.97) + noise).alias("RUL"),
    )


def rated_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions(spark, folder).withColumn("risk_level", H.classify_risk(F.col("RUL")))


PREDICTIONS = """predictions AS (
  SELECT unit, time_in_cycles, reading_id, RUL,
         CASE WHEN RUL < 30 THEN 'High' WHEN RUL < 100 THEN 'Medium' ELSE 'Low' END AS risk_level
  FROM (SELECT user_id AS unit, h AS time_in_cycles, event_id AS reading_id,
               round_even(((720 - h) * CAST(0.97 AS DOUBLE) + ((event_id * 37) % 41 - 20) * CAST(0.375 AS DOUBLE)) * 100, 0) / 100 AS RUL
        FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS h FROM events) e) p)"""


def truth(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    return events.groupBy(F.col("user_id").alias("unit")).agg((F.lit(HORIZON) - F.max(_hours("ts"))).alias("RUL"))


TRUTH = """truth AS (
  SELECT user_id AS unit,
         720 - max(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts)) AS RUL
  FROM events GROUP BY user_id)"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders read as training runs: priority = experiment, price = RMSE (missing for every tenth)."""
    orders = read(spark, folder, "orders")
    price = F.col("o_totalprice")
    millis = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000
    return orders.select(
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "P", "FAILED").otherwise("RUNNING").alias("status"),
        millis.alias("start_time"),
        (millis + 3_600_000).alias("end_time"),
        F.create_map(F.lit("custkey"), F.col("o_custkey").cast("string")).alias("params"),
        F.create_map(
            F.lit("RMSE"), F.when(F.col("o_orderkey") % 10 != 0, price),
            F.lit("MAE"), price * 0.75,
            F.lit("R2"), F.lit(1.0) - price * 0.000001,
            F.lit("Max Error"), price * 4,
        ).alias("metrics"),
        F.create_map(F.lit("model_type"), F.concat(F.lit("type-"), (F.col("o_custkey") % 3).cast("string"))).alias("tags"),
    )


RUNS = """runs AS (
  SELECT o_orderpriority AS experiment, CAST(o_orderkey AS VARCHAR) AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS status,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000 AS start_time,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000 + 3600000 AS end_time,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS RMSE,
         o_totalprice * CAST(0.75 AS DOUBLE) AS MAE,
         1 - o_totalprice * CAST(0.000001 AS DOUBLE) AS R2,
         o_totalprice * 4 AS max_error,
         'type-' || CAST(o_custkey % 3 AS VARCHAR) AS model_type
  FROM orders), best_runs AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY RMSE, run_id) AS place
                 FROM runs WHERE status = 'FINISHED' AND RMSE IS NOT NULL) b WHERE place = 1)"""


def trials(spark: SparkSession, folder: str) -> DataFrame:
    """Orders read as search trials, with many equal scores."""
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("trial"),
        F.col("o_orderpriority").alias("params"),
        F.floor(F.col("o_totalprice") / 10000).cast("double").alias("MAE"),
    )


TRIALS = """trials AS (
  SELECT o_orderkey AS trial, o_orderpriority AS params, CAST(floor(o_totalprice / 10000) AS DOUBLE) AS MAE
  FROM orders)"""

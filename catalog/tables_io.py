"""Tables written to text, CSV or label files and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.health import KEYS
from catalog.registry import r, register, rounded
from fleetwane.operators.columns import distinct_truth
from fleetwane.operators.labels import label_failures
from fleetwane.session import scratch_dir
from fleetwane.sources import readers, writers

COLUMNS = ("unit", "time_in_cycles", "reading_id", "sensor_1", "sensor_2", "sensor_4")


def _path(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register(
    "read_whitespace_text",
    f"WITH {T.TELEMETRY} SELECT unit, time_in_cycles, CAST(reading_id AS DOUBLE) AS reading_id, "
    f"{r('sensor_1', 'sensor_1')}, {r('sensor_2', 'sensor_2')}, {r('sensor_4', 'sensor_4')} FROM telemetry",
)
def _(spark, folder):
    """Text with leading, double and trailing blanks; missing readings are written as NaN."""
    path = _path(spark, "text")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in COLUMNS]
    T.telemetry(spark, folder).select(F.concat(F.lit(" "), F.concat_ws("  ", *fields), F.lit("  "))).write.text(path)
    return rounded(readers.read_whitespace_text(spark, path, COLUMNS))


@register(
    "read_csv_table",
    f"WITH {T.LABELED} SELECT 'U-' || unit AS unit, time_in_cycles, CAST(RUL AS DOUBLE) AS \"RUL\", failure_binary, "
    f"{r('sensor_2', 'sensor_2')}, {r('sensor_4', 'sensor_4')}, 'reading ' || reading_id AS note FROM labeled",
)
def _(spark, folder):
    """With unit ids that are texts and a column of texts that is not in the data model."""
    path = _path(spark, "labelled") + ".csv"
    df = label_failures(T.telemetry(spark, folder))
    unit = F.concat(F.lit("U-"), F.col("unit").cast("string")).alias("unit")
    note = F.concat(F.lit("reading "), F.col("reading_id").cast("string")).alias("note")
    writers.write_table(df.select(unit, "time_in_cycles", "RUL", "failure_binary", "sensor_2", "sensor_4", note), path, format="csv")
    return rounded(readers.read_csv_table(spark, path))


@register(
    "read_csv_types",
    f"WITH {T.TELEMETRY} SELECT reading_id + 9007199254740993 AS serial, reading_id % 3 = 0 AS flagged, "
    "lpad(CAST(reading_id % 1000 AS VARCHAR), 6, '0') AS code, CAST(DATE '2024-01-01' + CAST(reading_id % 300 AS INTEGER) AS VARCHAR) AS checked, 'date' AS kind, "
    f"CASE WHEN reading_id % 5 > 0 THEN reading_id END AS visits, {r('sensor_2 / 7', 'ratio', 9)}, "
    "CASE WHEN reading_id % 2 = 0 THEN CAST(reading_id AS VARCHAR) ELSE 'true' END AS mixed FROM telemetry",
)
def _(spark, folder):
    """Columns outside the data model: large ids, flags, codes with leading zeros, dates, whole numbers with gaps, fractions."""
    path = _path(spark, "types") + ".csv"
    n = F.col("reading_id")
    df = T.telemetry(spark, folder).select(
        (n + 9007199254740993).alias("serial"),
        (n % 3 == 0).alias("flagged"),
        F.lpad((n % 1000).cast("string"), 6, "0").alias("code"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 300).cast("int")).alias("checked"),
        F.when(n % 5 > 0, n).alias("visits"),
        (F.col("sensor_2") / 7).alias("ratio"),
        F.when(n % 2 == 0, n.cast("string")).otherwise("true").alias("mixed"),
    )
    writers.write_table(df, path, format="csv")
    found = readers.read_csv_table(spark, path)
    kind = F.lit(dict(found.dtypes)["checked"]).alias("kind")
    return rounded(found.select(*found.columns, kind).withColumn("checked", F.col("checked").cast("string")), ratio=9)


@register("write_table", f"WITH {T.TELEMETRY} SELECT {KEYS}, {r('sensor_2', 'sensor_2')} FROM telemetry")
def _(spark, folder):
    path = _path(spark, "telemetry")
    df = T.telemetry(spark, folder).select("unit", "time_in_cycles", "reading_id", "sensor_2")
    writers.write_table(df, path, by_unit=8)
    return rounded(readers.read_required(spark, path, ("unit", "time_in_cycles")))


@register(
    "read_first_existing",
    f"WITH {T.LABELED} SELECT DISTINCT unit, RUL FROM labeled",
)
def _(spark, folder):
    path = _path(spark, "truth")
    writers.write_table(label_failures(T.telemetry(spark, folder)).select("unit", "RUL"), path)
    found = readers.read_first_existing(spark, [path + "-missing", f"{folder}/events.parquet", path])
    return distinct_truth(found)


@register(
    "read_positional_labels",
    f"WITH {T.TRUTH} SELECT row_number() OVER (ORDER BY unit) AS unit, RUL FROM truth",
)
def _(spark, folder):
    """One number per line; line i belongs to the i-th unit."""
    path = _path(spark, "labels")
    T.truth(spark, folder).orderBy("unit").select(F.col("RUL").cast("string")).write.text(path)
    return readers.read_positional_labels(spark, path)

import pytest

from conftest import same
from pyspark.sql import functions as F

from fleetwane.functions import health as H
from fleetwane.operators import columns, quality, split
from fleetwane.schema import MissingColumnsError, require_columns, schema_for


@pytest.fixture()
def wide(spark):
    return spark.createDataFrame(
        [(1, 1, 0.5, 7.0, 1.0, None, 3, 1, 2.0), (1, 2, 0.5, 8.0, 1.0, None, 4, 0, 2.5), (2, 1, 0.5, None, 1.0, None, 5, 0, 2.0)],
        "unit bigint, time_in_cycles bigint, op_setting_1 double, sensor_10 double, sensor_2 double, sensor_3 double, "
        "sensor_2_rolling_mean int, sensor_2_degraded int, sensor_2_slope double",
    )


def values(spark, column, *rows):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x double").select(column(F.col("x"))).collect()]


def test_risk_levels(spark):
    rows = values(spark, H.classify_risk, 29.99, 30.0, 99.99, 100.0, None, float("nan"))
    assert rows == ["High", "Medium", "Medium", "Low", "Low", "Low"]


def test_rounding_halves_to_even(spark):
    assert values(spark, H.round_half_even, 0.575, 2.675, 0.125) == [0.57, 2.68, 0.12]


def test_texts_round_like_common_formatting(spark):
    rows = [0.25, 0.15, 2.675, 1234.5, None]
    expected = [f"{x:.1f} cycles" if x is not None else None for x in rows]
    assert values(spark, lambda c: H.format_metric(c, 1), *rows) == expected


def test_flags_of_missing_values(spark):
    assert values(spark, H.failure_flag, 30.0, 30.5, None) == [1, 0, 0]
    assert values(spark, H.outlier_flag, 3.0, -3.1, None) == [False, True, False]
    assert values(spark, lambda c: H.degraded_flag(c, F.lit(100.0)), 74.9, 75.0, None) == [1, 0, 0]


def test_alerts_and_colours(spark):
    df = spark.createDataFrame([("High",), ("odd",)], "risk_level string")
    rows = df.select(H.alert_label(F.col("risk_level")), H.risk_colour(F.col("risk_level"))).collect()
    assert same(rows, [("🔴 High", "#d9534f"), (None, "black")])


def test_integers(spark):
    df = spark.createDataFrame([("7",), ("abc",), ("2.5",), (None,), ("9007199254740993",)], "unit string")
    assert [r[0] for r in columns.coerce_integer(df, ["unit"]).collect()] == [7, None, None, None, 9007199254740993]
    assert columns.drop_missing(columns.coerce_integer(df, ["unit"]), ["unit"]).count() == 2


def test_selectors(wide):
    assert columns.base_sensor_columns(wide) == ["sensor_10", "sensor_2", "sensor_2_degraded", "sensor_3"]
    assert columns.derived_columns(wide) == ["sensor_2_rolling_mean", "sensor_2_degraded"]
    assert columns.measurement_columns(wide)[0] == "op_setting_1"
    assert "op_setting_1" not in columns.measurement_columns(wide, settings=False)
    assert "unit" not in columns.feature_columns(wide)
    assert set(dict(columns.cast_features(wide).select("sensor_2_degraded", "sensor_10").dtypes).values()) == {"double"}


def test_alignment(wide):
    assert columns.align_columns(wide, ["sensor_3", "sensor_2"]).columns == ["sensor_3", "sensor_2"]
    with pytest.raises(MissingColumnsError):
        columns.align_columns(wide, ["sensor_99"])


def test_required_columns(wide):
    assert require_columns(wide, ["unit"]) is wide
    assert require_columns(wide, ["x"], mode="none") is None
    with pytest.raises(MissingColumnsError):
        require_columns(wide, ["x"])


def test_constant_and_missing_columns(wide):
    assert quality.constant_columns(wide) == ["op_setting_1", "sensor_2"]
    train, test = quality.drop_constant_columns(wide, wide)
    assert "sensor_2" not in train.columns and train.columns == test.columns
    nulls = {r["column"]: r["nulls"] for r in quality.null_counts(wide).collect()}
    assert nulls["sensor_3"] == 3 and nulls["sensor_10"] == 1 and nulls["unit"] == 0


def test_table_info(wide):
    rows = sorted(quality.table_info(wide).collect())
    assert [r["column"] for r in rows] == wide.columns
    assert rows[3]["non_null"] == 2 and rows[3]["rows"] == 3 and rows[3]["type"] == "double"


def test_filters_and_series(spark, wide):
    assert columns.filter_unit(wide, 1).count() == 2
    assert columns.filter_units(wide, [2]).count() == 1
    assert columns.filter_units(wide, spark.createDataFrame([(1,), (1,)], "unit bigint")).count() == 2
    assert [r["unit"] for r in columns.distinct_units(wide, 1).collect()] == [1]
    assert columns.trend_series(wide, "sensor_10", unit=1).columns == ["unit", "time_in_cycles", "sensor_10"]
    assert columns.trend_series(wide, "sensor_10", units=[1, 2]).count() == 3


def test_melt_mixes_types(wide):
    long = columns.melt_sensors(wide, ["sensor_10", "sensor_2_rolling_mean"])
    assert long.count() == 6 and dict(long.dtypes)["Value"] == "double"


def test_schema_by_name():
    types = {f.name: f.dataType.simpleString() for f in schema_for(["unit", "RUL", "risk_level", "sensor_2_degraded", "sensor_1"])}
    assert types == {"unit": "bigint", "RUL": "double", "risk_level": "string", "sensor_2_degraded": "int", "sensor_1": "double"}


def test_splits(spark):
    df = spark.range(4000).selectExpr("id % 200 AS unit", "id div 200 AS time_in_cycles", "id")
    train, test = split.split_rows(df)
    assert train.count() + test.count() == 4000 and train.join(test, "id").count() == 0
    assert 600 < test.count() < 1000
    again = split.split_rows(df.repartition(3, "id"))[1]
    assert {r.id for r in again.collect()} == {r.id for r in test.collect()}
    a, b = split.split_units(df)
    assert a.join(b, "unit", "left_semi").count() == 0 and a.count() + b.count() == 4000
    other = split.split_rows(df, seed=7)[1]
    assert {r.id for r in other.collect()} != {r.id for r in test.collect()}

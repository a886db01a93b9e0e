import pytest

from conftest import same
from fleetwane.operators import labels
from fleetwane.schema import MissingColumnsError

ROWS = [(1, 10), (1, 20), (1, 30), (2, 5), (2, 15)]


@pytest.fixture()
def panel(spark):
    return spark.createDataFrame(ROWS, "unit bigint, time_in_cycles bigint")


def test_rul_and_flag(panel):
    df = labels.label_failures(panel, threshold=10)
    assert same(df.collect(), [(1, 10, 20, 0), (1, 20, 10, 1), (1, 30, 0, 1), (2, 5, 10, 1), (2, 15, 0, 1)])
    assert dict(df.dtypes)["failure_binary"] == "int" and dict(df.dtypes)["RUL"] == "bigint"


def test_wrong_time_name_is_an_error(panel):
    with pytest.raises(MissingColumnsError):
        labels.label_rul(panel.withColumnRenamed("time_in_cycles", "time"))


def test_row_without_unit_keeps_its_place_without_label(spark):
    df = spark.createDataFrame([*ROWS, (None, 7)], "unit bigint, time_in_cycles bigint")
    rows = labels.label_failures(df, threshold=10).filter("unit IS NULL").collect()
    assert same(rows, [(None, 7, None, 0)])


def test_smallest_rul_is_zero_and_flag_matches_zone(panel):
    df = labels.mark_failure_zone(labels.label_failures(panel, threshold=10), threshold=10)
    assert {r[0] for r in df.groupBy("unit").min("RUL").select("min(RUL)").collect()} == {0}
    assert all(bool(r.failure_binary) == r.failure_zone for r in df.collect())


def test_name_can_be_chosen(panel):
    assert "cycles_remaining" in labels.label_rul(panel, name="cycles_remaining").columns


def test_failure_window(panel):
    assert same(labels.failure_window_per_unit(panel, threshold=10).collect(), [(1, 20, 30), (2, 5, 15)])
    assert same(labels.failure_window_per_unit(panel, threshold=10, units=[2]).collect(), [(2, 5, 15)])


def test_ensure_risk_level_keeps_an_existing_one(spark):
    df = spark.createDataFrame([(1, 5.0, "Low")], "unit bigint, RUL double, risk_level string")
    assert labels.ensure_risk_level(df).first()["risk_level"] == "Low"
    assert labels.ensure_risk_level(df.drop("risk_level")).first()["risk_level"] == "High"

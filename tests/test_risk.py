import pytest

from conftest import same
from fleetwane.operators import metrics, risk
from fleetwane.plans import views
from fleetwane.schema import MissingColumnsError, UnknownUnitError

SCHEMA = "unit bigint, time_in_cycles bigint, RUL double, risk_level string"


@pytest.fixture()
def predictions(spark):
    return spark.createDataFrame(
        [(1, 2, 20.25, "High"), (1, 1, 25.0, "High"), (2, 1, 150.0, "Low"), (3, 1, 101.0, "Low")], SCHEMA
    )


@pytest.fixture()
def truth(spark):
    return spark.createDataFrame([(1, 22), (2, 140)], "unit bigint, RUL bigint")


def test_distribution_fills_absent_levels(predictions):
    assert [tuple(r) for r in risk.risk_distribution(predictions).collect()] == [("High", 2), ("Medium", 0), ("Low", 2)]


def test_most_urgent(predictions):
    assert [r.RUL for r in risk.top_high_risk(predictions, 2).collect()] == [20.25, 25.0]


def test_prediction_table_is_sorted(predictions):
    rows = risk.prediction_table(predictions).collect()
    assert [r.Alert for r in rows] == ["🔴 High", "🔴 High", "🟢 Low", "🟢 Low"]


def test_comparison_by_grain(predictions, truth):
    last = risk.compare_with_truth(predictions, truth, grain="last").collect()
    assert {(r.unit, r.RUL_pred, r.RUL_true, r.error, r.delta) for r in last} == {(1, 20.25, 22, 1.75, -1.75), (2, 150.0, 140, 10.0, 10.0)}
    first = risk.compare_with_truth(predictions, truth, grain="first").filter("unit = 1").first()
    assert first.RUL_pred == 25.0
    assert risk.compare_with_truth(predictions, truth, grain="all").count() == 3


def test_comparison_of_disjoint_units_is_empty(spark, predictions):
    other = spark.createDataFrame([(9, 1)], "unit bigint, RUL bigint")
    assert risk.compare_with_truth(predictions, other).count() == 0


def test_views(predictions, truth):
    assert views.all_predictions(predictions).count() == 4
    row = views.require_unit_prediction(predictions.drop("risk_level"), 1)
    assert row.asDict() == {"unit": 1, "RUL": 25.0, "risk_level": "High"}
    with pytest.raises(UnknownUnitError):
        views.require_unit_prediction(predictions, 77)
    with pytest.raises(MissingColumnsError):
        views.all_predictions(predictions.drop("RUL"))
    summary = views.summary_view(predictions)
    assert summary["top_high_risk"].first()["remaining"] == "20.2 cycles"
    comparison = {r.unit: r for r in views.rul_view(predictions, truth)["comparison"].collect()}
    assert comparison[1].true_text == "22 cycles" and comparison[1].delta_text == "3.00" and comparison[1].is_urgent
    assert "comparison" not in views.rul_view(predictions)
    assert views.overview_title("x", [1, 2]) == "Trend of x for Units 1, 2"


def test_unit_analysis(spark):
    rows = [(u, t, float(t)) for u in (1, 2, 3) for t in range(1, 6)]
    df = spark.createDataFrame(rows, "unit bigint, time_in_cycles bigint, sensor_2 double")
    view = views.unit_analysis_view(df, ["sensor_2"], units=[1, 2], threshold=3)
    assert view.count() == 10
    row = view.filter("unit = 1 AND time_in_cycles = 5").first()
    assert (row.failure_start, row.failure_end, row.sensor_2_rolling_mean) == (2, 5, 3.0)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "RUL double, prediction double")
    row = metrics.regression_metrics(df).first().asDict()
    assert row["MAE"] == pytest.approx(4 / 3) and row["RMSE"] == pytest.approx((10 / 3) ** 0.5)
    assert row["R2"] == pytest.approx(1 - 10 / 8) and row["Max Error"] == 3
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "RUL double, prediction double")
    assert metrics.regression_metrics(flat).first()["R2"] is None


def test_inference_summary(predictions):
    assert same(risk.inference_summary(predictions).collect(), [(4, 74.0625, 2)])

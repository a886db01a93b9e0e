"""Predictions: risk, comparison, rankings and the read views."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.health import KEYS, S
from catalog.registry import r, register, rounded
from fleetwane.functions import health as H
from fleetwane.operators import labels, metrics, risk
from fleetwane.plans import views

P = f"WITH {T.PREDICTIONS}"
PT = f"WITH {T.PREDICTIONS}, {T.TRUTH}"
TIE = ("reading_id",)
ALERT = "CASE risk_level WHEN 'High' THEN '🔴 High' WHEN 'Medium' THEN '🟠 Medium' WHEN 'Low' THEN '🟢 Low' END"
COLOUR = "CASE risk_level WHEN 'High' THEN '#d9534f' WHEN 'Medium' THEN '#f0ad4e' WHEN 'Low' THEN '#5cb85c' ELSE 'black' END"


def _keys(df, *more):
    return df.select("unit", "time_in_cycles", "reading_id", *more)


@register("classify_risk", f"{P} SELECT {KEYS}, {r('RUL', 'RUL')}, risk_level FROM predictions")
def _(spark, folder):
    return rounded(_keys(T.rated_predictions(spark, folder), "RUL", "risk_level"))


@register("ensure_risk_level", f"{P} SELECT {KEYS}, CASE WHEN RUL < 50 THEN 'High' WHEN RUL < 200 THEN 'Medium' ELSE 'Low' END AS risk_level FROM predictions")
def _(spark, folder):
    df = labels.ensure_risk_level(T.predictions(spark, folder), high=50, medium=200)
    return _keys(labels.ensure_risk_level(df), "risk_level")


@register("round_half_even", "SELECT event_id, round_even(value / 8 * 100, 0) / 100 + 0.0 AS value FROM events")
def _(spark, folder):
    events = T.read(spark, folder, "events")
    return events.select("event_id", H.round_half_even(F.col("value") / 8).alias("value"))


@register("alert_label", f"{P} SELECT {KEYS}, {ALERT} AS \"Alert\", {COLOUR} AS colour FROM predictions")
def _(spark, folder):
    df = T.rated_predictions(spark, folder)
    level = F.col("risk_level")
    return _keys(df, H.alert_label(level).alias("Alert"), H.risk_colour(level).alias("colour"))


@register(
    "format_metric",
    f"{P} SELECT {KEYS}, format('{{:.1f}} cycles', RUL) AS one, format('{{:.2f}}', RUL) AS two FROM predictions",
)
def _(spark, folder):
    rul = F.col("RUL")
    df = T.predictions(spark, folder)
    return _keys(df, H.format_metric(rul, 1).alias("one"), H.format_metric(rul, 2, "").alias("two"))


@register("low_rul_warning", f"{P} SELECT {KEYS}, RUL < 30 AS is_urgent FROM predictions")
def _(spark, folder):
    return _keys(T.predictions(spark, folder), H.low_rul_warning(F.col("RUL")).alias("is_urgent"))


@register(
    "prediction_error",
    f"{PT} SELECT p.unit, time_in_cycles, reading_id, {r('p.RUL', 'RUL_pred')}, t.RUL AS \"RUL_true\", "
    f"{r('abs(t.RUL - p.RUL)', 'error')}, {r('p.RUL - t.RUL', 'delta')} FROM predictions p JOIN truth t ON p.unit = t.unit",
)
def _(spark, folder):
    df = risk.compare_with_truth(T.predictions(spark, folder), T.truth(spark, folder), grain="all")
    return rounded(_keys(df, "RUL_pred", "RUL_true", "error", "delta"))


@register(
    "compare_with_truth",
    f"{PT} SELECT p.unit, time_in_cycles, reading_id, {r('p.RUL', 'RUL_pred')}, t.RUL AS \"RUL_true\", "
    f"{r('abs(t.RUL - p.RUL)', 'error')}, {r('p.RUL - t.RUL', 'delta')} FROM (SELECT *, row_number() OVER "
    "(PARTITION BY unit ORDER BY time_in_cycles DESC, reading_id DESC) AS rn FROM predictions) p "
    "JOIN truth t ON p.unit = t.unit WHERE rn = 1",
)
def _(spark, folder):
    df = risk.compare_with_truth(
        T.predictions(spark, folder), T.truth(spark, folder), grain="last", tiebreak=TIE
    )
    return rounded(_keys(df, "RUL_pred", "RUL_true", "error", "delta"))


@register(
    "compare_with_labels",
    f"""WITH {T.PREDICTIONS}, {T.LABELED},
    firsts AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY time_in_cycles, reading_id) AS rn FROM predictions),
    points AS (SELECT unit, RUL, row_number() OVER (PARTITION BY unit ORDER BY time_in_cycles, reading_id) AS rn FROM labeled)
    SELECT p.unit, {r('p.RUL', 'RUL_pred')}, t.RUL AS "RUL_true", {r('abs(t.RUL - p.RUL)', 'error')}, {r('p.RUL - t.RUL', 'delta')}
    FROM firsts p JOIN points t ON p.unit = t.unit AND p.rn = 1 AND t.rn = 1""",
)
def _(spark, folder):
    """First prediction against the first label of each unit, the labels being one per cycle."""
    truth = labels.label_rul(T.telemetry(spark, folder)).select("unit", "RUL").dropDuplicates()
    df = risk.compare_with_truth(T.predictions(spark, folder), truth, grain="first", tiebreak=TIE)
    return rounded(df.select("unit", "RUL_pred", "RUL_true", "error", "delta"))


@register(
    "risk_distribution",
    f"{P} SELECT l.level AS risk_level, count(p.unit) AS n FROM (VALUES ('High'), ('Medium'), ('Low')) l(level) "
    "LEFT JOIN predictions p ON p.risk_level = l.level GROUP BY l.level",
)
def _(spark, folder):
    return risk.risk_distribution(T.rated_predictions(spark, folder))


@register("top_high_risk", f"{P} SELECT {KEYS}, {r('RUL', 'RUL')}, risk_level FROM predictions ORDER BY RUL, unit, time_in_cycles LIMIT 5")
def _(spark, folder):
    return rounded(_keys(risk.top_high_risk(T.rated_predictions(spark, folder)), "RUL", "risk_level"))


@register("prediction_table", f"{P} SELECT unit, {r('RUL', 'RUL')}, {ALERT} AS \"Alert\" FROM predictions")
def _(spark, folder):
    return rounded(risk.prediction_table(T.rated_predictions(spark, folder)))


@register(
    "first_match",
    f"{P} SELECT {KEYS}, {r('RUL', 'RUL')} FROM predictions WHERE unit = 7 ORDER BY time_in_cycles, reading_id LIMIT 1",
)
def _(spark, folder):
    return rounded(_keys(risk.first_match(T.predictions(spark, folder), 7, tiebreak=TIE), "RUL"))


@register(
    "inference_summary",
    f"{P} SELECT count(*) AS num_predictions, {r('avg(RUL)', 'mean_RUL')}, count(*) FILTER (WHERE risk_level = 'High') AS high_risk_count FROM predictions",
)
def _(spark, folder):
    return rounded(risk.inference_summary(T.rated_predictions(spark, folder)))


@register(
    "regression_metrics",
    f"{PT} SELECT {r('avg(abs(t.RUL - p.RUL))', 'MAE')}, {r('sqrt(avg(pow(t.RUL - p.RUL, 2)))', 'RMSE')}, "
    f"{r('1 - sum(pow(t.RUL - p.RUL, 2)) / (var_pop(t.RUL) * count(*))', 'R2')}, {r('max(abs(t.RUL - p.RUL))', 'Max Error')} "
    "FROM predictions p JOIN truth t ON p.unit = t.unit",
)
def _(spark, folder):
    joined = risk.compare_with_truth(T.predictions(spark, folder), T.truth(spark, folder), grain="all")
    return rounded(metrics.regression_metrics(joined, truth="RUL_true", predicted="RUL_pred"))


@register("all_predictions", f"{P} SELECT unit, {r('RUL', 'RUL')}, risk_level FROM predictions")
def _(spark, folder):
    return rounded(views.all_predictions(T.predictions(spark, folder)).select("record.*"))


@register(
    "unit_prediction",
    f"{P} SELECT unit, {r('RUL', 'RUL')}, risk_level FROM predictions WHERE unit = 11 ORDER BY time_in_cycles, reading_id LIMIT 1",
)
def _(spark, folder):
    return rounded(views.unit_prediction(T.predictions(spark, folder), 11, tiebreak=TIE))


@register(
    "summary_view",
    f"{P} SELECT unit, {r('RUL', 'RUL')}, risk_level, {COLOUR} AS colour, format('{{:.1f}} cycles', RUL) AS remaining "
    "FROM predictions ORDER BY RUL, unit, time_in_cycles LIMIT 5",
)
def _(spark, folder):
    return rounded(views.summary_view(T.predictions(spark, folder))["top_high_risk"])


@register(
    "overview_view",
    f"WITH {T.FEATURES} SELECT {KEYS}, {r('sensor_3_rolling_std', 'sensor_3_rolling_std')}, "
    "'sensor_3_rolling_std (rolling_std)' AS title FROM features",
)
def _(spark, folder):
    from fleetwane.operators.health import rolling_features

    df = rolling_features(T.telemetry(spark, folder), S, order=T.ORDER)
    return rounded(views.overview_view(df, "sensor_3_rolling_std", tiebreak=TIE))


@register(
    "unit_analysis_view",
    f"WITH {T.FEATURES} SELECT {KEYS}, {r('sensor_2', 'sensor_2')}, {r('sensor_3', 'sensor_3')}, "
    f"{r('sensor_2_rolling_mean', 'sensor_2_rolling_mean')}, {r('sensor_3_rolling_mean', 'sensor_3_rolling_mean')}, "
    "time_in_cycles + RUL AS failure_end, time_in_cycles + RUL - 30 AS failure_start FROM features",
)
def _(spark, folder):
    return rounded(views.unit_analysis_view(T.telemetry(spark, folder), ["sensor_2", "sensor_3"], order=T.ORDER))


@register(
    "rul_view",
    f"{PT} SELECT p.unit, {r('p.RUL', 'RUL_pred')}, t.RUL AS \"RUL_true\", t.RUL || ' cycles' AS true_text, "
    "format('{:.2f} cycles', p.RUL) AS predicted_text, format('{:.2f} cycles', abs(t.RUL - p.RUL)) AS error_text, "
    "format('{:.2f}', p.RUL - t.RUL) AS delta_text, p.RUL < 30 AS is_urgent FROM (SELECT *, row_number() OVER "
    "(PARTITION BY unit ORDER BY time_in_cycles, reading_id) AS rn FROM predictions) p JOIN truth t ON p.unit = t.unit WHERE rn = 1",
)
def _(spark, folder):
    view = views.rul_view(T.predictions(spark, folder), T.truth(spark, folder), tiebreak=TIE)["comparison"]
    return rounded(
        view.select("unit", "RUL_pred", "RUL_true", "true_text", "predicted_text", "error_text", "delta_text", "is_urgent")
    )

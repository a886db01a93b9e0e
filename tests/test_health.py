import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, same
from fleetwane.operators import health, outliers, panel
from fleetwane.operators.quality import constant_columns
from fleetwane.operators.correlation import lower_triangle

S = ["sensor_1", "sensor_2"]
SCHEMA = "unit bigint, time_in_cycles bigint, sensor_1 double, sensor_2 double"
# Two series of readings, six of each unit.
ONE = [100, 95, 90, 85, 70, 65, 120, 115, 110, 105, 80, 75]
TWO = [200, 190, 180, 170, 160, 150, 250, 240, 230, 220, 210, 200]


def frame(spark, one, two, units=None):
    units = units or [1] * len(one)
    time = {}
    rows = []
    for u, a, b in zip(units, one, two):
        t = time.get(u, 0)
        time[u] = t + 1
        rows.append((u, t, None if a is None else float(a), None if b is None else float(b)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def sample(spark):
    return frame(spark, ONE, TWO, [1] * 6 + [2] * 6)


@pytest.fixture()
def engineered(sample):
    return {(r.unit, r.time_in_cycles): r for r in health.sensor_health_features(sample, S, with_score=True).collect()}


@pytest.mark.parametrize("sensor", S)
def test_all_features_exist(sample, sensor):
    df = health.sensor_health_features(sample, S)
    for suffix in ("baseline", "degraded", "rolling_mean", "rolling_std", "cycle_change"):
        assert df.filter(f"{sensor}_{suffix} IS NOT NULL").count() > 0


def test_rows_are_kept_and_score_is_whole(engineered):
    assert len(engineered) == 12
    assert all(isinstance(r.health_score, int) for r in engineered.values())


def test_flags_and_score(engineered):
    assert engineered[1, 0].sensor_1_baseline == 88 and engineered[1, 5].sensor_2_baseline == 180
    assert engineered[2, 0].sensor_1_baseline == 106 and engineered[2, 0].sensor_2_baseline == 230
    flagged = {k for k, r in engineered.items() if r.sensor_1_degraded}
    assert flagged == {(1, 5), (2, 5)}
    assert not any(r.sensor_2_degraded for r in engineered.values())
    assert {k for k, r in engineered.items() if r.health_score == 1} == flagged
    assert all(r.health_score == r.sensor_1_degraded + r.sensor_2_degraded for r in engineered.values())


def test_rolling_values(engineered):
    unit = [engineered[1, t] for t in range(6)]
    assert unit[0].sensor_1_rolling_mean == 100 and unit[5].sensor_1_rolling_mean == 81
    assert [r.sensor_1_cycle_change for r in unit] == [None, -5, -5, -5, -15, -5]
    assert unit[0].sensor_1_rolling_std is None


def test_short_unit(spark):
    rows = health.sensor_health_features(frame(spark, [100, 95], [200, 190]), S).collect()
    assert {(r.sensor_1_baseline, r.sensor_2_baseline) for r in rows} == {(97.5, 195.0)}


def test_missing_values(spark):
    df = frame(spark, [100, None, 90, None, 85], [200, 190, None, 170, None])
    rows = sorted(health.sensor_health_features(df, S).collect(), key=lambda r: r.time_in_cycles)
    assert rows[0].sensor_1_baseline == pytest.approx(91.666667) and rows[0].sensor_2_baseline == pytest.approx(186.666667)
    assert all(r.sensor_1_degraded == 0 and r.sensor_2_degraded == 0 for r in rows)
    assert [round(r.sensor_1_rolling_mean, 4) for r in rows] == [100, 100, 95, 95, 91.6667]
    stds = [r.sensor_1_rolling_std for r in rows]
    assert stds[:2] == [None, None] and [round(x, 6) for x in stds[2:]] == [7.071068, 7.071068, 7.637626]
    assert all(r.sensor_1_cycle_change is None for r in rows)


def test_flat_series(spark):
    df = frame(spark, [100] * 6, [200] * 6)
    rows = sorted(health.sensor_health_features(df, S, with_score=True).collect(), key=lambda r: r.time_in_cycles)
    assert all(r.health_score == 0 for r in rows)
    assert [r.sensor_1_rolling_std for r in rows] == [None, 0, 0, 0, 0, 0]
    assert constant_columns(df, S) == S
    assert lower_triangle(df, S).first()["correlation"] is None
    assert all(r.sensor_1_zscore is None and not r.sensor_1_outlier for r in outliers.unit_zscores(df, S).collect())


def test_weighted_score(sample):
    df = health.sensor_health_features(sample, S)
    rows = health.health_score(df, weights={"sensor_1": 2.5}).filter("sensor_1_degraded = 1").collect()
    assert [r.health_score for r in rows] == [2.5, 2.5]


def test_stepwise_equals_one_pass(sample):
    steps = health.rolling_features(
        health.degraded_flags(health.merge_baselines(sample, health.sensor_baselines(sample, S)), S), S
    )
    one = health.sensor_health_features(sample, S)
    assert same(steps.select(*one.columns).collect(), one.collect())


def test_input_order_does_not_matter(spark, sample):
    rows = sample.collect()
    random.Random(3).shuffle(rows)
    shuffled = spark.createDataFrame(rows, SCHEMA)
    assert same(
        health.sensor_health_features(shuffled, S).collect(), health.sensor_health_features(sample, S).collect()
    )


def test_row_without_unit_is_dropped(spark, sample):
    more = sample.unionByName(spark.createDataFrame([(None, 1, 1.0, 1.0)], SCHEMA))
    assert health.sensor_health_features(more, S).count() == 12


def test_row_without_cycle_is_not_among_the_first(spark):
    rows = [(1, None, 1000.0, 1.0)] + [(1, t, 10.0, 1.0) for t in range(1, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    for hot_rows in (10**9, 3):
        features = health.sensor_health_features(df, S, hot_rows=hot_rows)
        assert {r.sensor_1_baseline for r in features.collect()} == {10.0}
        assert features.filter("time_in_cycles IS NULL").first().sensor_1_cycle_change == 990.0
    assert health.sensor_baselines(df, S).first().sensor_1 == 10.0


def test_zscore_of_incomplete_unit_is_missing(spark):
    df = frame(spark, [1, 2, None, 4], [1, 2, 3, 40])
    rows = outliers.unit_zscores(df, S, threshold=1.5).collect()
    assert all(r.sensor_1_zscore is None and r.sensor_1_outlier is False for r in rows)
    assert sum(r.sensor_2_outlier for r in rows) == 1


def test_near_end_outliers_keep_zero_counts(spark):
    df = frame(spark, [1.0] * 19 + [50.0], [1.0] * 20)
    assert same(outliers.outliers_near_end(df, S).collect(), [("sensor_1", 1), ("sensor_2", 0)])
    kept = outliers.filter_near_end_outliers(df, "sensor_1").collect()
    assert [(r.time_in_cycles, r.cycles_remaining) for r in kept] == [(19, 0)]


def big_panel(spark, *, hot=400, small=6, copies=1):
    """One unit holds most rows, with gaps and repeated cycles; the others are short."""
    draw = random.Random(11)
    rows = []
    for i in range(hot):
        rows += [(0, (i * i) // 3, i, draw.choice([None, draw.random() * 100, 50.0]), draw.random())] * (
            copies if i == hot // 2 else 1
        )
    for unit in range(1, small + 1):
        rows += [(unit, i, i, draw.random() * 100, draw.random()) for i in range(draw.randint(1, 9))]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "unit bigint, time_in_cycles bigint, place bigint, sensor_1 double, sensor_2 double")


@pytest.mark.parametrize("hot_rows,window", [(5, 5), (50, 10), (399, 2), (20, 1)])
def test_hot_unit_cut_into_segments_gives_the_same(spark, hot_rows, window):
    df = big_panel(spark)
    options = dict(
        rolling_window=window, baseline_window=4, failure_threshold=30, with_score=True, order=("time_in_cycles", "place")
    )
    whole = health.sensor_health_features(df, S, hot_rows=10**9, **options)
    split = health.sensor_health_features(df, S, hot_rows=hot_rows, **options)
    assert split.columns == whole.columns
    assert same(split.collect(), whole.collect())


def test_identical_copies_of_a_row_are_spread(spark):
    df = big_panel(spark, hot=60, copies=300)
    options = dict(order=("time_in_cycles", "place"))
    whole = health.rolling_features(df, S, hot_rows=10**9, **options)
    split = health.rolling_features(df, S, hot_rows=30, **options)
    assert same(split.collect(), whole.collect())


def test_small_segments_share_partitions(spark, monkeypatch):
    stored = {}

    def store(df, label):
        stored[label] = kept(df, label)
        return stored[label]

    kept = panel.store
    monkeypatch.setattr(panel, "store", store)
    df = big_panel(spark)
    split = health.rolling_features(df, S, hot_rows=6, order=("time_in_cycles", "place"))
    rows = stored["segments"]
    assert len(rows.inputFiles()) <= 8  # shuffle partitions of the session, not a partition for each segment
    sizes = rows.groupBy("unit", "__segment").count()
    assert sizes.count() >= rows.count() / 3 and sizes.agg(F.max("count")).first()[0] <= 3
    whole = health.rolling_features(df, S, hot_rows=10**9, order=("time_in_cycles", "place"))
    assert same(split.collect(), whole.collect())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_per_unit_table_is_stored_and_joined(spark, folder, how):
    more = spark.createDataFrame([(None, 3, 1, 1.0, 1.0), (77, 3, 1, 1.0, 1.0)], big_panel(spark).schema)
    big_panel(spark).unionByName(more).write.parquet(f"{folder}/panel")
    df = spark.read.parquet(f"{folder}/panel")
    per_unit = df.filter("unit <> 77").groupBy("unit").agg(F.max("time_in_cycles").alias("last"))
    expected = df.join(per_unit, "unit", how).collect()
    assert "BroadcastHashJoin" in plan_of(panel.join_per_unit(df, per_unit, how=how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = panel.join_per_unit(df, per_unit, how=how)
        assert same(joined.collect(), expected)
        plan = plan_of(joined).split("Initial Plan")[0]
        # each side is a scan of its own, shuffled for this join only
        assert "SortMergeJoin" in plan and plan.count("Scan parquet") == 2 and "Aggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aggregates_scan_the_rows_once_more(spark, folder):
    big_panel(spark).write.parquet(f"{folder}/panel")
    df = spark.read.parquet(f"{folder}/panel")
    spark.sparkContext.setJobGroup("building", "building")
    try:
        joined = panel.with_unit_aggregates(df, {"last": F.max("time_in_cycles")})
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    # the aggregate is one written table; the rows are scanned for it and for the join
    assert plan_of(joined).count(f"{folder}/panel") <= 1


@pytest.mark.parametrize("hot_rows", [7, 10**6])
def test_ties_come_as_they_arrive(spark, hot_rows):
    rows = [(1, i // 10, float(i), float(-i)) for i in range(60)] + [(2, 0, 5.0, 5.0), (2, 0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    rolled = health.rolling_features(df, S, window=2, hot_rows=hot_rows)
    change = {(r.unit, r.sensor_1): r.sensor_1_cycle_change for r in rolled.collect()}
    assert change == {(1, float(i)): None if i == 0 else 1.0 for i in range(60)} | {(2, 5.0): None, (2, 7.0): 2.0}


def test_hot_units_are_found(spark):
    df = big_panel(spark)
    assert same(panel.hot_units(df, hot_rows=100).collect(), [(0, 400)])
    assert panel.hot_units(df, hot_rows=1000).count() == 0


def test_one_shuffle_for_all_features_and_no_python(spark, folder):
    big_panel(spark).write.parquet(f"{folder}/panel")
    df = spark.read.parquet(f"{folder}/panel")
    features = health.sensor_health_features(df, S, failure_threshold=30, with_score=True)
    plan = plan_of(features)
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
    assert plan.count("Sort [") == 1
    pruned = plan_of(features.select("unit", "sensor_1_rolling_mean"))
    assert "sensor_2" not in pruned.split("ReadSchema")[1]


def test_unit_filter_reaches_the_scan(spark, folder):
    from fleetwane.plans.views import unit_health_indicators

    big_panel(spark).write.parquet(f"{folder}/panel")
    df = unit_health_indicators(spark.read.parquet(f"{folder}/panel"), 3, S)
    assert "EqualTo(unit,3)" in plan_of(df)


def test_first_rows_are_limited_before_the_shuffle(spark, folder):
    big_panel(spark).write.parquet(f"{folder}/panel")
    df = panel.first_n_per_unit(spark.read.parquet(f"{folder}/panel"), 5)
    plan = plan_of(df)
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_small_unit_aggregate_avoids_the_shuffle_of_rows(spark, folder):
    from fleetwane.operators.labels import label_rul

    big_panel(spark).write.parquet(f"{folder}/panel")
    plan = plan_of(label_rul(spark.read.parquet(f"{folder}/panel")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

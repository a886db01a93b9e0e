import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, same
from fleetwane.operators import correlation, profile

draw = random.Random(5)
UNIFORM = [draw.random() for _ in range(3000)]
TAILED = [math.exp(draw.gauss(0, 12)) * draw.choice([-1, 1]) for _ in range(3000)]
COPIES = [draw.choice([1.5, 2.5, 2.5, 2.5, 9.0]) for _ in range(2999)] + [None]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(zip(UNIFORM, TAILED, COPIES)), "a double, b double, c double").repartition(5)


@pytest.mark.parametrize("sortable", [10, 500, 10**6])
def test_percentiles_equal_numpy(table, sortable):
    p = (0.0, 0.013, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = {
        (r["column"], r["probability"]): r["value"]
        for r in profile.percentiles(table, ["a", "b", "c"], p, sortable=sortable).collect()
    }
    for name, data in (("a", UNIFORM), ("b", TAILED), ("c", COPIES[:-1])):
        for x in p:
            assert found[name, x] == pytest.approx(np.percentile(data, 100 * x), rel=1e-12, abs=1e-300)


def test_no_task_gets_more_than_it_may_sort(spark):
    """Many magnitudes, a heavy value and infinities: ranks are cut, so every interval gets small."""
    data = [math.exp(draw.uniform(-600, 600)) * draw.choice([-1, 1]) for _ in range(4000)]
    data += [1.5] * 900 + [float("inf")] * 40 + [float("-inf")] * 3
    values = profile.long_values(spark.createDataFrame([(x,) for x in data], "a double").repartition(4), ["a"])
    wanted = set(range(0, len(data), 379)) | {0, len(data) - 1}
    ranks = {"a": (len(data), min(data), max(data), wanted)}
    found = profile.narrowed(values, ranks, sortable=60)
    assert all(n <= 60 or low == high for low, high, n, _ in found.values())
    rows = profile.order_statistics(values, ranks, sortable=60).collect()
    assert {r["rank"]: r["value"] for r in rows} == {i: sorted(data)[i] for i in wanted}


def test_histogram_counts_infinite_readings(spark):
    data = [float("inf"), float("inf"), float("-inf"), 1.0, 2.0, 3.0]
    rows = sorted(profile.histogram(spark.createDataFrame([(x,) for x in data], "a double"), ["a"], bins=2).collect())
    assert [(r["bin"], r["bin_start"], r["bin_end"], r["n"]) for r in rows] == [
        (-1, float("-inf"), 1.0, 1), (0, 1.0, 2.0, 1), (1, 2.0, 3.0, 2), (2, 3.0, float("inf"), 2)
    ]


def test_kde_shuffles_no_readings(spark, folder):
    spark.range(1000).selectExpr("rand(3) AS a").write.parquet(f"{folder}/a")
    plan = profile.kde_curve(spark.read.parquet(f"{folder}/a"), ["a"])._jdf.queryExecution().executedPlan().toString()
    assert all("value" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_columns_without_readings(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "a double, b double")
    rows = profile.percentiles(df, ["a", "b"], (0.5,)).collect()
    assert same(rows, [("a", 0.5, 2.0)])
    described = {r["column"]: r for r in profile.describe_table(df, ["a", "b"]).collect()}
    assert described["b"]["count"] == 0 and described["b"]["median"] is None
    assert described["a"]["count"] == 2 and described["a"]["mean"] == 2.0


def test_describe(table):
    rows = {r["column"]: r for r in profile.describe_table(table, ["a", "c"]).collect()}
    assert rows["c"]["count"] == 2999
    assert rows["a"]["std"] == pytest.approx(np.std(UNIFORM, ddof=1))
    assert rows["c"]["median"] == 2.5


def test_describe_text(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", None)], "s string, t string")
    assert same(profile.describe_text(df, ["s", "t"]).collect(), [("s", 3, 2, "x", 2), ("t", 2, 2, "p", 1)])


def test_histogram_equals_numpy(table):
    counts, edges = np.histogram(UNIFORM, bins=30)
    rows = sorted(profile.histogram(table, ["a"]).collect())
    assert [r["n"] for r in rows] == list(counts)
    assert np.allclose([r["bin_start"] for r in rows], edges[:-1]) and rows[-1]["bin_end"] == edges[-1]


def test_histogram_on_bin_edges_and_constant(spark):
    data = [i / 10 for i in range(31)]
    df = spark.createDataFrame([(x, 4.0) for x in data], "x double, k double")
    rows = sorted(profile.histogram(df, ["x", "k"]).collect())
    constant = [r["n"] for r in rows if r["column"] == "k"]
    assert constant == list(np.histogram([4.0] * 31, bins=30)[0])
    assert [r["n"] for r in rows if r["column"] == "x"] == list(np.histogram(data, bins=30)[0])
    assert rows[-1]["column"] == "x" and rows[-1]["n"] >= 1  # the largest value is in the last bin


def test_kde(table):
    rows = sorted(profile.kde_curve(table, ["a"], points=25).collect(), key=lambda r: r["point"])
    data = np.array(UNIFORM)
    h = data.std(ddof=1) * len(data) ** -0.2
    for r in rows:
        expected = np.exp(-0.5 * ((r["x"] - data) / h) ** 2).sum() / (len(data) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(expected)


def test_box(table):
    row = profile.box_stats(table, ["b"]).first()
    q1, q3 = np.percentile(TAILED, [25, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [x for x in TAILED if low <= x <= high]
    assert (row["whisker_low"], row["whisker_high"]) == (min(inside), max(inside))
    assert row["outliers"] == 3000 - len(inside)


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0, None, 3.0), (2.0, 1.0, 5.0, 3.0), (3.0, 5.0, 4.0, 3.0), (None, 3.0, 7.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    found = {(r.sensor_a, r.sensor_b): r.correlation for r in correlation.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1])
    assert found["c", "b"] == pytest.approx(np.corrcoef([5, 4, 7], [1, 5, 3])[0, 1]) == found["b", "c"]
    assert found["a", "a"] == 1.0 and found["k", "a"] is None and found["k", "k"] is None


def test_all_pairs_of_21_sensors(spark):
    draw = np.random.default_rng(1)
    data = draw.normal(size=(200, 21))
    names = [f"sensor_{i}" for i in range(1, 22)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{n} double" for n in names))
    rows = correlation.lower_triangle(df, names).collect()
    expected = np.corrcoef(data.T)
    assert len(rows) == 210
    for r in rows:
        i, j = names.index(r.sensor_a), names.index(r.sensor_b)
        assert i > j and r.correlation == pytest.approx(expected[i, j])


def _density(values, points=200):
    finite = np.array([v for v in values if v is not None and np.isfinite(v)])
    h = finite.std(ddof=1) * len(finite) ** -0.2
    grid = finite.min() + (finite.max() - finite.min()) / (points - 1) * np.arange(points)
    return grid, np.exp(-0.5 * ((grid[:, None] - finite) / h) ** 2).sum(1) / (len(finite) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("kind", ["normal", "tails", "infinite", "two"])
def test_density_equals_the_sum(spark, kind):
    rng = np.random.default_rng(4)
    values = {
        "normal": rng.normal(50, 3, 4000),
        "tails": rng.standard_cauchy(4000),
        "infinite": np.concatenate((rng.normal(0, 1, 500), [np.inf, -np.inf])),
        "two": np.array([1.0, 2.0]),
    }[kind].tolist()
    df = spark.createDataFrame([(v,) for v in [*values, None]], "a double")
    rows = sorted(profile.kde_curve(df, ["a"]).collect(), key=lambda r: r["point"])
    grid, density = _density(values)
    assert np.allclose([r["x"] for r in rows], grid, rtol=1e-12)
    assert np.abs(np.array([r["density"] for r in rows]) - density).max() <= 1e-9 * density.max()


def test_density_explodes_no_readings(spark, folder):
    spark.range(20_000).select((F.col("id") % 977).cast("double").alias("a")).write.parquet(f"{folder}/d")
    plan = plan_of(profile.kde_curve(spark.read.parquet(f"{folder}/d"), ["a"]))
    below = plan[plan.rindex("explode(sequence(greatest") :] if "explode(sequence(greatest" in plan else plan
    assert "HashAggregate" in below  # cells are summed before they meet the grid


def test_density_of_constant_and_empty(spark):
    rows = profile.kde_curve(spark.createDataFrame([(5.0, None)] * 3, "a double, b double"), ["a", "b"], points=4).collect()
    assert [(r["column"], r["density"]) for r in rows] == [("a", None)] * 4

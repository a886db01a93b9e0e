"""Quality and distribution statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as T
from catalog.registry import r, register, rounded
from fleetwane.operators import correlation, profile, quality

N = T.ALL_SENSORS
PAIRS = [(a, b) for i, b in enumerate(N) for a in N[i + 1 :]]


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


def _pair_rows(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS sensor_a, '{b}' AS sensor_b, {r(_corr(a, b), 'correlation')} FROM telemetry" for a, b in pairs
    )


@register(
    "null_counts",
    f"WITH {T.TELEMETRY} "
    + " UNION ALL ".join(
        f"SELECT 'train' AS dataset, '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM telemetry"
        for c in ("unit", "time_in_cycles", "reading_id", "op_setting_1", *N)
    ),
)
def _(spark, folder):
    return quality.null_counts(T.telemetry(spark, folder), dataset="train")


@register(
    "table_info",
    f"WITH {T.TELEMETRY} "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS \"type\", count({c}) AS non_null, count(*) AS \"rows\" FROM telemetry"
        for i, (c, t) in enumerate(
            [("unit", "bigint"), ("time_in_cycles", "bigint"), ("reading_id", "bigint"), ("op_setting_1", "double")]
            + [(s, "double") for s in N]
        )
    ),
)
def _(spark, folder):
    return quality.table_info(T.telemetry(spark, folder))


@register(
    "constant_columns",
    f"WITH {T.TELEMETRY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) = 1 AS is_constant FROM telemetry" for c in ("op_setting_1", *N)
    ),
)
def _(spark, folder):
    return quality.constant_column_table(T.telemetry(spark, folder), ["op_setting_1", *N])


@register(
    "drop_constant_columns",
    f"WITH {T.TELEMETRY} SELECT unit, time_in_cycles, reading_id, op_setting_1, "
    + ", ".join(r(s, s) for s in N if s != "sensor_1")
    + " FROM telemetry",
)
def _(spark, folder):
    (cleaned,) = quality.drop_constant_columns(T.telemetry(spark, folder))
    return rounded(cleaned)


@register(
    "describe_table",
    f"WITH {T.TELEMETRY} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS \"column\", count({s}) AS \"count\", {r(f'avg({s})', 'mean')}, {r(f'stddev_samp({s})', 'std')}, "
        f"{r(f'min({s})', 'min')}, {r(f'quantile_cont({s}, 0.25)', 'q1')}, {r(f'quantile_cont({s}, 0.5)', 'median')}, "
        f"{r(f'quantile_cont({s}, 0.75)', 'q3')}, {r(f'max({s})', 'max')} FROM telemetry"
        for s in N
    ),
)
def _(spark, folder):
    return rounded(profile.describe_table(T.telemetry(spark, folder), N))


@register(
    "describe_text",
    "WITH counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS v, count(*) AS n FROM events WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("event_type", "props")
    )
    + '), ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS place FROM counts) '
    'SELECT "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique", '
    'max(CASE WHEN place = 1 THEN v END) AS top, max(n) AS freq FROM ranked GROUP BY "column"',
)
def _(spark, folder):
    return profile.describe_text(T.read(spark, folder, "events"), ["event_type", "props"])


PERCENTILES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
PERCENTILES_SQL = (
    f"WITH {T.BULK} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS \"column\", CAST({p} AS DOUBLE) AS probability, {r(f'quantile_cont({s}, {p})', 'value')} FROM bulk"
        for s in T.BULK_SENSORS
        for p in PERCENTILES
    )
)


@register("percentiles", PERCENTILES_SQL)
def _(spark, folder):
    return rounded(profile.percentiles(T.bulk(spark, folder), T.BULK_SENSORS, PERCENTILES))


@register(
    "percentiles_magnitudes",
    f"WITH {T.BULK}, wide AS (SELECT sensor_3 * power(2.0, (l_orderkey * 7 + l_linenumber) % 301 - 150) AS v FROM bulk) "
    + " UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS probability, {r(f'log2(quantile_cont(v, {p}))', 'log2_value')} FROM wide" for p in PERCENTILES),
)
def _(spark, folder):
    """Readings over many magnitudes, when a task may sort no more than 1,000 of them."""
    exponent = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 301 - 150
    wide = T.bulk(spark, folder).select((F.col("sensor_3") * F.pow(F.lit(2.0), exponent)).alias("v"))
    found = profile.percentiles(wide, ["v"], PERCENTILES, sortable=1000)
    return rounded(found.select("probability", F.log2("value").alias("log2_value")))


@register("percentiles_narrowed", PERCENTILES_SQL)
def _(spark, folder):
    """The same when a task may sort no more than 100 readings."""
    return rounded(profile.percentiles(T.bulk(spark, folder), T.BULK_SENSORS, PERCENTILES, sortable=100))


@register(
    "histogram",
    f"WITH {T.TELEMETRY}, bins AS (SELECT unnest(range(30)) AS b) "
    + " UNION ALL ".join(
        f"""SELECT '{s}' AS "column", CAST(b AS INTEGER) AS bin, {r('a', 'bin_start')}, {r('z', 'bin_end')},
        (SELECT count(*) FROM telemetry WHERE {s} >= a AND ({s} < z OR b = 29)) AS n
        FROM (SELECT b, lo + (hi - lo) / 30 * b AS a, CASE WHEN b = 29 THEN hi ELSE lo + (hi - lo) / 30 * (b + 1) END AS z
              FROM bins, (SELECT min({s}) - CASE WHEN min({s}) = max({s}) THEN 0.5 ELSE 0 END AS lo,
                                 max({s}) + CASE WHEN min({s}) = max({s}) THEN 0.5 ELSE 0 END AS hi FROM telemetry) e) g"""
        for s in N
    ),
)
def _(spark, folder):
    df = profile.histogram(T.telemetry(spark, folder), N)
    return rounded(df.select("column", "bin", "bin_start", "bin_end", "n"))


@register(
    "kde_curve",
    f"""WITH {T.TELEMETRY}, shape AS (
      SELECT min(sensor_2) AS lo, max(sensor_2) AS hi, count(sensor_2) AS n,
             stddev_samp(sensor_2) * pow(count(sensor_2), -0.2) AS h FROM telemetry),
    grid AS (SELECT CAST(p AS INTEGER) AS point, lo + (hi - lo) / 199 * p AS x, n, h FROM shape, (SELECT unnest(range(200)) AS p) g)
    SELECT 'sensor_2' AS "column", point, {r('any_value(x)', 'x')},
           {r('sum(exp(-0.5 * pow((x - sensor_2) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 'density')}
    FROM grid, telemetry GROUP BY point""",
)
def _(spark, folder):
    return rounded(profile.kde_curve(T.telemetry(spark, folder), ["sensor_2"]))


_KDE_INF = f"""WITH {T.TELEMETRY}, readings AS (SELECT sensor_2 AS x FROM telemetry WHERE reading_id % 50 <> 7),
    shape AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS h FROM readings),
    grid AS (SELECT CAST(p AS INTEGER) AS point, lo + (hi - lo) / 199 * p AS g, n, h FROM shape, (SELECT unnest(range(200)) AS p) g)
    SELECT 'sensor_2' AS "column", point, {r('any_value(g)', 'x')},
           {r('sum(exp(-0.5 * pow((g - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 'density', 9)}
    FROM grid, readings GROUP BY point"""


@register("kde_curve_infinite", _KDE_INF)
def _(spark, folder):
    """Some readings are infinite; the curve is that of the others, to nine digits."""
    n = F.col("reading_id")
    odd = F.when(n % 100 == 7, float("inf")).when(n % 100 == 57, float("-inf")).otherwise(F.col("sensor_2"))
    return rounded(profile.kde_curve(T.telemetry(spark, folder).withColumn("sensor_2", odd), ["sensor_2"]), density=9)


@register(
    "box_stats",
    f"WITH {T.TELEMETRY} "
    + " UNION ALL ".join(
        f"""SELECT '{s}' AS "column", {r('any_value(q1)', 'q1')}, {r('any_value(q2)', 'median')}, {r('any_value(q3)', 'q3')},
        {r(f'least(min({s}) FILTER (WHERE {s} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), any_value(q1))', 'whisker_low')},
        {r(f'greatest(max({s}) FILTER (WHERE {s} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), any_value(q3))', 'whisker_high')},
        count({s}) FILTER (WHERE {s} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers,
        {r(f'max({s}) - min({s})', 'range')}, {r(f'var_samp({s})', 'variance')},
        {r(f'CASE WHEN max({s}) > min({s}) THEN avg(pow({s} - mu, 3)) / pow(stddev_pop({s}), 3) END', 'skewness')}
        FROM telemetry, (SELECT quantile_cont({s}, 0.25) AS q1, quantile_cont({s}, 0.5) AS q2,
                         quantile_cont({s}, 0.75) AS q3, avg({s}) AS mu FROM telemetry) q"""
        for s in N
    ),
)
def _(spark, folder):
    return rounded(profile.box_stats(T.telemetry(spark, folder), N))


@register(
    "correlation_matrix",
    f"WITH {T.TELEMETRY} {_pair_rows([(a, b) for a in N for b in N])}",
)
def _(spark, folder):
    return rounded(correlation.correlation_matrix(T.telemetry(spark, folder), N))


@register("lower_triangle", f"WITH {T.TELEMETRY} {_pair_rows(PAIRS)}")
def _(spark, folder):
    return rounded(correlation.lower_triangle(T.telemetry(spark, folder), N))


@register(
    "redundant_pairs",
    f"WITH {T.TELEMETRY} SELECT * FROM ({_pair_rows(PAIRS)}) p WHERE abs(correlation) > 0.9",
)
def _(spark, folder):
    return rounded(correlation.redundant_pairs(T.telemetry(spark, folder), N))

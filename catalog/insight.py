"""What the sensors have in common, and what a model relies on."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as T
from catalog import trees
from catalog.registry import r, register, rounded
from fleetwane.learning import attribution, importance, models
from fleetwane.operators import components
from fleetwane.operators.permute import permuted
from fleetwane.session import store

SENSORS = ["sensor_2", "sensor_3", "sensor_4", "sensor_9"]
COMPLETE = f"{T.TELEMETRY}, complete AS (SELECT * FROM telemetry WHERE sensor_2 + sensor_3 + sensor_4 + sensor_9 IS NOT NULL)"
PAIRS = [(a, b) for i, a in enumerate(SENSORS) for b in SENSORS[i:]]


@register(
    "covariance_matrix",
    f"WITH {COMPLETE} "
    + " UNION ALL ".join(f"SELECT '{a}' AS sensor_a, '{b}' AS sensor_b, {r(f'covar_samp({a}, {b})', 'covariance', 4)} FROM complete" for a, b in PAIRS),
)
def _(spark, folder):
    return rounded(components.covariance_matrix(T.telemetry(spark, folder), SENSORS), covariance=4)


# two sensors have their components in closed form
TWO = f"""{T.TELEMETRY}, sums AS (
  SELECT var_samp(sensor_2) AS a, covar_samp(sensor_2, sensor_3) AS b, var_samp(sensor_3) AS c, avg(sensor_2) AS m2, avg(sensor_3) AS m3
  FROM telemetry WHERE sensor_2 IS NOT NULL AND sensor_3 IS NOT NULL
), roots AS (SELECT *, sqrt(((a - c) / 2) ** 2 + b ** 2) AS d FROM sums),
vectors AS (
  SELECT k AS component, (a + c) / 2 + s * d AS variance, b AS x, (a + c) / 2 + s * d - a AS y, ((a + c) / 2 + s * d) / (a + c) AS share, m2, m3
  FROM roots, (VALUES (1, 1), (2, -1)) t(k, s)
), signed AS (
  SELECT *, x * f / sqrt(x * x + y * y) AS l2, y * f / sqrt(x * x + y * y) AS l3
  FROM (SELECT *, CASE WHEN (CASE WHEN abs(x) >= abs(y) THEN x ELSE y END) < 0 THEN -1 ELSE 1 END AS f FROM vectors)
)"""


@register(
    "principal_components",
    f"WITH {TWO} SELECT component::INTEGER AS component, sensor, {r('loading', 'loading')}, {r('variance', 'variance', 4)}, {r('share', 'share')} FROM ("
    "SELECT component, 'sensor_2' AS sensor, l2 AS loading, variance, share FROM signed UNION ALL "
    "SELECT component, 'sensor_3', l3, variance, share FROM signed) x",
)
def _(spark, folder):
    found = components.principal_components(T.telemetry(spark, folder), ["sensor_2", "sensor_3"], standardize=False)
    return rounded(found.table(spark), variance=4)


@register(
    "project_components",
    f"WITH {TWO} SELECT reading_id, {r('max(CASE WHEN component = 1 THEN score END)', 'component_1')}, {r('max(CASE WHEN component = 2 THEN score END)', 'component_2')} "
    "FROM (SELECT reading_id, component, (sensor_2 - m2) * l2 + (sensor_3 - m3) * l3 AS score FROM telemetry, signed) x GROUP BY reading_id",
)
def _(spark, folder):
    telemetry = T.telemetry(spark, folder)
    found = components.principal_components(telemetry, ["sensor_2", "sensor_3"], standardize=False)
    return rounded(found.project(telemetry).select("reading_id", "component_1", "component_2"))


def _dealt(source: str, columns: list[str]) -> str:
    """CTE ``dealt``: the rows of a table with the columns' values of other rows beside them."""
    given = ", ".join(f"o.{c} AS {c}_permuted" for c in columns)
    return f"""own AS (SELECT *, row_number() OVER (ORDER BY reading_id) AS place FROM {source}),
      other AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || reading_id), reading_id) AS place FROM {source}),
      dealt AS (SELECT own.*, {given} FROM own JOIN other o USING (place))"""


@register("permuted_columns", f"WITH {T.TELEMETRY}, {_dealt('telemetry', ['sensor_2', 'sensor_4'])} SELECT reading_id, sensor_2_permuted, sensor_4_permuted FROM dealt")
def _(spark, folder):
    dealt = permuted(T.telemetry(spark, folder).select("reading_id", "sensor_2", "sensor_4"), ["sensor_2", "sensor_4"], ["reading_id"])
    return dealt.select("reading_id", "sensor_2_permuted", "sensor_4_permuted")


def _scored(feature: str) -> str:
    """CTEs that lead the rows, with the feature's dealt values, down the splits that SQL has found."""
    name, depth = f"with_{feature}", trees.FOREST["max_depth"]
    ctes = [f"{name}_0 AS (SELECT * EXCLUDE ({feature}), {feature}_permuted AS {feature}, 1 AS node FROM dealt)"]
    ctes += [trees._step(f"{name}_{k + 1}", f"{name}_{k}", f"tree_b{k}") for k in range(depth)]
    ctes.append(f"{name} AS (SELECT sqrt(avg((y - p) ** 2)) AS rmse FROM {name}_{depth} JOIN leaves USING (node))")
    return ", ".join(ctes)


@register(
    "permutation_importance",
    f"WITH {trees.CELLS}, {trees.FOREST_SQL}, leaves AS (SELECT node, sum(s) / sum(n) AS p FROM tree_{trees.FOREST['max_depth']} GROUP BY node), "
    f"{trees.SCORED}, base AS (SELECT sqrt(avg((y - prediction) ** 2)) AS rmse FROM scored), {_dealt('leveled', trees.FEATURES)}, "
    + ", ".join(map(_scored, trees.FEATURES))
    + " "
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, {r(f'with_{f}.rmse - base.rmse', 'importance')} FROM base, with_{f}" for f in trees.FEATURES),
)
def _(spark, folder):
    run, table = trees._fit(spark, folder, models.FOREST, trees.FOREST)
    return rounded(importance.permutation_importance(run.model, store(table, "table"), run.features, ["reading_id"]))


def _expectations() -> str:
    """CTEs v0 ... v7: the tree's expectation for each cell when only a subset of the features is known (bit k: the k-th)."""
    depth, keys = trees.FOREST["max_depth"], ", ".join(trees.FEATURES)
    splits = " UNION ".join(f"SELECT node, feature, v FROM tree_b{k}" for k in range(depth))
    counts = " UNION ".join(f"SELECT node, sum(n) AS n FROM tree_{k} GROUP BY node" for k in range(depth + 1))
    ctes = [f"splits AS ({splits})", f"counts AS ({counts})"]
    ctes.append(
        "turns AS (SELECT node, feature, v, (SELECT n FROM counts l WHERE l.node = 2 * s.node) / (SELECT n FROM counts w WHERE w.node = s.node) AS goes_left FROM splits s)"
    )
    for known in range(8):
        listed = ", ".join(f"'{f}'" for k, f in enumerate(trees.FEATURES) if known >> k & 1) or "''"
        ctes.append(f"k{known}_0 AS (SELECT {keys}, 1 AS node, 1::DOUBLE AS w FROM cells)")
        for k in range(depth):
            before = f"k{known}_{k}"
            ctes.append(
                f"k{known}_{k + 1} AS (SELECT {keys}, node, w FROM {before} ANTI JOIN turns USING (node) "
                f"UNION ALL SELECT {keys}, 2 * node + CASE WHEN {trees.VALUE} <= v THEN 0 ELSE 1 END, w FROM {before} JOIN turns USING (node) WHERE feature IN ({listed}) "
                f"UNION ALL SELECT {keys}, 2 * node + side, w * CASE WHEN side = 0 THEN goes_left ELSE 1 - goes_left END "
                f"FROM {before} JOIN turns USING (node), (VALUES (0), (1)) t(side) WHERE feature NOT IN ({listed}))"
            )
        ctes.append(f"v{known} AS (SELECT {keys}, sum(w * p) AS v FROM k{known}_{depth} JOIN leaves USING (node) GROUP BY {keys})")
    return ", ".join(ctes)


def _share(i: int) -> str:
    """The Shapley value of the i-th of three features from the eight expectations."""
    weights = {0: "1 / 3.0::DOUBLE", 1: "1 / 6.0::DOUBLE", 2: "1 / 3.0::DOUBLE"}
    return " + ".join(f"(v{known | 1 << i}.v - v{known}.v) * ({weights[known.bit_count()]})" for known in range(8) if not known >> i & 1)


@register(
    "tree_attributions",
    f"WITH {trees.CELLS}, {trees.FOREST_SQL}, leaves AS (SELECT node, sum(s) / sum(n) AS p FROM tree_{trees.FOREST['max_depth']} GROUP BY node), {_expectations()} "
    f"SELECT {', '.join(trees.FEATURES)}, {r('v0.v', 'expected')}, " + ", ".join(r(_share(i), f"{f}_share") for i, f in enumerate(trees.FEATURES))
    + " FROM v0 " + " ".join(f"JOIN v{k} USING ({', '.join(trees.FEATURES)})" for k in range(1, 8)),
)
def _(spark, folder):
    """What each feature adds to the prediction for every combination of values."""
    run, table = trees._fit(spark, folder, models.FOREST, trees.FOREST)
    ready = models.prepare_model_input(table, run.features).distinct()
    for stage in run.model.stages[:-1]:
        ready = stage.transform(ready)
    shares = attribution.attributions(ready, run.model.stages[-1], run.features, mean=True)
    return rounded(shares.select(*run.features, "expected", *(f"{f}_share" for f in run.features)))


@register("attributions_add_up", f"WITH {T.LABELED} SELECT count(*) AS n, 0::BIGINT AS differ FROM labeled")
def _(spark, folder):
    """For how many readings the attributions and the expectation miss a boosted model's prediction."""
    run, table = trees._fit(spark, folder, models.LEAFWISE, {"n_estimators": 4, "num_leaves": 15, "learning_rate": 0.1, "random_state": 42})
    scored = run.model.transform(models.prepare_model_input(table, run.features))
    shares = attribution.attributions(scored, run.model.stages[-1], run.features, mean=False)
    total = sum((F.col(f"{f}_share") for f in run.features), F.col("expected"))
    close = F.abs(total - F.col("prediction")) <= 1e-9 * (1 + F.abs("prediction"))
    return shares.agg(F.count(F.lit(1)).alias("n"), F.count_if(~close).alias("differ"))

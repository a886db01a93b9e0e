"""Permutation importance: how much worse a model gets when a feature's values are dealt to other rows."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.learning.models import prepare_model_input
from fleetwane.operators.metrics import regression_metrics
from fleetwane.operators.permute import permuted
from fleetwane.schema import RUL
from fleetwane.session import store

#: Metrics of which more is better.
RISING = ("R2",)


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    *,
    metric: str = "RMSE",
    repeats: int = 1,
    seed: int = 42,
    parallel: int = 2,
) -> DataFrame:
    """(feature, importance): by how much the metric gets worse on average, most important first.

    In each repeat all features are dealt out by one seeded permutation of the rows, stored
    once; a job per feature then scores the table with that feature's dealt values. ``key``
    tells rows apart; reruns agree.
    """
    table = store(prepare_model_input(df, features, keep=[*key, RUL]), "inputs")
    spark, sign = df.sparkSession, -1.0 if metric in RISING else 1.0

    def measured(rows: DataFrame) -> float:
        return regression_metrics(model.transform(rows)).first()[metric]

    base, worse = measured(table), dict.fromkeys(features, 0.0)
    for repeat in range(repeats):
        dealt = store(permuted(table, features, key, seed=seed + repeat), "dealt")

        def drop(name: str, dealt: DataFrame = dealt) -> float:
            return measured(dealt.withColumn(name, F.col(f"{name}_permuted")).select(table.columns))

        with ThreadPoolExecutor(parallel) as pool:
            for name, value in zip(features, pool.map(inheritable_thread_target(spark)(drop), features)):
                worse[name] += sign * (value - base) / repeats
    rows = [(name, float(value)) for name, value in worse.items()]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

"""Principal components of sensors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.session import local_table


def gram_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, mean_a, mean_b, sxy) for all pairs a <= b of column positions, over rows without a missing or infinite value.

    Sums of products about the means, combined on the map side: one row per pair and task is
    shuffled, however many readings there are.
    """
    cells = [F.col(f"`{c}`").cast("double") for c in columns]
    whole = df.select(F.array(*cells).alias("x")).filter(F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    pairs = [(a, b) for a in range(len(columns)) for b in range(a, len(columns))]
    listed = F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs)))
    long = whole.select("x", listed).select("a", "b", F.get("x", F.col("a")).alias("u"), F.get("x", F.col("b")).alias("v"))
    return long.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.avg("u").alias("mean_a"), F.avg("v").alias("mean_b"), F.regr_sxy("v", "u").alias("sxy")
    )


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(sensor_a, sensor_b, covariance): sample covariances of complete rows, each pair once, the diagonal included."""
    names = F.array(*(F.lit(c) for c in columns))
    covariance = F.try_divide(F.col("sxy"), F.col("n") - 1)
    table = gram_table(df, columns)
    return table.select(F.get(names, F.col("a")).alias("sensor_a"), F.get(names, F.col("b")).alias("sensor_b"), covariance.alias("covariance"))


@dataclass(frozen=True)
class Components:
    """Loadings (a row per component), explained variances, and how columns are centred and scaled."""

    columns: tuple[str, ...]
    means: np.ndarray
    scales: np.ndarray
    variances: np.ndarray
    loadings: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        total = self.variances.sum()
        return self.variances / total if total > 0 else np.zeros_like(self.variances)

    def table(self, spark: SparkSession) -> DataFrame:
        """(component, sensor, loading, variance, share), components from 1 by falling variance."""
        rows = [
            (i + 1, name, float(self.loadings[i, j]), float(self.variances[i]), float(self.shares[i]))
            for i in range(len(self.variances))
            for j, name in enumerate(self.columns)
        ]
        return local_table(spark, rows, "component int, sensor string, loading double, variance double, share double")

    def project(self, df: DataFrame, *, prefix: str = "component_") -> DataFrame:
        """df with a column per component; NULL where a sensor is missing."""
        centred = [(F.col(f"`{c}`").cast("double") - float(m)) / float(s) for c, m, s in zip(self.columns, self.means, self.scales)]
        scores = {}
        for i, row in enumerate(self.loadings):
            score = F.lit(0.0)
            for value, weight in zip(centred, row):
                score = score + value * float(weight)
            scores[f"{prefix}{i + 1}"] = score
        return df.withColumns(scores)


def principal_components(df: DataFrame, columns: Sequence[str], *, k: int | None = None, standardize: bool = True) -> Components:
    """The ``k`` (all) components of the complete rows, of standardized sensors unless told otherwise.

    Only the matrix of columns times columns comes to the driver. A component's sign is such
    that its largest loading (the first of equals) is positive. Constant sensors have loading
    0 in standardized components; a table with fewer than two complete rows is an error.
    """
    p = len(columns)
    covariance, means, n = np.zeros((p, p)), np.zeros(p), 0
    for r in gram_table(df, columns).collect():  # p * (p + 1) / 2 rows
        n = r.n
        covariance[r.a, r.b] = covariance[r.b, r.a] = r.sxy / max(r.n - 1, 1)
        means[r.a], means[r.b] = r.mean_a, r.mean_b
    if n < 2:
        raise ValueError("principal components need two complete rows")
    spread = np.sqrt(np.diag(covariance))
    scales = np.where(spread > 0, spread, 1.0) if standardize else np.ones(p)
    values, vectors = np.linalg.eigh(covariance / np.outer(scales, scales))
    order = np.argsort(-values, kind="stable")[: k or p]
    loadings = vectors[:, order].T
    largest = np.abs(np.round(loadings, 12)).argmax(1)
    signs = np.where(loadings[np.arange(len(order)), largest] < 0, -1.0, 1.0)
    return Components(tuple(columns), means, scales, np.maximum(values[order], 0.0), loadings * signs[:, None])

"""Pearson correlation of all sensor pairs in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pair_table(df: DataFrame, sensors: Sequence[str], pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """(a, b, correlation) of the given pairs of sensor positions, pairwise complete.

    Each row meets a constant list of pairs inside the map task and is combined there, so
    one row per pair and task is shuffled. Hundreds of aggregates side by side would be
    too wide for compiled code. The regr_ sums use only rows where both sides are present,
    and a constant side gives 0, hence NULL; the built-in ``corr`` would fail on it in
    ANSI mode.
    """
    listed = F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs)))
    sums = (
        df.select(F.array(*(F.col(s).cast("double") for s in sensors)).alias("readings"))
        .select("readings", listed)
        .select("a", "b", F.get("readings", F.col("a")).alias("x"), F.get("readings", F.col("b")).alias("y"))
        .groupBy("a", "b")
        .agg(F.regr_sxy("y", "x").alias("xy"), F.regr_sxx("y", "x").alias("xx"), F.regr_syy("y", "x").alias("yy"))
    )
    ratio = F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy")))
    return sums.select("a", "b", ratio.alias("correlation"))


def _named(table: DataFrame, sensors: Sequence[str], first: str, second: str) -> DataFrame:
    names = F.array(*(F.lit(s) for s in sensors))
    return table.select(
        F.get(names, F.col(first)).alias("sensor_a"), F.get(names, F.col(second)).alias("sensor_b"), "correlation"
    )


def lower_triangle(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """(sensor_a, sensor_b, correlation) for each pair once, the later sensor first."""
    pairs = [(a, b) for b in range(len(sensors)) for a in range(b)]
    return _named(_pair_table(df, sensors, pairs), sensors, "b", "a")


def correlation_matrix(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """The full matrix in long form, the diagonal included (NULL for constant sensors)."""
    pairs = [(a, b) for b in range(len(sensors)) for a in range(b + 1)]
    sides = F.array(
        F.struct(F.col("a").alias("i"), F.col("b").alias("j")), F.struct(F.col("b").alias("i"), F.col("a").alias("j"))
    )
    mirrored = _pair_table(df, sensors, pairs).select(F.inline(F.array_distinct(sides)), "correlation")
    return _named(mirrored, sensors, "i", "j")


def redundant_pairs(df: DataFrame, sensors: Sequence[str], *, limit: float = 0.9) -> DataFrame:
    """Pairs whose absolute correlation exceeds ``limit``."""
    return lower_triangle(df, sensors).filter(F.abs("correlation") > limit)

"""Writing tables, importances, feature lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.schema import TIME, UNIT


def write_table(df: DataFrame, path: str, *, format: str = "parquet", mode: str = "overwrite", by_unit: int | None = None) -> str:
    """Write Parquet (default) or CSV with a header; folders are created.

    ``by_unit`` clusters the files: rows are range-partitioned by unit and cycle into
    that many tasks, so that a later lookup of one unit skips most files by their statistics.
    """
    if by_unit is not None:
        keys = [c for c in (UNIT, TIME) if c in df.columns]
        df = df.repartitionByRange(by_unit, *keys).sortWithinPartitions(*keys)
    writer = df.write.mode(mode)
    (writer.option("header", True).csv if format == "csv" else writer.parquet)(path)
    return path


def write_importances(importances: DataFrame, path: str, *, format: str = "csv") -> str:
    """feature, importance, largest first, in one file (one row per model feature)."""
    ordered = importances.orderBy(F.desc("importance"), "feature").coalesce(1)
    return write_table(ordered, path, format=format)


def write_feature_columns(spark: SparkSession, features: Sequence[str], path: str) -> str:
    """The ordered feature names as one JSON record."""
    one = spark.createDataFrame([(list(features),)], "features array<string>")
    one.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_feature_columns(spark: SparkSession, path: str) -> list[str]:
    return spark.read.schema("features array<string>").json(path).first()["features"]

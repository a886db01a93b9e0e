from __future__ import annotations

import math

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def same(actual, expected) -> bool:
    """Rows equal, doubles to 9 digits, in any order."""

    def norm(row):
        return tuple(
            None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 9) + 0.0 if isinstance(v, float) else v
            for v in row
        )

    def key(row):
        return tuple((v is not None, str(v)) for v in row)

    return sorted(map(norm, actual), key=key) == sorted(map(norm, expected), key=key)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

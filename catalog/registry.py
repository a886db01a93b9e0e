"""Registration of queries together with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round all doubles, so that the last bits of two engines do not matter.

    ``special`` names columns with other digits (large values have fewer exact decimals).
    """
    return df.select(
        *(
            F.round(F.col(f"`{c}`"), special.get(c, digits)).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        )
    )


def r(expression: str, name: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f'round({expression}, {digits}) + 0.0 AS "{name}"'

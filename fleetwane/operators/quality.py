"""Profiling for cleaning: NULLs, constant columns, table shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One row per column from a single aggregation over the table."""
    totals = df.agg(
        *(make(c).alias(f"{i}_{measure}") for i, c in enumerate(columns) for measure, make in measures.items())
    )
    entries = F.array(
        *(
            F.struct(F.lit(c).alias("column"), *(F.col(f"{i}_{m}").alias(m) for m in measures))
            for i, c in enumerate(columns)
        )
    )
    return totals.select(F.inline(entries))


def null_counts(df: DataFrame, *, dataset: str | None = None) -> DataFrame:
    """NULLs per column."""
    counts = per_column(df, df.columns, {"nulls": lambda c: F.count_if(F.col(c).isNull())})
    return counts if dataset is None else counts.select(F.lit(dataset).alias("dataset"), "*")


def table_info(df: DataFrame) -> DataFrame:
    """Type, non-null count and row count per column, with the column's position."""
    counts = per_column(
        df,
        df.columns,
        {"non_null": lambda c: F.count(F.col(c)), "rows": lambda c: F.count(F.lit(1))},
    )
    dtypes = {c: t for c, t in df.dtypes}
    position = {c: i for i, c in enumerate(df.columns)}
    return counts.select(
        _constant_map(position, "column").cast("int").alias("position"),
        "column",
        _constant_map(dtypes, "column").alias("type"),
        "non_null",
        "rows",
    )


def _constant_map(values: dict, key: str) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.col(key)]


def constant_column_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: whether it holds exactly one distinct value besides NULL.

    Smallest = largest value, which partial aggregates answer without a distinct count.
    """
    names = df.columns if columns is None else list(columns)
    return per_column(
        df,
        names,
        {"is_constant": lambda c: F.coalesce(F.min(F.col(c)) == F.max(F.col(c)), F.lit(False))},
    )


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the constant columns, in table order."""
    table = constant_column_table(df, columns).filter("is_constant")
    found = {row["column"] for row in table.collect()}
    return [c for c in df.columns if c in found]


def drop_constant_columns(train: DataFrame, *others: DataFrame) -> tuple[DataFrame, ...]:
    """Drop the columns that are constant in ``train`` from it and from the other tables."""
    names = constant_columns(train)
    return tuple(df.drop(*names) for df in (train, *others))

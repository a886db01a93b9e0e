"""Per-unit computations that survive a unit holding a large share of all rows.

Two tools:

``with_unit_aggregates``
    brings an aggregate of a unit back to each of its rows. The aggregate is combined
    on the map side, written once and joined as a table of known size (``join_per_unit``).

``over_units``
    evaluates *ordered* window expressions (rolling frames, lag) per unit. A window
    puts a whole partition group in one task, so units above ``hot_rows`` rows are cut
    into ordered segments first; each segment gets copies of the few rows before it
    that its first frames look back to. Results are identical to the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fleetwane.schema import TIME, UNIT
from fleetwane.session import store

# Values (rows x columns) of one unit that a single task may sort; larger units are cut into segments.
HOT_VALUES = 40_000_000

_SEGMENT, _ARRIVAL, _COPY, _RANK, _TARGETS = "__segment", "__arrival", "__copy", "__rank", "__targets"


def ascending(order: Sequence[str]) -> list[Column]:
    """Sort keys with missing values last, so that a row without a cycle is never a unit's first."""
    return [F.col(c).asc_nulls_last() for c in order]


def join_per_unit(df: DataFrame, per_unit: DataFrame, *, how: str = "left", unit: str = UNIT) -> DataFrame:
    """Join a table with one row per unit to the rows of a panel ('left', 'inner', 'left_semi').

    ``per_unit`` is computed once and stored, so its size in bytes is known: below the
    session's threshold it is broadcast and the panel is not shuffled. Above it both sides
    are scans that are shuffled by unit, and adaptive execution splits what a hot unit
    makes large (it could not if one side were an aggregate with that partitioning).
    """
    return df.join(store(per_unit, "per-unit"), unit, how)


def with_unit_aggregates(df: DataFrame, aggregates: Mapping[str, Column], *, unit: str = UNIT) -> DataFrame:
    """Add per-unit aggregates to every row; rows without a unit get NULL."""
    per_unit = (
        df.filter(F.col(unit).isNotNull())
        .groupBy(unit)
        .agg(*(expression.alias(name) for name, expression in aggregates.items()))
    )
    return join_per_unit(df, per_unit, unit=unit).select(*df.columns, *aggregates)


def first_n_per_unit(df: DataFrame, n: int, *, unit: str = UNIT, order: Sequence[str] = (TIME,)) -> DataFrame:
    """The first ``n`` rows of each unit in ``order``.

    Spark limits each group before the shuffle, so at most ``n`` rows per unit and map
    task travel, however long a unit is.
    """
    ranked = Window.partitionBy(unit).orderBy(*ascending(order))
    return (
        df.filter(F.col(unit).isNotNull())
        .withColumn(_RANK, F.row_number().over(ranked))
        .filter(F.col(_RANK) <= n)
        .drop(_RANK)
    )


def hot_units(df: DataFrame, *, unit: str = UNIT, hot_rows: int) -> DataFrame:
    """The stored table (unit, rows) of units with more than ``hot_rows`` rows; one aggregation over the unit column alone."""
    counts = df.filter(F.col(unit).isNotNull()).groupBy(unit).agg(F.count(F.lit(1)).alias("rows"))
    return store(counts.filter(F.col("rows") > hot_rows), "hot-units")


def over_units(
    df: DataFrame,
    ordered: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    lookback: int,
    per_unit: Mapping[str, Column] | None = None,
    head: Mapping[str, tuple[Callable[[Column], Column], str]] | None = None,
    head_rows: int = 0,
    unit: str = UNIT,
    order: Sequence[str] = (TIME,),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add per-unit columns to a panel with one shuffle.

    ordered
        name -> function of the ordered window of the unit; it may look at the current
        row and at most ``lookback`` rows before it.
    per_unit
        name -> aggregate over all rows of the unit.
    head
        name -> (aggregate function, column) over the first ``head_rows`` rows of the unit.

    Rows without a unit are dropped. Rows that tie in ``order`` come as they arrive (by
    partition of the input, then place in it), for units of any size.
    """
    per_unit, head = dict(per_unit or {}), dict(head or {})
    columns = df.columns
    df = df.filter(F.col(unit).isNotNull())
    rows_at_once = hot_rows or max(1, HOT_VALUES // len(columns))
    hot = hot_units(df, unit=unit, hot_rows=rows_at_once)
    many = hot.agg(F.sum("rows")).first()[0]
    df = df.withColumn(_ARRIVAL, F.monotonically_increasing_id())
    order = (*order, _ARRIVAL)
    if not many:
        return _whole_units(df, ordered, per_unit, head, head_rows, unit, order).drop(_ARRIVAL)

    keys = hot.select(unit)
    regular = _whole_units(df.join(keys, unit, "left_anti"), ordered, per_unit, head, head_rows, unit, order)
    split = _split_units(
        df.join(keys, unit, "left_semi"), ordered, lookback, per_unit, head, head_rows, unit, order, many, rows_at_once
    )
    return regular.unionByName(split).drop(_ARRIVAL)


def _whole_units(df, ordered, per_unit, head, head_rows, unit, order) -> DataFrame:
    whole = Window.partitionBy(unit)
    sequence = whole.orderBy(*ascending(order))
    columns = df.columns
    if head:
        df = df.withColumn(_RANK, F.row_number().over(sequence))
    return df.select(
        *columns,
        *(expression.over(whole).alias(name) for name, expression in per_unit.items()),
        *(
            aggregate(F.when(F.col(_RANK) <= head_rows, F.col(column))).over(whole).alias(name)
            for name, (aggregate, column) in head.items()
        ),
        *(build(sequence).alias(name) for name, build in ordered.items()),
    )


def _ranges(df: DataFrame, rows: int, rows_at_once: int) -> int:
    """Partitions that ``rows`` rows are sorted in: by their bytes, not one for each segment; small limits make many segments."""
    segments = math.ceil(2 * rows / rows_at_once)
    by_size = math.ceil(2 * rows * len(df.columns) / HOT_VALUES)
    return min(segments, max(by_size, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _split_units(df, ordered, lookback, per_unit, head, head_rows, unit, order, many, rows_at_once) -> DataFrame:
    columns = df.columns
    # Written once, so that the bounds of the segments stay fixed for the branches below.
    # Only rows of hot units come here. A row's place is its partition's number and its
    # place there, so segments are runs of places, of half the rows that a task may sort.
    sequence = order
    ranges = df.repartitionByRange(_ranges(df, many, rows_at_once), unit, *ascending(sequence))
    places = ranges.sortWithinPartitions(unit, *ascending(sequence)).withColumn(_SEGMENT, F.monotonically_increasing_id())
    segment = F.expr(f"{_SEGMENT} div {math.ceil(rows_at_once / 2)}L")
    rows = store(places.withColumn(_SEGMENT, segment), "segments")

    # The last rows of each segment, copied to the following segments that reach them.
    backwards = Window.partitionBy(unit, _SEGMENT).orderBy(*(F.col(c).desc_nulls_first() for c in sequence))
    following = Window.partitionBy(unit).orderBy(_SEGMENT, *ascending(sequence)).rowsBetween(1, max(lookback, 1))
    copies = (
        rows.withColumn(_RANK, F.row_number().over(backwards))
        .filter(F.col(_RANK) <= lookback)
        .withColumn(_TARGETS, F.array_distinct(F.collect_list(_SEGMENT).over(following)))
        .withColumn(_TARGETS, F.array_remove(_TARGETS, F.col(_SEGMENT)))
        .withColumn(_SEGMENT, F.explode(_TARGETS))
        .select(*rows.columns, F.lit(True).alias(_COPY))
    )
    in_segment = Window.partitionBy(unit, _SEGMENT).orderBy(*ascending(sequence))
    result = (
        rows.withColumn(_COPY, F.lit(False))
        .unionByName(copies)
        .select(*columns, _COPY, *(build(in_segment).alias(name) for name, build in ordered.items()))
        .filter(~F.col(_COPY))
        .drop(_COPY)
    )

    if per_unit:
        totals = rows.groupBy(unit).agg(*(expression.alias(name) for name, expression in per_unit.items()))
        result = join_per_unit(result, totals, unit=unit)
    if head:
        start = first_n_per_unit(rows, head_rows, unit=unit, order=sequence)
        firsts = start.groupBy(unit).agg(
            *(aggregate(F.col(column)).alias(name) for name, (aggregate, column) in head.items())
        )
        result = join_per_unit(result, firsts, unit=unit)
    return result.select(*columns, *per_unit, *head, *ordered)

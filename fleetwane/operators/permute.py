"""Seeded permutations of columns, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwane.session import store


def positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The stored table with the place (0, 1, 2, ...) of each row in a total order.

    Rows are sorted in ranges; a row's place is its place in its range plus the rows of the
    ranges before. Only one row per range meets in one task.
    """
    ready = store(df, "rows")  # a sort by range reads its input twice
    sorted_ = ready.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = store(sorted_.withColumn(name, F.monotonically_increasing_id()), "placed")
    part = F.shiftright(name, 33)
    sizes = placed.groupBy(part.alias("part of places")).agg(F.count(F.lit(1)).alias("rows of part"))
    before = F.sum("rows of part").over(Window.orderBy("part of places")) - F.col("rows of part")
    offsets = sizes.select("part of places", before.alias("rows before"))
    joined = placed.join(F.broadcast(offsets), part == F.col("part of places"))  # one row per range
    return joined.withColumn(name, F.col("rows before") + F.col(name).bitwiseAND((1 << 33) - 1)).select(*df.columns, name)


def permuted(df: DataFrame, columns: Sequence[str], key: Sequence[str], *, seed: int = 42, suffix: str = "_permuted") -> DataFrame:
    """df with the columns' values of other rows beside them: row i by key gets those of row i in seeded order.

    ``key`` tells rows apart. The columns move together, each value stays exactly as often as
    it is there.
    """
    own = positions(df, [F.asc_nulls_last(c) for c in key], "place")
    dealt = df.select(*(F.col(c).alias(f"{c}{suffix}") for c in columns), *(F.col(c).alias(f"{c}__key") for c in key))
    order = [F.col(f"{c}__key") for c in key]
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in order))
    other = positions(dealt.withColumn("drawn", F.md5(text)), [F.col("drawn"), *(F.asc_nulls_last(f"{c}__key") for c in key)], "place")
    return own.join(other.drop("drawn", *(f"{c}__key" for c in key)), "place").drop("place")

"""Distribution statistics: descriptions, exact percentiles, histograms, densities, boxes.

Columns are profiled together in long form (column, value). Percentiles are exact and
distributed: the built-in exact ``percentile`` keeps every distinct value of a column in
one task, which readings with billions of distinct values do not survive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from fleetwane.functions.health import null_if_nan
from fleetwane.operators.quality import per_column
from fleetwane.session import local_table

# Readings of one column that one task may sort; beyond that they are narrowed first.
SORTABLE = 1_000_000
# Approximate quantiles per narrowing pass, and their accuracy (rank error 1 / ACCURACY of the readings).
QUANTILES = 500
ACCURACY = 10_000


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of all non-missing readings."""
    doubles = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    return doubles.unpivot([], list(columns), "column", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _cell(value, low, high, cells: int):
    """The equal-width cell of a value in [low, high]; the last cell is closed."""
    share = (value - low) / (high - low)
    return F.when(low < high, F.least(F.floor(share * cells), F.lit(cells - 1))).otherwise(0).cast("int")


def _inside(values: DataFrame, cells: list[tuple]) -> DataFrame:
    """The readings inside the given (column, cell, low, high) intervals; at most one per wanted rank."""
    table = local_table(values.sparkSession, cells, "column string, cell int, low double, high double")
    return values.join(F.broadcast(table), "column").filter(F.col("value").between(F.col("low"), F.col("high")))


def _placed(counted: DataFrame, targets: list[tuple]) -> DataFrame:
    """The counted value that holds each (column, cell, rank, place)."""
    table = local_table(counted.sparkSession, targets, "column string, cell int, rank bigint, place bigint")
    upto = F.sum("n").over(Window.partitionBy("column", "cell").orderBy("value"))
    before = F.col("upto") - F.col("n")
    return (
        counted.withColumn("upto", upto)
        .join(F.broadcast(table), ["column", "cell"])
        .filter((F.col("place") >= before) & (F.col("place") < F.col("upto")))
    )


def order_statistics(
    values: DataFrame, ranks: dict[str, tuple[int, float, float, set[int]]], *, sortable: int = SORTABLE
) -> DataFrame:
    """(column, rank, value): exact order statistics, ranks counted from 0.

    ``ranks`` holds (count, smallest, largest, wanted ranks) per column. What ``narrowed``
    leaves around the wanted ranks is grouped by value and counted off. Equal readings are
    counted, never sorted, so copies of one value cost nothing.
    """
    cells, targets = _cells(narrowed(values, ranks, sortable=sortable))
    counted = _inside(values, cells).groupBy("column", "cell", "value").agg(F.count(F.lit(1)).alias("n"))
    return _placed(counted, targets).select("column", "rank", "value")


def narrowed(
    values: DataFrame, ranks: dict[str, tuple[int, float, float, set[int]]], *, sortable: int = SORTABLE
) -> dict[tuple[str, int], tuple[float, float, int, int]]:
    """(column, rank) -> (low, high, readings, place among them): intervals with at most ``sortable`` readings, or of one value.

    Each pass brackets a wanted rank between two approximate quantiles of the readings that
    are left, so it is their ranks that are cut, whatever their magnitudes. Then the readings
    below, at, between and above the two are counted exactly: the rank is on one of the two
    values, between them (a few thousandths of the readings), or, if the sketch was off, to
    one side. Every pass leaves fewer readings, so no number of passes is set.
    """
    found = {
        (column, rank): (low, high, n, rank)
        for column, (n, low, high, wanted) in ranks.items()
        for rank in wanted
    }
    while wide := {t: f for t, f in found.items() if f[2] > sortable and f[0] < f[1]}:
        cells, _ = _cells(wide)
        sketch = F.percentile_approx("value", [i / QUANTILES for i in range(QUANTILES + 1)], ACCURACY)
        sketches = _inside(values, cells).groupBy("column", "cell").agg(sketch.alias("q")).collect()  # one row per cell
        quantiles = {(r["column"], r["cell"]): r["q"] for r in sketches}
        numbers = {(column, low, high): number for column, number, low, high in cells}
        brackets = []
        for (column, rank), (low, high, n, place) in wide.items():
            number, at = numbers[column, low, high], place / n * QUANTILES
            q = quantiles[column, number]
            brackets.append((column, number, rank, place, q[max(0, math.floor(at) - 1)], q[min(QUANTILES, math.ceil(at) + 1)]))
        for row in _counted_brackets(values, cells, brackets).collect():  # one row per wanted rank
            found[row["column"], row["rank"]] = _followed(row)
    return found


def _counted_brackets(values: DataFrame, cells: list[tuple], brackets: list[tuple]) -> DataFrame:
    """Readings of each rank's interval below, at, between and above the ends ``a`` and ``b`` of its bracket."""
    schema = "column string, cell int, rank bigint, place bigint, a double, b double"
    table = local_table(values.sparkSession, brackets, schema)
    value, a, b = F.col("value"), F.col("a"), F.col("b")
    between = (value > a) & (value < b)
    return (
        _inside(values, cells)
        .join(F.broadcast(table), ["column", "cell"])
        .groupBy("column", "rank", "place", "a", "b")
        .agg(
            F.count_if(value < a).alias("below"),
            F.count_if(value == a).alias("at_a"),
            F.count_if(between).alias("inner"),
            F.count_if((value == b) & (a < b)).alias("at_b"),
            F.count_if(value > b).alias("above"),
            F.min("value").alias("low"),
            F.max(F.when(value < a, value)).alias("below_high"),
            F.min(F.when(between, value)).alias("inner_low"),
            F.max(F.when(between, value)).alias("inner_high"),
            F.min(F.when(value > b, value)).alias("above_low"),
            F.max("value").alias("high"),
        )
    )


def _followed(row: Row) -> tuple[float, float, int, int]:
    """The part of the interval that holds the wanted place."""
    parts = (
        (row["below"], row["low"], row["below_high"]),
        (row["at_a"], row["a"], row["a"]),
        (row["inner"], row["inner_low"], row["inner_high"]),
        (row["at_b"], row["b"], row["b"]),
        (row["above"], row["above_low"], row["high"]),
    )
    place = row["place"]
    for n, low, high in parts:
        if place < n:
            return low, high, n, place
        place -= n
    raise AssertionError("the wanted rank lies outside its interval")


def _cells(found: dict) -> tuple[list[tuple], list[tuple]]:
    """Distinct intervals with numbers, and the ranks wanted in each."""
    numbers: dict[tuple, int] = {}
    targets = []
    for (column, rank), (low, high, _, place) in found.items():
        number = numbers.setdefault((column, low, high), len(numbers))
        targets.append((column, number, rank, place))
    return [(column, number, low, high) for (column, low, high), number in numbers.items()], targets


def _moments(df: DataFrame, columns: Sequence[str]) -> list[Row]:
    """count, mean, std, min, max of each column: one aggregation over the wide table, one row per column."""
    reading = lambda c: null_if_nan(F.col(c).cast("double"))
    measures = {
        "count": lambda c: F.count(reading(c)),
        "mean": lambda c: F.avg(reading(c)),
        "std": lambda c: F.stddev_samp(reading(c)),
        "min": lambda c: F.min(reading(c)),
        "max": lambda c: F.max(reading(c)),
    }
    return per_column(df, columns, measures).collect()


def _interpolated(
    df: DataFrame, moments: Sequence[Row], probabilities: Sequence[float], sortable: int
) -> DataFrame:
    """(column, probability, value) given the counts and extremes of the columns."""
    ranks, wanted = {}, []
    for m in moments:
        if not m["count"]:
            continue
        positions = [(m["count"] - 1) * p for p in probabilities]
        ends = [(math.floor(x), math.ceil(x)) for x in positions]
        ranks[m["column"]] = (m["count"], m["min"], m["max"], {rank for pair in ends for rank in pair})
        wanted += [
            (m["column"], float(p), rank, x - low)
            for p, x, (low, high) in zip(probabilities, positions, ends)
            for rank in {low, high}
        ]
    schema = "column string, probability double, rank bigint, share double"
    table = local_table(df.sparkSession, wanted, schema)
    low, high = F.min("value"), F.max("value")
    return (
        order_statistics(long_values(df, list(ranks)), ranks, sortable=sortable)
        .join(F.broadcast(table), ["column", "rank"])
        .groupBy("column", "probability", "share")
        .agg((low + (high - low) * F.col("share")).alias("value"))
        .select("column", "probability", "value")
    )


def percentiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *, sortable: int = SORTABLE
) -> DataFrame:
    """(column, probability, value) with linear interpolation between neighbours."""
    return _interpolated(df, _moments(df, columns), probabilities, sortable)


def _quartiles(df: DataFrame, moments: Sequence[Row], sortable: int = SORTABLE) -> DataFrame:
    """(column, q1, median, q3)."""
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    return (
        _interpolated(df, moments, (0.25, 0.5, 0.75), sortable)
        .groupBy("column")
        .agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    )


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max of numeric columns."""
    moments = _moments(df, columns)
    schema = "column string, count bigint, mean double, std double, min double, max double"
    table = local_table(df.sparkSession, [tuple(m) for m in moments], schema)
    return table.join(F.broadcast(_quartiles(df, moments)), "column", "left").select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value and its frequency of text columns."""
    per_value = (
        df.select(*columns)
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_value.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def histogram(df: DataFrame, columns: Sequence[str], *, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins per column, empty bins included, last bin closed.

    A value belongs to the bin whose edges enclose it; the computed position is corrected
    where rounding put it next to an edge. A constant column gets the unit interval
    around its value. Infinite readings have no place in the bins; where there are any they
    are counted in bin -1 (up to the first edge) and bin ``bins`` (from the last edge), so
    that the counts of a column add up to its readings.
    """
    values = long_values(df, columns)
    infinite = F.abs("value") == float("inf")
    finite = F.when(~infinite, F.col("value"))
    pad = F.when(F.min(finite) == F.max(finite), 0.5).otherwise(0.0)
    extremes = values.groupBy("column").agg((F.min(finite) - pad).alias("low"), (F.max(finite) + pad).alias("high"))
    value, low, high = F.col("value"), F.col("low"), F.col("high")

    def edge(number):
        return low + (high - low) / bins * number

    near = _cell(value, low, high, bins)
    exact = near - (value < edge(near)).cast("int") + ((value >= edge(near + 1)) & (near < bins - 1)).cast("int")
    bin_ = F.when(infinite, F.when(value < 0, -1).otherwise(bins)).otherwise(exact)
    counts = (
        values.join(F.broadcast(extremes), "column")  # one row per profiled column
        .groupBy("column", bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    number = F.col("bin")
    start = F.when(number == -1, float("-inf")).when(number == bins, high).otherwise(edge(number))
    end = F.when(number == -1, low).when(number == bins, float("inf")).when(number == bins - 1, high).otherwise(edge(number + 1))
    numbers = extremes.withColumn("bin", F.explode(F.sequence(F.lit(-1), F.lit(bins))))
    edges = numbers.select("column", "bin", start.alias("bin_start"), end.alias("bin_end"))
    return (
        edges.join(counts, ["column", "bin"], "left")
        .filter(number.between(0, bins - 1) | F.col("n").isNotNull())
        .select("column", "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("n"))
    )


#: Width of a cell of the density in bandwidths, terms of its expansion, and how many bandwidths a cell reaches.
CELL, TERMS, REACH = 0.5, 12, 9


def kde_curve(df: DataFrame, columns: Sequence[str], *, points: int = 200) -> DataFrame:
    """Gaussian kernel density on a grid from smallest to largest value (Scott bandwidth).

    A fast Gauss transform: readings are summed up per cell of half a bandwidth, as moments
    t^k exp(-t^2 / 2) / k! of their distance t (in bandwidths) from the cell's middle, on the map
    side; a grid point at distance u then gets exp(-u^2 / 2) times the sum of moment k times
    u^k from each cell within reach. With |t| <= 1/4 the terms left out are below 1e-12 of a
    reading's peak, and what lies beyond the reach is below 3e-18. Only cells meet the grid,
    readings do not. Infinite readings have no place on the curve and are left out; a constant
    column has no density.
    """
    values = long_values(df, columns).filter(F.abs("value") < float("inf"))
    shape = values.groupBy("column").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.count(F.lit(1)).alias("n"),
        (F.stddev_samp("value") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("bandwidth"),
    )
    shape = shape.withColumn("step", F.try_divide(F.col("high") - F.col("low"), F.lit(points - 1)))
    low, bandwidth, step = F.col("low"), F.col("bandwidth"), F.col("step")
    place = F.try_divide(F.col("value") - low, bandwidth * CELL)
    t = (place - F.floor(place) - 0.5) * CELL
    moments = [F.sum(F.exp(t * t * -0.5) * F.pow(t, F.lit(float(k))) / math.factorial(k)).alias(f"m{k}") for k in range(TERMS)]
    cells = (
        values.join(F.broadcast(shape), "column")  # one row per profiled column
        .filter(bandwidth > 0)
        .groupBy("column", F.floor(place).alias("cell"))
        .agg(*moments)
        .join(F.broadcast(shape), "column")
    )
    middle = low + (F.col("cell") + 0.5) * CELL * bandwidth
    first = F.greatest(F.lit(0), F.ceil((middle - REACH * bandwidth - low) / step))
    last = F.least(F.lit(points - 1), F.floor((middle + REACH * bandwidth - low) / step))
    met = cells.filter(first <= last).withColumn("point", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    u = (low + step * F.col("point") - middle) / bandwidth
    power_sum = F.col(f"m{TERMS - 1}")
    for k in range(TERMS - 2, -1, -1):
        power_sum = power_sum * u + F.col(f"m{k}")
    sums = met.groupBy("column", "point").agg(F.sum(F.exp(u * u * -0.5) * power_sum).alias("weight"))
    grid = shape.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = F.col("n") * bandwidth * F.sqrt(F.lit(2.0) * F.pi())
    return grid.join(sums, ["column", "point"], "left").select(
        "column",
        "point",
        (low + step * F.col("point")).alias("x"),
        F.try_divide(F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)), scale).alias("density"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], *, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers, outliers beyond the fences, range, variance and skewness per column.

    A whisker ends at the last reading inside the fence, but never inside the box.
    """
    values = long_values(df, columns)
    spread = (F.col("q3") - F.col("q1")) * reach
    fences = _quartiles(df, _moments(df, columns)).select(
        "*", (F.col("q1") - spread).alias("fence_low"), (F.col("q3") + spread).alias("fence_high")
    )
    value = F.col("value")
    inside = value.between(F.col("fence_low"), F.col("fence_high"))
    return (
        values.join(F.broadcast(fences), "column")  # one row per profiled column
        .groupBy("column")
        .agg(
            F.any_value("q1").alias("q1"),
            F.any_value("median").alias("median"),
            F.any_value("q3").alias("q3"),
            F.least(F.min(F.when(inside, value)), F.any_value("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, value)), F.any_value("q3")).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
            (F.max(value) - F.min(value)).alias("range"),
            F.var_samp(value).alias("variance"),
            F.when(F.max(value) > F.min(value), F.skewness(value)).alias("skewness"),
        )
    )

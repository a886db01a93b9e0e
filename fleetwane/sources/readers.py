"""Reading sensor text, tables, labels."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwane.functions import health as H
from fleetwane.schema import (
    RUL,
    TELEMETRY_COLUMNS,
    TIME,
    UNIT,
    MissingTableError,
    column_type,
    is_known,
    require_columns,
)
from fleetwane.operators.columns import coerce_integer, drop_missing


def read_whitespace_text(spark: SparkSession, path: str, columns: Sequence[str] = TELEMETRY_COLUMNS) -> DataFrame:
    """Headerless text split on runs of whitespace, with names and types assigned by position.

    Leading, repeated and trailing blanks do not shift columns; a field that is not a
    number becomes NULL, as does NaN.
    """
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    fields = (
        spark.read.text(path).select(F.split(line, r"\s+").alias("fields"), line.alias("line")).filter("line <> ''")
    )

    def field(position: int, name: str):
        text = F.get("fields", F.lit(position))
        if name in (UNIT, TIME):
            return H.coerce_integer(text).alias(name)
        return H.null_if_nan(text.try_cast("double")).alias(name)

    return fields.select(*(field(i, name) for i, name in enumerate(columns)))


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; NaN becomes NULL.

    With a schema that is the schema. Without one the columns are read as text and one pass
    finds what each holds. Columns of the data model have their type (``column_type``) if
    every field can be read so. The others get the first type of the chain boolean, bigint,
    decimal, double (and beside it date and timestamp) that takes all their fields as they are
    written: whole numbers beyond bigint, or beyond a double's digits and mixed with fractions,
    become decimals; fields with leading zeros are no numbers. What nothing takes stays text,
    so that no field is lost. All files of a folder must have the same header.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is not None:
        df = existing(lambda: reader.schema(schema).csv(path), path)
        doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
        return df.select(*(H.null_if_nan(F.col(f"`{c}`")).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns))
    names = existing(lambda: spark.read.option("header", True).csv(path), path).columns
    text = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(path)
    if not names:
        return text
    seen = text.agg(*(_seen(c).alias(c) for c in names)).first()
    return text.select(*(_as_type(F.col(f"`{c}`"), c, seen[i]).alias(c) for i, c in enumerate(names)))


WHOLE, PLAIN = r"^[+-]?(0|[1-9][0-9]*)$", r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$"
NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|infinity)$"
DAY, MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
#: Whole numbers up to here are doubles without loss.
EXACT = 1 << 53
DIGITS = 38


def _seen(name: str) -> Column:
    """What the fields of a column rule out, in a form that merges: numbers of fields that a type does not take, and digits."""
    raw = F.col(f"`{name}`")
    field = F.when(~F.lower(raw).eqNullSafe("nan"), F.trim(raw))

    def lost(taken: Column) -> Column:
        return F.count_if(field.isNotNull() & ~F.coalesce(taken, F.lit(False)))

    if is_known(name):
        return F.struct(lost(_typed(raw, column_type(name)).isNotNull()).alias("model"))
    digits = F.regexp_replace(field, r"^[+-]", "")
    plain = field.rlike(PLAIN)
    fraction = F.when(plain, F.length(F.regexp_extract(field, r"\.([0-9]+)$", 1)))
    beyond = field.rlike(WHOLE) & (F.length(digits) > 15) & ~F.coalesce(F.abs(field.try_cast("decimal(38,0)")) <= EXACT, F.lit(False))
    return F.struct(
        F.count(field).alias("n"),
        lost(F.lower(field).isin("true", "false")).alias("boolean"),
        lost(field.rlike(WHOLE) & field.try_cast("bigint").isNotNull()).alias("bigint"),
        lost(plain).alias("plain"),
        lost(F.lower(field).rlike(NUMBER) & ~digits.rlike("^0[0-9]") & field.try_cast("double").isNotNull()).alias("double"),
        lost(field.rlike(DAY) & field.try_cast("date").isNotNull()).alias("date"),
        lost(field.rlike(MOMENT) & field.try_cast("timestamp_ntz").isNotNull()).alias("timestamp_ntz"),
        F.count_if(beyond).alias("beyond"),
        F.max(F.when(plain, F.length(F.regexp_extract(digits, r"^[0-9]+", 0)))).alias("whole_digits"),
        F.max(fraction).alias("fraction_digits"),
    )


def _as_type(field: Column, name: str, seen) -> Column:
    """The column with the first type that loses no field."""
    if is_known(name):
        return field if seen["model"] else _typed(field, column_type(name))
    text = F.when(~F.lower(field).eqNullSafe("nan"), F.trim(field))
    if seen["n"] == 0:
        return _typed(field, T.DoubleType())
    if not seen["boolean"]:
        return F.lower(text).try_cast("boolean")
    if not seen["bigint"]:
        return text.try_cast("bigint")
    if not seen["plain"] and seen["beyond"]:
        scale = seen["fraction_digits"] or 0
        return text.try_cast(f"decimal({DIGITS},{scale})") if seen["whole_digits"] + scale <= DIGITS else field
    if not seen["double"] and not seen["beyond"]:
        return _typed(field, T.DoubleType())
    for kind in ("date", "timestamp_ntz"):
        if not seen[kind]:
            return text.try_cast(kind)
    return field


def _typed(field: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return field
    if isinstance(kind, T.DoubleType):
        return H.null_if_nan(field.try_cast("double"))
    return H.coerce_integer(field).cast(kind)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV, by the name of the path."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv_table(spark, path)
    return existing(lambda: spark.read.parquet(path), path)


def existing(read: Callable[[], DataFrame], path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTableError(f"no table at {path}") from error
        raise


def read_required(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """A table that must exist and have the required columns."""
    return require_columns(read_table(spark, path), required)


def read_or_skip(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame | None:
    """A table that may be missing or unusable: None then."""
    try:
        return require_columns(read_table(spark, path), required, mode="none")
    except MissingTableError:
        return None


def read_first_existing(spark: SparkSession, paths: Sequence[str], required: Iterable[str] = (UNIT, RUL)) -> DataFrame | None:
    """The first path that exists and has the required columns; None if there is none."""
    needed = tuple(required)
    for path in paths:
        df = read_or_skip(spark, path, needed)
        if df is not None:
            return df
    return None


def read_sensor_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table as the views need it: whole-number keys, none missing."""
    return drop_missing(coerce_integer(read_required(spark, path, (UNIT, TIME))))


def read_positional_labels(spark: SparkSession, path: str, *, value: str = RUL) -> DataFrame:
    """(unit, RUL) from a one-column text file in which line i belongs to unit i.

    Lines are numbered inside each block of the file, then shifted by the lines of the
    blocks before it, so no task sees more than one block.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.trim("value").alias("text"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
        .filter("text <> ''")
    )
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    # One row per file block.
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = blocks.select("file", "block", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("place"))
    numbered = lines.withColumn("line", inside).join(offsets, ["file", "block"])
    return numbered.select(
        (F.col("before") + F.col("line")).cast("bigint").alias(UNIT), H.coerce_integer(F.col("text")).alias(value)
    )


def cached(df: DataFrame) -> DataFrame:
    """Keep a table for repeated queries; call ``unpersist()`` when done."""
    return df.persist()

"""What the corpus operators share: words in Spark and in NumPy, folds, and the package on executors.

A word is a run of characters other than space, tab, newline, vertical tab, form feed and
carriage return. Texts that are null count as empty.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WORD_BREAK = r"[ \t-\r]+"

#: Characters of text that one NumPy pass works on at a time (a longer text is a pass of its own).
CHUNK_CHARS = 1 << 18

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64
_FACTOR = pow(0x9E3779B97F4A7C15, 1, 1 << 64) | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.int64).view(_U)


# ---------------------------------------------------------------- Spark side


def whole(text: str | Column) -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The array of words of a non-null text."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_BREAK))


def n_words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, WORD_BREAK))).cast("long")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as the table has such a column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


#: Rows of an Arrow batch, instead of Spark's default of 10,000: a batch of long texts must fit a task's memory several times.
BATCH_ROWS = 2048
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that tasks import it wherever they run; bound batches if the session does not."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if getattr(context, "_fleetwane_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="fleetwane-"), "fleetwane_tasks.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _mark(context)


def _mark(context: SparkContext) -> None:
    context._fleetwane_shipped = True


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers for later stages, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def over_batches(df: DataFrame, task, schema: str) -> DataFrame:
    """``task``: iterator of Arrow batches -> iterator of dicts of columns, one per piece of output."""
    ship(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in task(batches):
            values = [columns[field.name] for field in arrow]
            arrays = [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(values, arrow)]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        give_back()

    return df.mapInArrow(run, schema)


def text_udf(function, schema: str):
    """A column function of a text: ``function`` maps a list of texts to lists by column name.

    Nulls come as empty texts; the result is a struct of ``schema``. At the end of a task
    ``function.close`` is called, if there is one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = function([t or "" for t in texts.to_pylist()])
            yield pa.StructArray.from_arrays([pa.array(columns[field.name], type=field.type) for field in arrow], fields=list(arrow))
        getattr(function, "close", lambda: None)()
        give_back()

    return run


# ---------------------------------------------------------------- NumPy side


def chunks(texts: list[str], most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` texts, of about CHUNK_CHARS characters together."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) + 1
        if held >= CHUNK_CHARS or i + 1 - start >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of some texts: where they are, and a 64-bit hash of each.

    ``first[i]`` is the index of the first word of text i; ``first[-1]`` the number of words.
    """

    def __init__(self, texts: list[str], lower: bool = False):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.bytes = b"\n".join(parts) + b"\n"
        raw = np.frombuffer(self.bytes, np.uint8)
        if lower:
            raw = _LOWER[raw]
        self.raw = raw
        space = _IS_SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        self.text_starts = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.starts, self.text_starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        n = len(self.raw)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.concatenate((np.ones(1, _U), np.full(n - 1, _FACTOR, _U))))
            total = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE_VALUES[self.raw] * powers)))
            back = np.cumprod(np.concatenate((np.ones(1, _U), np.full(n - 1, _INVERSE, _U))))
            return mix((total[self.ends] - total[self.starts]) * back[self.starts] + (self.ends - self.starts).astype(_U))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finisher of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive hashes, across text ends as well."""
    if len(hashes) < size:
        return np.zeros(0, _U)
    out = np.zeros(len(hashes) - size + 1, _U)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * _U(_FACTOR) + hashes[i : i + len(out)]
    return mix(out)

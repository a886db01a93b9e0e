"""Session helpers: durable scratch storage for tables that must be written once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables that are stored inside are removed at the end; results must be written or collected before."""
    folder = f"{scratch_dir(spark)}/scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset (local
    tests) a temporary folder is created and remembered in the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("fleetwane.scratch.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="fleetwane-")
        spark.conf.set("fleetwane.scratch.dir", folder)
    return folder.rstrip("/")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table.

    The result no longer depends on the plan above it, so values such as partition
    numbers stay fixed when executors are lost later.
    """
    path = f"{_SCOPE.get() or scratch_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table made on the driver, known to the optimizer with its exact size."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)

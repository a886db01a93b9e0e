"""Train/test splits that stay the same under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.schema import TIME, UNIT

SEED = 42
TEST_SHARE = 0.2


def is_test(key: Sequence[str], *, share: float = TEST_SHARE, seed: int = SEED) -> Column:
    """True for about ``share`` of the keys, chosen by a hash of the key and the seed."""
    text = F.concat_ws("-", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key), F.lit(str(seed)))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    return bucket < int(round(share * 10_000))


def mark_split(df: DataFrame, key: Sequence[str], *, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``is_test``."""
    return df.withColumn("is_test", is_test(key, share=share, seed=seed))


def split_rows(
    df: DataFrame, *, key: Sequence[str] = (UNIT, TIME), share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by row."""
    test = is_test(key, share=share, seed=seed)
    return df.filter(~test), df.filter(test)


def split_units(df: DataFrame, *, share: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) with all rows of a unit on the same side."""
    return split_rows(df, key=(UNIT,), share=share, seed=seed)

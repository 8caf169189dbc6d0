"""Duplicate removal as plain aggregation.

Both forms combine on the map side first, so a row or key that makes up a third
of the table leaves each map task once and never piles up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key: the largest by all other columns, NULLs last.

    A fixed choice makes re-runs repeatable, and preferring non-NULL values
    keeps the more complete row.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.dropDuplicates()
    kept = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return kept.select(*[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in df.columns])

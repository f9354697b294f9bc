"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep, for each key, the smallest row by the other columns in order.

    Nulls come first in that order, and null keys form one group. The minimum
    combines on the map side, so a key with very many copies leaves each map task
    as a single row, and a task that runs again picks the same row.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    smallest = F.min(F.struct(*others)).alias("smallest")
    return (
        df.groupBy(*keys)
        .agg(smallest)
        .select(*[name if name in keys else f"smallest.{name}" for name in df.columns])
    )

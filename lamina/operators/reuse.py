"""A frame that several actions read is computed once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` in memory, and on disk beyond it, until the block ends.

    Blocks of a lost executor are computed again from the lineage. Select the
    columns that the actions need before, since the whole frame is kept.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held.count()
        yield held
    finally:
        held.unpersist()

"""Columns that must not meet the caller's."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
HASHED_LISTS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session has `value` in the block, and its own setting again at the end of it."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs in the block hands Python at most so many rows at once.

    A batch is held whole on both sides, so its rows times their size must stay small where
    they carry texts.
    """
    before = int(spark.conf.get(BATCH_ROWS))
    with _setting(spark, BATCH_ROWS, str(min(before, rows) if before > 0 else rows)):
        yield


@contextmanager
def hashed_lists(spark: SparkSession, keys: int) -> Iterator[None]:
    """What runs in the block collects lists of up to so many keys a task by hashing.

    Beyond them, and beyond the 128 of the default, a task sorts its rows by their keys
    first. The lists are in memory either way while they are made, one by one then.
    """
    before = int(spark.conf.get(HASHED_LISTS))
    with _setting(spark, HASHED_LISTS, str(max(before, keys))):
        yield


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose `doc_id` is not in the one column of `ids`; null ids stay."""
    name = fresh_name(docs, "dropped")
    gone = ids.toDF(name).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def packed(docs: DataFrame, *own: str) -> DataFrame:
    """The columns `own`, and all others in a struct `rest`."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    rest = F.struct(*others) if others else F.lit(None).cast("struct<none:int>")
    return docs.select(*own, rest.alias("rest"))


def unpacked(rows: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """`columns` in their order, those not in `own` from the struct `rest`."""
    return rows.select(*[F.col(c if c in own else f"rest.`{c}`").alias(c) for c in columns])

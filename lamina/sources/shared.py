"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lamina.sources.files import write_files
from lamina.sources.versions import discard, files_of


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Where that is unset, as in a test, it is a folder below the warehouse. That is shared by
    all executors if they run in the driver or if it is on a common store; a folder of the
    driver's own machine is refused on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = warehouse.startswith(("file:", "/"))
    if own_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_intermediate"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, removed when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    files, folder = files_of(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that `fresh_path` made."""
    discard(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Run `df` now, keep the result as a shared table and return that table.

    This cuts the lineage: later steps read files and survive lost executors. The
    table lasts as long as the application, for frames that are run later; where the
    work ends before the function returns, `held` removes it sooner.
    """
    path = fresh_path(df.sparkSession, label)
    write_files(df, f"{path}/rows")
    return df.sparkSession.read.parquet(f"{path}/rows")


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`stored`, removed at the end of the block."""
    path = fresh_path(df.sparkSession, label)
    try:
        write_files(df, f"{path}/rows")
        yield df.sparkSession.read.parquet(f"{path}/rows")
    finally:
        remove_path(df.sparkSession, path)

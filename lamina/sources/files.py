"""Raw files and layer tables, addressed by path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from lamina.sources.versions import current_path, discard, new_version, publish

#: The column that names the folder of a batch.
BATCH_FOLDER = "loaded_batch"

# The formats that are nothing but files in a folder.
FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro", "text"}


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, unreadable: str | None = None
) -> DataFrame:
    """CSV files with a header row.

    Without a schema Spark reads the whole input once more to infer the types. With
    one, a file whose header names other columns or another order is refused, and the
    column `unreadable`, if it is named, keeps the text of each record that has a value
    of another type or a wrong number of values; it is null for all others.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    reader = reader.option("enforceSchema", False)
    if unreadable is None:
        return reader.schema(schema).csv(path)
    reader = reader.option("columnNameOfCorruptRecord", unreadable)
    return reader.schema(f"{schema}, {unreadable} STRING").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header row that read back as written, padding included."""
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("overwrite")
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """The table at `path` as it is now: its current version, or the plain files there.

    The frame keeps to that version, whatever replaces the table later.
    """
    if table_format in FILE_FORMATS:
        path = current_path(spark, path)
    return spark.read.format(table_format).load(path)


def write_table(df: DataFrame, path: str, table_format: str = "parquet") -> int:
    """Replace the table at `path` and return the number of rows written.

    The rows are counted while they are written, so there is no second pass. Plain files
    become a new version of the table, which readers see when it is whole: a job that fails
    leaves the table as it was, and a table may be read and replaced in one step. Formats
    with transactions of their own replace in place.
    """
    spark = df.sparkSession
    if table_format not in FILE_FORMATS:
        return _counted(df, lambda counted: counted.write.format(table_format).mode("overwrite").save(path))
    version = new_version(spark, path)
    try:
        rows = write_files(df, version, table_format)
    except BaseException:
        discard(spark, version)
        raise
    publish(spark, version)
    return rows


def write_files(df: DataFrame, path: str, table_format: str = "parquet") -> int:
    """Write to a folder that does not exist yet; returns the number of rows."""
    return _counted(df, lambda counted: counted.write.format(table_format).save(path))


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    written = Observation()
    write(df.observe(written, F.count(F.lit(1)).alias("rows")))
    return written.get["rows"]


def write_batch(df: DataFrame, path: str, batch: str, table_format: str = "parquet") -> int:
    """Put the rows of one batch into a table of batches, in place of an earlier load of it.

    The table has a folder a batch, and only that folder is replaced, however often a
    batch is loaded again. Rows keep their columns; `BATCH_FOLDER` is added.
    """
    named = df.withColumn(BATCH_FOLDER, F.lit(batch))
    return _counted(
        named,
        lambda counted: counted.write.format(table_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_FOLDER)
        .save(path),
    )

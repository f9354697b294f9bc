"""Raw files to bronze tables with lineage columns, and their validation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.model import AUDIT_COLUMNS, DATASETS, DEFAULT_BATCH_ID, RAW_SCHEMAS, UNREADABLE, Layers
from lamina.plans.together import together
from lamina.sources import BATCH_FOLDER, read_csv, read_table, write_batch, write_table


def with_audit_columns(df: DataFrame, source: str, batch_id: str) -> DataFrame:
    """Add where each row comes from and when it was read."""
    values = (F.lit(source), F.lit(batch_id), F.current_timestamp(), _source_file(df))
    return df.withColumns(dict(zip(AUDIT_COLUMNS, values, strict=True)))


def _source_file(df: DataFrame) -> Column:
    """The file path from the scan; a frame that is no plain scan lacks it and is refused."""
    path = F.col("_metadata.file_path")
    try:
        _ = df.select(path).schema
    except AnalysisException as error:
        raise ValueError("lineage columns need a frame that is read from files") from error
    return path


def ingest_dataset(
    spark: SparkSession,
    dataset: str,
    layers: Layers,
    batch_id: str = DEFAULT_BATCH_ID,
    infer_types: bool = False,
) -> int:
    """Load one raw dataset into its bronze table; returns the number of rows.

    With the declared types a value of another type is null, in a row that stays and
    keeps the text of its record; `rejects` counts such rows. Inferring the types reads
    the files twice and takes them as they come.
    """
    schema = None if infer_types else RAW_SCHEMAS[dataset]
    raw = read_csv(spark, layers.raw_file(dataset), schema, UNREADABLE)
    bronze = with_audit_columns(raw, dataset, batch_id)
    if not infer_types:
        others = [name for name in bronze.columns if name != UNREADABLE]
        bronze = bronze.select(*others, UNREADABLE)
    return write_table(bronze, f"{layers.bronze}/{dataset}", layers.table_format)


def ingest_all(
    spark: SparkSession,
    layers: Layers,
    batch_id: str = DEFAULT_BATCH_ID,
    infer_types: bool = False,
) -> dict[str, int]:
    """Load every raw dataset; returns the number of rows of each."""
    return together(
        spark,
        DATASETS, lambda name: ingest_dataset(spark, name, layers, batch_id, infer_types)
    )


def load_batch(
    spark: SparkSession, dataset: str, layers: Layers, batch_id: str, raw: str | None = None
) -> int:
    """Load one batch of a dataset beside those of other batches; returns its rows.

    Loading a batch again replaces what it loaded before and nothing else, so a job that
    failed or was given twice is simply run again. `raw` names the batch's files, if they
    are not the dataset's raw files.
    """
    files = read_csv(spark, raw or layers.raw_file(dataset), RAW_SCHEMAS[dataset], UNREADABLE)
    rows = with_audit_columns(files, dataset, batch_id)
    return write_batch(rows, f"{layers.bronze}/{dataset}_batches", batch_id, layers.table_format)


def read_batches(spark: SparkSession, dataset: str, layers: Layers) -> DataFrame:
    """The rows of all batches of a dataset, without the column of their folders."""
    path = f"{layers.bronze}/{dataset}_batches"
    return spark.read.format(layers.table_format).load(path).drop(BATCH_FOLDER)


def rejects(spark: SparkSession, dataset: str, layers: Layers) -> DataFrame:
    """One row: dataset, its rows, and those with a record that could not be read as declared."""
    df = read_table(spark, f"{layers.bronze}/{dataset}", layers.table_format)
    kept = F.col(UNREADABLE) if UNREADABLE in df.columns else F.lit(None)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count(kept).alias("unreadable_rows")
    ).select(F.lit(dataset).alias("dataset"), "row_count", "unreadable_rows")


def missing_audit_columns(df: DataFrame) -> list[str]:
    return [name for name in AUDIT_COLUMNS if name not in df.columns]


def validate_dataset(spark: SparkSession, dataset: str, layers: Layers) -> DataFrame:
    """The validation row of a bronze table; fails if lineage columns are missing."""
    df = read_table(spark, f"{layers.bronze}/{dataset}", layers.table_format)
    missing = missing_audit_columns(df)
    if missing:
        raise ValueError(f"{dataset} lacks lineage columns: {', '.join(missing)}")
    return validation_row(df, dataset)


def validation_row(df: DataFrame, dataset: str) -> DataFrame:
    """One row: dataset, number of rows, missing lineage columns, passed or not."""
    missing = missing_audit_columns(df)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        F.lit(", ".join(missing)).alias("missing_columns"),
        F.lit(not missing).alias("passed"),
    )


def schema_report(df: DataFrame, dataset: str) -> DataFrame:
    """One row per column: its place, its type and how many rows have a value.

    All columns are counted in one pass; only the one-row result is turned.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(field.name).alias(field.name) for field in df.schema],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(place).alias("column_position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col(field.name).alias("value_count"),
            )
            for place, field in enumerate(df.schema, start=1)
        ]
    )
    return counted.select(
        F.lit(dataset).alias("dataset"), "row_count", F.inline(described)
    )

"""Bronze tables to silver tables: one row per key, standard strings, valid rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.functions import as_number, line_total, lowered, positive, present, titled, trimmed
from lamina.model import DATASETS, KEYS, PROCESSED_AT, RAW_SCHEMAS, UNREADABLE, Layers
from lamina.operators.dedupe import smallest_per_key
from lamina.plans.settings import bounded_session
from lamina.plans.together import together
from lamina.sources import read_table, write_table


@dataclass(frozen=True)
class Cleaning:
    """What makes a row of one dataset trustworthy."""

    trim: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    title: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    above_zero: tuple[str, ...] = ()
    recompute_total: bool = False


# Products may keep one row without a key; the other three datasets may not.
CLEANING = {
    "products": Cleaning(
        trim=("product_name", "brand"),
        lower=("category",),
        above_zero=("unit_price",),
    ),
    "customers": Cleaning(
        title=("first_name", "last_name", "city", "province"),
        lower=("email",),
        required=("customer_id", "email"),
    ),
    "orders": Cleaning(
        lower=("order_status", "payment_method"),
        required=("order_id", "customer_id", "store_id"),
        above_zero=("total_amount", "item_count"),
    ),
    "order_items": Cleaning(
        required=("order_item_id", "order_id", "product_id"),
        above_zero=("quantity", "unit_price", "line_total"),
        recompute_total=True,
    ),
}


def clean(df: DataFrame, dataset: str) -> DataFrame:
    """Deduplicate, standardise, recompute, filter and stamp, in this order.

    Columns get their declared types before. Duplicates go first, so a bad copy that survives takes its key with it, and
    the filters see the cleaned values.
    """
    rules = CLEANING[dataset]
    single = smallest_per_key(typed(df, dataset), [KEYS[dataset]])
    cleaned = standardise(single, rules)
    if rules.recompute_total:
        cleaned = recompute_line_total(cleaned)
    return cleaned.filter(present(*rules.required)).filter(
        positive(cleaned, *rules.above_zero)
    ).withColumn(PROCESSED_AT, F.current_timestamp())


def typed(df: DataFrame, dataset: str) -> DataFrame:
    """The declared types, whatever the files were read as; what does not fit is null.

    So one bad value cannot turn a column, and all that is computed from it, into text.
    The text of unreadable records stays in bronze.
    """
    declared = {f.name: f.dataType for f in StructType.fromDDL(RAW_SCHEMAS[dataset])}
    found = {field.name: field.dataType for field in df.schema}
    return df.drop(UNREADABLE).withColumns(
        {
            name: F.col(name).try_cast(kind)
            for name, kind in declared.items()
            if name in found and found[name] != kind
        }
    )


def standardise(df: DataFrame, rules: Cleaning) -> DataFrame:
    """Trim and change case where the rules say so."""
    return df.withColumns(
        {
            **{name: trimmed(name) for name in rules.trim},
            **{name: lowered(name) for name in rules.lower},
            **{name: titled(name) for name in rules.title},
        }
    )


def recompute_line_total(df: DataFrame) -> DataFrame:
    """Replace the delivered line total by quantity times price."""
    total = line_total(as_number(df, "quantity"), as_number(df, "unit_price"))
    return df.withColumn("line_total", total)


def process_dataset(spark: SparkSession, dataset: str, layers: Layers) -> int:
    """Clean one bronze table into its silver table; returns the number of rows.

    Finding one row per key sorts the whole rows that a task has read, so tasks are bounded.
    """
    path = f"{layers.bronze}/{dataset}"
    bronze = read_table(bounded_session(spark, path), path, layers.table_format)
    return write_table(
        clean(bronze, dataset), f"{layers.silver}/{dataset}", layers.table_format
    )


def process_all(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """Clean every bronze table; returns the number of rows of each silver table."""
    return together(spark, DATASETS, lambda name: process_dataset(spark, name, layers))

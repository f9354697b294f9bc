"""Tables at a glance: rows, partitions and counts or top rows in one frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lamina.operators.gold import count_per_key, count_rows, sales_per_category, top_days


def _lines(df: DataFrame, part: str, label, value) -> DataFrame:
    return df.select(
        F.lit(part).alias("part"),
        label.cast("string").alias("label"),
        value.cast("double").alias("value"),
    )


def _size(df: DataFrame) -> DataFrame:
    """Rows of the frame, and the partitions that its scan and steps make."""
    partitions = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    rows = _lines(count_rows(df, "rows"), "size", F.col("dataset"), F.col("row_count"))
    counted = partitions.agg(F.count(F.lit(1)).alias("n"))
    return rows.unionAll(_lines(counted, "size", F.lit("partitions"), F.col("n")))


def products_profile(products: DataFrame) -> DataFrame:
    """`part`, `label`, `value`: rows, partitions with rows, and products per category."""
    counts = count_per_key(products, "category")
    return _size(products).unionAll(
        _lines(counts, "category", F.col("category"), F.col("row_count"))
    )


def gold_profile(daily: DataFrame, rows: int = 20) -> DataFrame:
    """The same for the daily sales: totals per category, and the days with most sales."""
    totals = sales_per_category(daily)
    best = top_days(daily, rows)
    day = F.concat_ws(" ", F.col("order_date").cast("string"), "category")
    return (
        _size(daily)
        .unionAll(_lines(totals, "category", F.col("category"), F.col("category_total_sales")))
        .unionAll(_lines(best, "day", day, F.col("total_sales")))
    )


#: Bits of the address in a sketch of distinct values, and items of a sketch of quantiles.
DISTINCT_BITS, QUANTILE_ITEMS = 14, 4096
#: Four standard errors of an estimated number of distinct values, and twice the rank error
#: that a quantile keeps to with 99 %, both by the formulas known for these sketches.
DISTINCT_ERROR = 4 * 0.8326 / 2 ** (DISTINCT_BITS / 2)
QUANTILE_ERROR = 2 * 2.296 / QUANTILE_ITEMS**0.9021


def column_sketches(df: DataFrame, *columns: str) -> DataFrame:
    """`column_name`, `row_count`, `value_count` and the sketches of each column, in one pass.

    `distinct` estimates the number of values, `quantiles` those of numbers; both are of a
    fixed size and can be merged with those of other batches.
    """
    kinds = {field.name: field.dataType for field in df.schema}
    counts = [F.count(F.lit(1)).alias("rows")]
    for name in columns:
        value = F.col(f"`{name}`")
        text = value.cast("string")
        counts += [
            F.count(value).alias(f"{name}_n"),
            F.hll_sketch_agg(text, DISTINCT_BITS).alias(f"{name}_d"),
            (
                F.expr(f"kll_sketch_agg_double(cast(`{name}` as double), {QUANTILE_ITEMS})")
                if isinstance(kinds[name], NumericType)
                else F.lit(None).cast("binary")
            ).alias(f"{name}_q"),
        ]
    described = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"{name}_n").alias("value_count"),
                F.col(f"{name}_d").alias("distinct"),
                F.col(f"{name}_q").alias("quantiles"),
            )
            for name in columns
        ]
    )
    return df.agg(*counts).select(F.inline(described))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The stored sketches of several batches as those of all their rows."""
    return sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("value_count").alias("value_count"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"kll_merge_agg_double(quantiles, {QUANTILE_ITEMS})").alias("quantiles"),
    )


def sketched_profile(sketches: DataFrame, *ranks: float) -> DataFrame:
    """`column_name`, its rows, values, estimated `distinct_values`, and `quantiles` by rank."""
    asked = F.array(*[F.lit(rank) for rank in ranks])
    return sketches.select(
        "column_name",
        "row_count",
        "value_count",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(
            F.call_function("kll_sketch_get_n_double", "quantiles") > 0,
            F.call_function("kll_sketch_get_quantile_double", "quantiles", asked),
        ).alias("quantiles"),
    )

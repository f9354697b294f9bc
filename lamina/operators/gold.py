"""Silver tables joined and aggregated into gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from lamina.model import AMOUNT, DAILY_SALES, Layers
from lamina.plans.settings import bounded_session
from lamina.sources import read_table, stored, write_table


def join_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join by a shared column, which appears once.

    Where both sides have another column of the same name (lineage columns, unit
    price), the left one stays; the result can be selected from and stored.
    """
    clashing = [name for name in right.columns if name in left.columns and name != key]
    return left.join(right.drop(*clashing), key, "inner")


def joined_sales(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per sold item with its order, its product and the day of the order."""
    with_items = join_on(orders, items, "order_id")
    return join_on(with_items, products, "product_id").withColumn(
        "order_date", F.to_date("order_timestamp")
    )


def daily_sales(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    orders_are_unique: bool = False,
) -> DataFrame:
    """Sales, items sold and orders per day and category.

    Items find their category first and are summed per order and category before
    they meet the orders. This sum combines on the map side, so an order or a
    category with a large share of all items is small before it is shuffled; a
    product with a large share is joined by broadcast, or split by the adaptive
    skew join, which may act here because no step above needs its partitioning.

    After that sum an order has one row per category. If no order id comes twice
    in `orders`, as in a silver table, counting these rows counts the orders.
    """
    categories = products.select("product_id", "category")
    days = orders.select("order_id", F.to_date("order_timestamp").alias("order_date"))
    per_order = (
        items.select("order_id", "product_id", "line_total", "quantity")
        .join(categories, "product_id")
        .groupBy("order_id", "category")
        .agg(
            F.sum(F.col("line_total").cast(AMOUNT)).alias("sales"),
            F.sum("quantity").alias("items_sold"),
        )
    )
    count_orders = F.count if orders_are_unique else F.count_distinct
    return (
        per_order.join(days, "order_id")
        .groupBy("order_date", "category")
        .agg(
            F.sum("sales").cast("double").alias("total_sales"),
            F.sum("items_sold").alias("total_items_sold"),
            count_orders("order_id").alias("total_orders"),
        )
    )


def summarise_sales(joined: DataFrame) -> DataFrame:
    """The same daily table from rows that are joined already.

    Orders are counted as a struct of their id: grouping by it does not rely on the rows
    lying by order, so the join below may split an order with very many items.
    """
    return joined.groupBy("order_date", "category").agg(
        F.sum(F.col("line_total").cast(AMOUNT)).cast("double").alias("total_sales"),
        F.sum("quantity").alias("total_items_sold"),
        F.count_distinct(F.struct("order_id")).alias("total_orders"),
    )


def sales_in_one_pass(joined: DataFrame, category: str) -> tuple[DataFrame, int, int]:
    """Sales by day and category, by category and in all, and two counts, from one scan.

    The rows are counted while the sums are made: all of them, and those of `category`. The
    levels are grouping sets over sums per order, which are small by then, so nothing needs
    to be kept. `level` is 0 for a day and category, 1 for a category, 3 for all.
    """
    seen = Observation()
    counted = joined.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("category") == category).alias("of_category"),
    )
    per_order = counted.groupBy("order_date", "category", "order_id").agg(
        F.sum(F.col("line_total").cast(AMOUNT)).alias("sales"),
        F.sum("quantity").alias("items_sold"),
    )
    # An order is a row a category here, so it counts once in each of these levels.
    per_day = per_order.groupBy("order_date", "category").agg(
        F.sum("sales").alias("sales"),
        F.sum("items_sold").alias("items_sold"),
        F.count("order_id").alias("order_categories"),
    )
    levels = per_day.groupingSets(
        [("order_date", "category"), ("category",), ()], "order_date", "category"
    ).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("sales").cast("double").alias("total_sales"),
        F.sum("items_sold").alias("total_items_sold"),
        F.sum("order_categories").alias("order_categories"),
    )
    found = stored(levels, "sales-in-one-pass")
    return found, seen.get["rows"], seen.get["of_category"]


def build_daily_sales(spark: SparkSession, layers: Layers) -> int:
    """Compute the daily table from silver and store it; returns the number of rows."""
    paths = {name: f"{layers.silver}/{name}" for name in ("orders", "order_items", "products")}
    session = bounded_session(spark, *paths.values())
    silver = {name: read_table(session, path, layers.table_format) for name, path in paths.items()}
    daily = daily_sales(
        silver["orders"], silver["order_items"], silver["products"], orders_are_unique=True
    )
    return write_table(daily, f"{layers.gold}/{DAILY_SALES}", layers.table_format)


def sales_per_category(daily: DataFrame) -> DataFrame:
    """Total of the daily sales per category, added up in decimals."""
    total = F.sum(F.col("total_sales").cast(AMOUNT)).cast("double")
    return daily.groupBy("category").agg(total.alias("category_total_sales"))


def count_rows(df: DataFrame, label: str) -> DataFrame:
    """One row: the label and the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(label).alias("dataset"), "row_count"
    )


def count_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def count_equal(df: DataFrame, name: str, value: str) -> DataFrame:
    """One row: how many rows have this value in this column."""
    return df.filter(F.col(name) == value).agg(F.count(F.lit(1)).alias("row_count"))


def top_days(daily: DataFrame, rows: int = 20) -> DataFrame:
    """The days and categories with the highest sales, ties broken by day and category."""
    return daily.orderBy(F.desc("total_sales"), "order_date", "category").limit(rows)

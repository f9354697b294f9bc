"""Orders and items stored in the same buckets, so that joining them moves no row.

Both tables are cut by the hash of the order into as many buckets, and a bucket of items is
joined with the bucket of orders of the same number where it is read. A bucket is read by
one task, so an order with a large share of all items may not be in one: such orders are
found when the items are written, and their items go to a table of their own, which is
split freely and joined with the few orders by broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.model import AMOUNT
from lamina.operators.heavy import heavy_keys
from lamina.plans.joins import broadcast_within
from lamina.sources import fresh_path

#: An order is kept apart if its items exceed this part of a bucket.
PART_OF_BUCKET = 4
#: Rows of a bucket on average. A task sorts a bucket, to write it and to join it.
BUCKET_ROWS = 1_000_000


@dataclass(frozen=True)
class BucketedSales:
    """The names of the tables: orders and items in buckets, and the items kept apart."""

    orders: str
    items: str
    apart: str
    buckets: int


def store_bucketed(orders: DataFrame, items: DataFrame, buckets: int) -> BucketedSales:
    """Write both tables, each sorted in its buckets. Rows without an order are left out.

    There are `buckets`, or more if the larger table has more than `BUCKET_ROWS` for each.
    """
    spark = items.sparkSession
    placed = items.where("order_id is not null")
    buckets = max(buckets, ceil(max(placed.count(), orders.count()) / BUCKET_ROWS))
    hot = heavy_keys(placed, "order_id", buckets * PART_OF_BUCKET)
    few = broadcast_within(hot.select(F.col("order_id").alias("hot_order")))
    is_hot = F.col("order_id") == F.col("hot_order")
    mark = uuid.uuid4().hex
    tables = BucketedSales(f"orders_{mark}", f"items_{mark}", f"items_apart_{mark}", buckets)
    _write(orders.where("order_id is not null"), tables.orders, buckets)
    _write(placed.join(few, is_hot, "left_anti"), tables.items, buckets)
    apart = placed.join(few, is_hot, "left_semi")
    apart.write.option("path", fresh_path(spark, "apart") + "/rows").saveAsTable(tables.apart)
    return tables


def _write(df: DataFrame, name: str, buckets: int) -> None:
    """A file a bucket: rows are dealt out by the hash that the buckets are cut by."""
    path = fresh_path(df.sparkSession, "bucketed") + "/rows"
    dealt = df.repartition(buckets, "order_id")
    dealt.write.bucketBy(buckets, "order_id").sortBy("order_id").option("path", path).saveAsTable(name)


def drop_bucketed(spark: SparkSession, tables: BucketedSales) -> None:
    """Forget the tables; their files go with the shared folder."""
    for name in (tables.orders, tables.items, tables.apart):
        spark.catalog.dropTempView(name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def daily_sales(spark: SparkSession, tables: BucketedSales, products: DataFrame) -> DataFrame:
    """The daily sales of `gold.daily_sales`, for order ids that are unique.

    Below the join of orders and items nothing is shuffled. Items of one order lie in one
    bucket or all apart, so sums per order and category add up to the day's.
    """
    days = spark.table(tables.orders).select(
        "order_id", F.to_date("order_timestamp").alias("order_date")
    )
    cold = spark.table(tables.items).join(days, "order_id")
    apart = spark.table(tables.apart)
    hot_ids = apart.select("order_id").distinct()
    known = broadcast_within(days.join(broadcast_within(hot_ids), "order_id"))
    columns = ["order_id", "order_date", "product_id", "line_total", "quantity"]
    sold = cold.select(*columns).unionAll(apart.join(known, "order_id").select(*columns))
    categories = broadcast_within(products.select("product_id", "category"))
    per_order = (
        sold.join(categories, "product_id")
        .groupBy("order_date", "category", "order_id")
        .agg(
            F.sum(F.col("line_total").cast(AMOUNT)).alias("sales"),
            F.sum("quantity").alias("items_sold"),
        )
    )
    return per_order.groupBy("order_date", "category").agg(
        F.sum("sales").cast("double").alias("total_sales"),
        F.sum("items_sold").alias("total_items_sold"),
        F.count("order_id").alias("total_orders"),
    )

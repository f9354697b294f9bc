"""Distinct orders as exact bitmaps that add up over days, months and categories.

A count of distinct orders per day cannot be added to one per month, as an order may be in
several categories. A bitmap can: orders are numbered by day, an order is a bit, and the
union of bitmaps counts each order once. Numbers of a day are neighbours, so a day's orders
are in one bucket of 32,768 bits or two, and a bitmap a day, category and bucket is all that
is stored. Later levels are unions of stored bitmaps; items are never read again. New days
are numbered after the last number and appended.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators.numbering import numbered
from lamina.sources import stored


def number_orders(orders: DataFrame, first: int = 1) -> DataFrame:
    """`order_id`, `order_date` and the `number` of each order, in the order of the days.

    Order ids are unique, as in a silver table; orders of a later batch go on at `first`.
    """
    days = orders.select("order_id", F.to_date("order_timestamp").alias("order_date"))
    return numbered(days.where("order_id is not null"), "order_date", "order_id", first=first)


def order_bitmaps(numbers: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """`order_date`, `category`, `bucket` and the `bitmap` of the orders with such items.

    Items combine by order and category before they meet the orders, so an order with very
    many items is a few rows. Then rows are dealt out by ranges of the numbers: bits of a
    bucket lie in one range, or two, and become a bitmap there.
    """
    categories = products.select("product_id", "category")
    bought = items.select("order_id", "product_id").join(categories, "product_id")
    once = bought.select("order_id", "category").distinct().join(numbers, "order_id")
    number = F.col("number")
    ranged = once.select("order_date", "category", "number").repartitionByRange("number")
    return ranged.groupBy(
        "order_date", "category", F.bitmap_bucket_number(number).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def merged(bitmaps: DataFrame, *keys: str | Column) -> DataFrame:
    """The unions of stored bitmaps for each value of `keys`, still by bucket."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct orders for each value of `keys`, of bitmaps that are merged by them."""
    return bitmaps.groupBy(*keys).agg(
        F.sum(F.bitmap_count("bitmap")).cast("bigint").alias("total_orders")
    )


def orders_by_level(bitmaps: DataFrame) -> DataFrame:
    """Distinct orders per day and per month, of each category and of all, and in all.

    `level`, the `period`'s first day and the `category`, null where the level has none.
    Each level is the union of one below it, so the bitmaps shrink on the way up.
    """
    month = F.trunc("order_date", "month").alias("order_month")
    by_day = merged(bitmaps, "order_date")
    by_month_category = stored(merged(bitmaps, month, "category"), "bitmaps-by-month")
    by_month = stored(merged(by_month_category, "order_month"), "bitmaps-of-months")
    levels = [
        ("day and category", "order_date", "category", merged(bitmaps, "order_date", "category")),
        ("day", "order_date", None, by_day),
        ("month and category", "order_month", "category", by_month_category),
        ("month", "order_month", None, by_month),
        ("all", None, None, merged(by_month)),
    ]
    return reduce(DataFrame.unionAll, [_level(*level) for level in levels])


def _level(name: str, period: str | None, category: str | None, bitmaps: DataFrame) -> DataFrame:
    keys = [key for key in (period, category) if key]

    def shown(key: str | None, kind: str) -> Column:
        return F.col(key) if key else F.lit(None).cast(kind)

    return counted(bitmaps, *keys).select(
        F.lit(name).alias("level"),
        shown(period, "date").alias("period"),
        shown(category, "string").alias("category"),
        "total_orders",
    )

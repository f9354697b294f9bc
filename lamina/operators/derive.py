"""Retail-shaped data derived from existing tables: hot keys, fan-out, prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import line_total
from lamina.operators.gold import join_on
from lamina.operators.numbering import numbered

# Primes that spread neighbouring ids. They have no factor in common with 100 or
# with the small numbers they are reduced by, so the shares come out exactly.
SHARE_PRIME, CHOICE_PRIME = 7919, 104729


def hot_or_other(
    row_id: Column, values: Sequence[str], hot_value: str, hot_percent: int
) -> Column:
    """The hot value for the given percentage of ids, the others evenly for the rest."""
    others = [value for value in values if value != hot_value]
    choices = F.array(*[F.lit(value) for value in others])
    chosen = F.pmod(row_id * CHOICE_PRIME, F.lit(len(others))).cast("int")
    is_hot = F.pmod(row_id * SHARE_PRIME, F.lit(100)) < hot_percent
    return F.when(is_hot, F.lit(hot_value)).otherwise(F.get(choices, chosen))


def spread(*keys: Column, part: int = 0) -> Column:
    """A number from 0 to 2**32 - 1 from the hash of the keys; each `part` is another one."""
    digest = F.md5(F.concat_ws(":", *[key.cast("string") for key in keys]))
    return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("bigint")


def order_fanout(orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per item of each order, with an existing product and a quantity of 1 to 5.

    An order of no items, or of a null number, has none. The item id leaves room for the
    most items that any order has, so ids are unique for orders with unique ids. Product
    and quantity come from different parts of the hash of order and line; every product
    can be chosen, whatever its id. Without products there are no items.
    """
    real = orders.where("item_count >= 1")
    most = real.agg(F.max("item_count")).first()[0] or 1
    ids = products.select("product_id").where("product_id is not null").distinct()
    known = numbered(ids, "product_id")
    count = known.count()
    lines = real.select(
        "order_id", F.explode(F.sequence(F.lit(1), "item_count")).alias("line_number")
    )
    order_id, line = F.col("order_id"), F.col("line_number")
    drawn = lines.select(
        (order_id * (most + 1) + line).alias("order_item_id"),
        "order_id",
        F.pmod(spread(order_id, line), F.lit(max(count, 1))).alias("number"),
        (F.pmod(spread(order_id, line, part=1), F.lit(5)) + 1).cast("int").alias("quantity"),
    )
    return drawn.join(known, "number").select(
        "order_item_id", "order_id", "product_id", "quantity"
    )


def with_prices(items: DataFrame, products: DataFrame) -> DataFrame:
    """Look up the price of each item's product and compute the line total."""
    priced = join_on(items, products.select("product_id", "unit_price"), "product_id")
    return priced.withColumn("line_total", line_total(F.col("quantity"), F.col("unit_price")))

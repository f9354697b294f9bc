"""The retail datasets as views of the test tables.

The plain functions give clean data, as a silver layer holds it. The `raw_` ones
give what a source system might deliver: padded text, missing keys, impossible
values and second copies of some rows. Each has its counterpart in `oracles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import line_total
from lamina.model import AMOUNT, CATEGORIES, HOT_CATEGORY, HOT_CATEGORY_PERCENT, PRICE
from lamina.operators.derive import hot_or_other
from lamina.sources import read_table

# Line numbers of the test tables are 1 to 7.
ITEMS_PER_ORDER = 10


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
        (F.col("p_size") % 4 != 0).alias("is_active"),
    )


def skewed_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products of which 40 % are in one category."""
    category = hot_or_other(
        F.col("product_id"), CATEGORIES, HOT_CATEGORY, HOT_CATEGORY_PERCENT
    )
    return products(spark, folder).withColumn("category", category)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    located = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return located.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.initcap("c_mktsegment"), F.lit(" O'"), F.lower("n_name")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.lower(F.concat("c_name", F.lit("@example.com"))).alias("email"),
        F.initcap("n_name").alias("city"),
        F.initcap("r_name").alias("province"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1826).cast("int")).alias(
            "signup_date"
        ),
        F.when(F.col("c_acctbal") < 0, "bronze")
        .when(F.col("c_acctbal") < 5000, "silver")
        .otherwise("gold")
        .alias("loyalty_tier"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        (F.col("o_orderkey") % 500 + 1).alias("store_id"),
        F.lower("o_orderstatus").alias("order_status"),
        F.lower("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast(AMOUNT).alias("total_amount"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("item_count"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .select(
            (F.col("l_orderkey") * ITEMS_PER_ORDER + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _discounted_price().alias("unit_price"),
        )
        .withColumn("line_total", line_total(F.col("quantity"), F.col("unit_price")))
    )


def items_with_hot_order(spark: SparkSession, folder: str) -> DataFrame:
    """Items of which every third belongs to order 1."""
    hot = F.col("order_item_id") % 3 == 0
    return order_items(spark, folder).withColumn(
        "order_id", F.when(hot, F.lit(1)).otherwise(F.col("order_id"))
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Every product comes twice, the second time 900 cheaper; size 50 has no key."""
    part = table(spark, folder, "part")
    copies = part.unionByName(
        part.withColumn("p_retailprice", F.col("p_retailprice") - 900)
    )
    return copies.select(
        F.when(F.col("p_size") != 50, F.col("p_partkey")).alias("product_id"),
        F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" ")).alias("product_name"),
        F.concat(F.lit(" "), F.initcap("p_type"), F.lit("  ")).alias("category"),
        F.concat("p_brand", F.lit(" ")).alias("brand"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
        (F.col("p_size") % 4 != 0).alias("is_active"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Furniture customers come again with a blank email, building ones without any."""
    cleaned = customers(spark, folder)
    padded = cleaned.withColumns(
        {
            "customer_id": F.when(F.col("is_active"), F.col("customer_id")),
            "first_name": F.concat(F.lit("  "), F.upper("first_name"), F.lit(" ")),
            "last_name": F.concat(F.lit(" "), F.upper("last_name")),
            "email": F.concat(F.upper("email"), F.lit(" ")),
            "city": F.concat(F.lower("city"), F.lit("  ")),
            "province": F.concat(F.lit(" "), F.upper("province")),
        }
    )
    blank = padded.filter(F.trim("first_name").startswith("FURNITURE")).withColumn(
        "email", F.lit("  ")
    )
    absent = padded.filter(F.trim("first_name").startswith("BUILDING")).withColumn(
        "email", F.lit(None).cast("string")
    )
    return padded.unionByName(blank).unionByName(absent)


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Pending orders come again as completed without an amount."""
    cleaned = orders(spark, folder)
    priority, status = F.col("payment_method"), F.col("order_status")
    padded = cleaned.withColumns(
        {
            "order_id": F.when(~((status == "f") & (priority == "5-low")), F.col("order_id")),
            "customer_id": F.when(F.col("total_amount") >= 5000, F.col("customer_id")),
            "store_id": F.when(F.col("store_id") != 500, F.col("store_id")),
            "order_status": F.concat(F.lit("  "), F.upper("order_status"), F.lit(" ")),
            "payment_method": F.concat(F.lit(" "), F.upper("payment_method")),
            "total_amount": F.when(
                (status == "o") & (priority == "2-high"), -F.col("total_amount")
            ).otherwise(F.col("total_amount")),
            "item_count": F.col("item_count") - 1,
        }
    )
    repeated = padded.filter(F.trim("order_status") == "P").withColumns(
        {
            "order_status": F.lit(" COMPLETED "),
            "total_amount": F.lit(0).cast(AMOUNT),
        }
    )
    return padded.unionByName(repeated)


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """The table itself holds several rows for some keys; totals arrive as zero."""
    lines = table(spark, folder, "lineitem")
    tax, rebate = F.col("l_tax"), F.col("l_discount")
    quantity = F.col("l_quantity").cast("int")
    no_price = F.lit(0).cast(PRICE)
    return lines.select(
        (F.col("l_orderkey") * ITEMS_PER_ORDER + F.col("l_linenumber")).alias("order_item_id"),
        F.when(~((tax == 0) & (rebate == 0)), F.col("l_orderkey")).alias("order_id"),
        F.when(~((tax == 0.01) & (rebate == 0.01)), F.col("l_partkey")).alias("product_id"),
        F.when(tax == 0.08, -quantity)
        .when(tax == 0.07, F.lit(None))
        .otherwise(quantity)
        .alias("quantity"),
        F.when(rebate == 0.1, no_price).otherwise(_discounted_price()).alias("unit_price"),
        F.lit(0).cast(AMOUNT).alias("line_total"),
    )


def _discounted_price() -> Column:
    """The price of a line after its discount, which has four places."""
    discount = F.col("l_discount").cast("decimal(4,2)")
    return (F.col("l_extendedprice").cast(AMOUNT) * (1 - discount)).cast(PRICE)


RAW_FEEDS = {
    "products": raw_products,
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
}
CLEAN_FEEDS = {
    "products": products,
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
}

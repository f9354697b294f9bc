"""Hand-made rows at the edges of the cleaning rules."""

from __future__ import annotations

from decimal import Decimal

import pytest

from lamina.functions import as_number, lowered, positive, titled, trimmed
from lamina.model import PROCESSED_AT
from lamina.operators.dedupe import smallest_per_key
from lamina.operators.silver import clean

PRODUCTS = (
    "product_id BIGINT, product_name STRING, category STRING, brand STRING, unit_price DOUBLE"
)
CUSTOMERS = (
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, "
    "city STRING, province STRING"
)
ORDERS = (
    "order_id BIGINT, customer_id BIGINT, store_id BIGINT, order_status STRING, "
    "payment_method STRING, total_amount DOUBLE, item_count INT"
)
ITEMS = (
    "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
    "unit_price DECIMAL(18,4), line_total DECIMAL(18,2)"
)


def item(item_id, quantity=2, price="1.50", order_id=1, product_id=1):
    price = None if price is None else Decimal(price)
    return (item_id, order_id, product_id, quantity, price, Decimal("0.00"))


def cleaned_items(spark, *rows):
    return clean(spark.createDataFrame(list(rows), ITEMS), "order_items")


def test_bad_copy_that_survives_takes_its_key_along(spark):
    df = cleaned_items(spark, item(1, quantity=2), item(1, quantity=-1), item(2))
    assert [row.order_item_id for row in df.collect()] == [2]


def test_null_copy_is_the_smallest(spark):
    df = cleaned_items(spark, item(1, quantity=2), item(1, quantity=None))
    assert df.count() == 0


@pytest.mark.parametrize(
    "bad",
    [
        item(None),
        item(1, order_id=None),
        item(1, product_id=None),
        item(1, quantity=0),
        item(1, quantity=-3),
        item(1, quantity=None),
        item(1, price="0"),
        item(1, price="-1"),
        item(1, price=None),
        item(1, quantity=1, price="0.0010"),
    ],
)
def test_bad_items_drop(spark, bad):
    assert cleaned_items(spark, bad, item(9)).select("order_item_id").collect() == [(9,)]


def test_line_total_rounds_half_up(spark):
    row = cleaned_items(spark, item(1, quantity=3, price="0.335")).first()
    assert row.line_total == Decimal("1.01")
    assert row[PROCESSED_AT] is not None


def test_line_total_from_doubles_and_text(spark):
    doubles = spark.createDataFrame(
        [(1, 1, 1, 3, 0.335, 0.0)],
        "order_item_id INT, order_id INT, product_id INT, quantity INT, "
        "unit_price DOUBLE, line_total DOUBLE",
    )
    text = spark.createDataFrame(
        [(1, 1, 1, "3", "0.335", "x"), (2, 1, 1, "many", "1.0", "1"), (3, 1, 1, "1", "", "1")],
        "order_item_id INT, order_id INT, product_id INT, quantity STRING, "
        "unit_price STRING, line_total STRING",
    )
    for df in (doubles, text):
        rows = clean(df, "order_items").collect()
        assert [(row.order_item_id, row.line_total) for row in rows] == [(1, Decimal("1.01"))]


def test_amounts_that_are_no_money_drop_their_row_only(spark):
    prices = [1e300, float("nan"), float("inf"), 2.5]
    rows = [(number, 1, 1, 3, price, 0.0) for number, price in enumerate(prices)]
    df = spark.createDataFrame(
        rows,
        "order_item_id INT, order_id INT, product_id INT, quantity INT, "
        "unit_price DOUBLE, line_total DOUBLE",
    )
    assert [row.line_total for row in clean(df, "order_items").collect()] == [Decimal("7.50")]


def test_one_product_without_key_stays(spark):
    rows = [(None, "b", "x", "y", 3.0), (None, "a", "x", "y", 2.0), (1, "c", "x", "y", 0.0)]
    kept = clean(spark.createDataFrame(rows, PRODUCTS), "products").collect()
    assert [(row.product_id, row.product_name, row.unit_price) for row in kept] == [
        (None, "a", 2.0)
    ]


def test_rows_without_key_drop_elsewhere(spark):
    customers = [(None, "a", "b", "c@d", "e", "f"), (None, "a", "b", "c@d", "e", "f")]
    orders = [(None, 1, 1, "a", "b", 1.0, 1), (1, None, 1, "a", "b", 1.0, 1)]
    assert clean(spark.createDataFrame(customers, CUSTOMERS), "customers").count() == 0
    assert clean(spark.createDataFrame(orders, ORDERS), "orders").count() == 0


def test_blank_email_passes_and_missing_email_drops(spark):
    rows = [
        (1, " ann ", "o'brien-SMITH", "  ", "red  DEER", "british columbia"),
        (2, "bob", "x", None, "y", "z"),
    ]
    kept = clean(spark.createDataFrame(rows, CUSTOMERS), "customers").collect()
    assert [tuple(row)[:6] for row in kept] == [
        (1, "Ann", "O'brien-smith", "", "Red  Deer", "British Columbia")
    ]


def test_orders_are_standardised_and_checked(spark):
    rows = [
        (1, 1, 1, "  PENDING ", " Debit", 5.0, 1),
        (2, 1, 1, "a", "b", 0.0, 1),
        (3, 1, 1, "a", "b", 5.0, 0),
        (4, 1, None, "a", "b", 5.0, 1),
        (5, 1, 1, None, None, 5.0, 1),
    ]
    kept = clean(spark.createDataFrame(rows, ORDERS), "orders").orderBy("order_id").collect()
    assert [(row.order_id, row.order_status, row.payment_method) for row in kept] == [
        (1, "pending", "debit"),
        (5, None, None),
    ]


def test_text_functions(spark):
    df = spark.createDataFrame([("  o'brien-SMITH mcDonald ",), ("\t x ",), (None,)], "s STRING")
    rows = df.select(trimmed("s"), lowered("s"), titled("s")).collect()
    assert [tuple(row) for row in rows] == [
        ("o'brien-SMITH mcDonald", "o'brien-smith mcdonald", "O'brien-smith Mcdonald"),
        ("\t x", "\t x", "\t X"),
        (None, None, None),
    ]


def test_text_that_is_no_number_fails_the_check(spark):
    df = spark.createDataFrame([("1.5",), ("-1",), ("n/a",), (None,)], "amount STRING")
    assert [row.amount for row in df.filter(positive(df, "amount")).collect()] == ["1.5"]
    assert df.select(as_number(df, "amount").isNull().alias("bad")).filter("bad").count() == 2


def test_smallest_per_key_keeps_column_order_and_null_keys(spark):
    rows = [("b", None, 1), ("a", None, 2), ("c", 1, None), ("c", 1, 0)]
    df = smallest_per_key(spark.createDataFrame(rows, "x STRING, k INT, y INT"), ["k"])
    assert df.columns == ["x", "k", "y"]
    assert sorted(map(tuple, df.collect())) == [("a", None, 2), ("c", 1, None)]


def test_smallest_per_key_when_all_columns_are_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a INT, b INT")
    assert sorted(map(tuple, smallest_per_key(df, ["a", "b"]).collect())) == [(1, 2), (3, 4)]


def test_key_with_a_third_of_all_rows_leaves_each_map_task_once(spark):
    copies = spark.range(30_000, numPartitions=4).selectExpr(
        "IF(id % 3 = 0, 7, id) AS k", "id AS v"
    )
    single = smallest_per_key(copies, ["k"])
    assert single.count() == 20_000
    assert single.filter("k = 7").first().v == 0

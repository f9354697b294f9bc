"""Joins and aggregates on hand-made tables, checked against plain Python."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.model import PROCESSED_AT
from lamina.operators import gold
from lamina.operators.dedupe import smallest_per_key
from lamina.operators.derive import hot_or_other, order_fanout, with_prices
from lamina.operators.numbering import numbered

DAY = dt.datetime(2024, 5, 1, 23, 59)
NEXT_DAY = dt.datetime(2024, 5, 2, 0, 0)
ORDERS = [(1, DAY), (2, DAY), (3, NEXT_DAY), (4, NEXT_DAY)]
ITEMS = [
    (1, 10, Decimal("1.10"), 1),
    (1, 10, Decimal("2.20"), 2),
    (1, 11, Decimal("5.00"), 1),
    (2, 11, Decimal("0.05"), 1),
    (2, 12, Decimal("7.00"), 3),
    (3, 10, Decimal("9.99"), 1),
    (3, 99, Decimal("1.00"), 1),
    (8, 10, Decimal("1.00"), 1),
    (None, 10, Decimal("1.00"), 1),
    (3, None, Decimal("1.00"), 1),
]
PRODUCTS = [(10, "toys"), (11, "home"), (12, None), (13, "home"), (None, "home")]
EXPECTED = {
    (dt.date(2024, 5, 1), "toys"): (3.3, 3, 1),
    (dt.date(2024, 5, 1), "home"): (5.05, 2, 2),
    (dt.date(2024, 5, 1), None): (7.0, 3, 1),
    (dt.date(2024, 5, 2), "toys"): (9.99, 1, 1),
}


@pytest.fixture(scope="module")
def tables(spark):
    orders = spark.createDataFrame(ORDERS, "order_id BIGINT, order_timestamp TIMESTAMP_NTZ")
    items = spark.createDataFrame(
        ITEMS, "order_id BIGINT, product_id BIGINT, line_total DECIMAL(18,2), quantity INT"
    )
    products = spark.createDataFrame(PRODUCTS, "product_id BIGINT, category STRING")
    return orders, items, products


def as_dict(daily):
    return {(row[0], row[1]): tuple(row)[2:] for row in daily.collect()}


@pytest.mark.parametrize("unique", [False, True])
def test_daily_sales(tables, unique):
    assert as_dict(gold.daily_sales(*tables, orders_are_unique=unique)) == EXPECTED


def test_joined_rows_give_the_same_table(tables):
    assert as_dict(gold.summarise_sales(gold.joined_sales(*tables))) == EXPECTED


def test_repeated_orders_count_once(tables):
    orders, items, products = tables
    repeated = orders.unionByName(orders.filter("order_id = 2"))
    ours = as_dict(gold.daily_sales(repeated, items, products))
    assert ours == as_dict(gold.summarise_sales(gold.joined_sales(repeated, items, products)))
    assert ours[dt.date(2024, 5, 1), "home"] == (5.1, 3, 2)


def test_day_follows_the_session_time_zone_only_for_zoned_times(spark, tables):
    orders, items, products = tables
    assert as_dict(gold.daily_sales(orders, items, products)) == EXPECTED
    zoned = orders.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp"))
    assert as_dict(gold.daily_sales(zoned, items, products)) == EXPECTED


def test_clashing_columns_keep_the_left_value(spark):
    left = spark.createDataFrame([(1, "l", 2.0)], "k INT, batch_id STRING, unit_price DOUBLE")
    right = spark.createDataFrame(
        [(1, "r", 3.0, "x")], "k INT, batch_id STRING, unit_price DOUBLE, c STRING"
    )
    joined = gold.join_on(left, right, "k")
    assert joined.columns == ["k", "batch_id", "unit_price", "c"]
    assert tuple(joined.select("k", "batch_id", "unit_price", "c").first()) == (1, "l", 2.0, "x")


def test_join_of_tables_with_lineage_columns_can_be_stored(spark, tables, tmp_path):
    stamped = [df.withColumn(PROCESSED_AT, F.current_timestamp()) for df in tables]
    gold.joined_sales(*stamped).write.parquet(str(tmp_path / "joined"))
    assert spark.read.parquet(str(tmp_path / "joined")).count() == 6


def test_totals_and_counts(tables):
    daily = gold.daily_sales(*tables)
    totals = dict(map(tuple, gold.sales_per_category(daily).collect()))
    assert totals == {"toys": 13.29, "home": 5.05, None: 7.0}
    assert gold.count_equal(tables[2], "category", "home").first().row_count == 3
    assert gold.count_rows(tables[1], "items").first().asDict() == {
        "dataset": "items",
        "row_count": 10,
    }
    top = gold.top_days(daily, 2).collect()
    assert [row.total_sales for row in top] == [9.99, 7.0]


def test_ties_in_the_top_rows_break_by_day_and_category(spark):
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    daily = spark.createDataFrame(
        [(second, "a", 1.0), (first, "b", 1.0), (first, "a", 1.0)],
        "order_date DATE, category STRING, total_sales DOUBLE",
    )
    assert [tuple(row)[:2] for row in gold.top_days(daily, 2).collect()] == [
        (first, "a"),
        (first, "b"),
    ]


def test_hot_order_product_and_category(spark):
    """A third of all items in one order, and a third of one product."""
    items = spark.range(9_000, numPartitions=6).selectExpr(
        "IF(id % 3 = 0, 1, id) AS order_id",
        "IF(id % 3 = 1, 5, id % 50) AS product_id",
        "CAST(id % 7 + 0.25 AS DECIMAL(18,2)) AS line_total",
        "CAST(id % 4 + 1 AS INT) AS quantity",
    )
    orders = spark.range(9_000).selectExpr(
        "id AS order_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 5) AS order_timestamp",
    )
    products = spark.range(50).selectExpr(
        "id AS product_id", "IF(id < 30, 'hot', concat('c', id % 4)) AS category"
    )
    expected = defaultdict(lambda: [Decimal(0), 0, set()])
    for number in range(9_000):
        order = 1 if number % 3 == 0 else number
        product = 5 if number % 3 == 1 else number % 50
        category = "hot" if product < 30 else f"c{product % 4}"
        sums = expected[dt.date(2024, 1, 1) + dt.timedelta(days=order % 5), category]
        sums[0] += number % 7 + Decimal("0.25")
        sums[1] += number % 4 + 1
        sums[2].add(order)
    wanted = {key: (float(s), q, len(o)) for key, (s, q, o) in expected.items()}
    for unique in (False, True):
        assert as_dict(gold.daily_sales(orders, items, products, unique)) == wanted


def test_hot_value_has_its_share(spark):
    values = ["hot", "a", "b", "c"]
    rows = spark.range(10_000).select(hot_or_other(F.col("id"), values, "hot", 40).alias("v"))
    counts = {row.v: row["count"] for row in rows.groupBy("v").count().collect()}
    assert counts["hot"] == 4_000
    assert all(abs(counts[value] - 2_000) < 100 for value in "abc")


def test_fanout_and_prices(spark):
    rows = [(1, 3), (2, 12), (3, 0), (4, None), (5, -1), (6, 1)]
    orders = spark.createDataFrame(rows, "order_id BIGINT, item_count INT")
    products = spark.range(7).selectExpr(
        "3 * id + 1 AS product_id", "CAST(3 * id + 1.5 AS DECIMAL(18,4)) AS unit_price"
    )
    items = order_fanout(orders, products)
    found = items.collect()
    assert sorted(row.order_id for row in found) == [1] * 3 + [2] * 12 + [6]
    assert len({row.order_item_id for row in found}) == 16
    priced = with_prices(items, products).collect()
    assert len(priced) == 16
    for row in priced:
        assert 1 <= row.quantity <= 5
        assert row.line_total == row.quantity * (row.product_id + Decimal("0.5"))


def test_fanout_reaches_every_product_and_gives_each_line_its_own_quantity(spark):
    orders = spark.range(1_000).selectExpr("id AS order_id", "5 AS item_count")
    products = spark.range(2_000).selectExpr("id AS product_id")
    items = order_fanout(orders, products).cache()
    # Of 2,000 products 5,000 draws miss about 2,000 * exp(-2.5).
    assert items.select("product_id").distinct().count() > 1_750
    per_line = items.groupBy((F.col("order_item_id") % 6).alias("line")).agg(
        F.count_distinct("quantity").alias("quantities")
    )
    assert {row.quantities for row in per_line.collect()} == {5}
    assert order_fanout(orders, products.where("false")).count() == 0


def test_numbers_are_dense_and_in_order(spark):
    values = spark.range(500).selectExpr("id * 7 % 501 AS v")
    rows = sorted((row.v, row.number) for row in numbered(values.repartition(6), "v").collect())
    assert [number for _, number in rows] == list(range(500))


CENTS = st.integers(1, 10_000)
ITEM = st.tuples(st.integers(0, 8), st.integers(0, 5), CENTS, st.integers(1, 5))
ORDER = st.tuples(st.integers(0, 9), st.integers(0, 2))


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    items=st.lists(ITEM, min_size=1, max_size=40),
    orders=st.lists(ORDER, min_size=1, max_size=12),
)
def test_random_tables_against_loops(spark, items, orders):
    """Deduplicated orders, then both forms of the daily table, against plain loops."""
    days = {}
    for order, day in orders:
        days[order] = min(day, days.get(order, day))
    expected = defaultdict(lambda: [0, 0, set()])
    for order, product, cents, quantity in items:
        if order in days and product < 4:
            sums = expected[dt.date(2024, 1, 1 + days[order]), f"c{product % 2}"]
            sums[0] += cents
            sums[1] += quantity
            sums[2].add(order)
    wanted = {key: (cents / 100, sold, len(of)) for key, (cents, sold, of) in expected.items()}

    order_rows = [(order, dt.datetime(2024, 1, 1 + day, 12)) for order, day in orders]
    item_rows = [(o, p, Decimal(cents) / 100, q) for o, p, cents, q in items]
    delivered = spark.createDataFrame(order_rows, "order_id BIGINT, order_timestamp TIMESTAMP_NTZ")
    single = smallest_per_key(delivered, ["order_id"])
    sold = spark.createDataFrame(
        item_rows, "order_id BIGINT, product_id BIGINT, line_total DECIMAL(18,2), quantity INT"
    )
    products = spark.range(4).selectExpr("id AS product_id", "concat('c', id % 2) AS category")
    assert as_dict(gold.daily_sales(single, sold, products, orders_are_unique=True)) == wanted
    assert as_dict(gold.summarise_sales(gold.joined_sales(single, sold, products))) == wanted

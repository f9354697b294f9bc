"""Distribution reports, salting and partition layout on skewed rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.functions import random_salt, salted_key, steady_salt
from lamina.operators import layout, skew
from lamina.operators.gold import count_per_key

ROWS = 6_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Key `hot` has a third of the rows, null a sixth, fifty others share the rest."""
    return spark.range(ROWS, numPartitions=6).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 6 = 1 THEN NULL "
        "ELSE concat('k', id % 50) END AS k",
        "id % 700 AS order_id",
        "CAST(id % 11 + 0.5 AS DECIMAL(18,2)) AS line_total",
        "CAST(id % 4 + 1 AS INT) AS quantity",
    )


def sizes_of(df):
    return {row.partition_id: row.row_count for row in df.collect()}


def test_distribution_is_ordered_by_size_then_key(skewed):
    rows = skew.key_distribution(skewed, "k").collect()
    assert (rows[0].k, rows[0].row_count) == ("hot", ROWS // 3)
    assert (rows[1].k, rows[1].row_count) == (None, ROWS // 6)
    rest = [(-row.row_count, row.k) for row in rows[2:]]
    assert rest == sorted(rest)


def test_skew_report(skewed):
    rows = {row.k: row for row in skew.skew_report(skewed, "k").collect()}
    assert rows["hot"].share == pytest.approx(1 / 3)
    assert rows["hot"].ratio_to_mean == pytest.approx(len(rows) / 3)
    assert sum(row.share for row in rows.values()) == pytest.approx(1)


def test_salt_applies_to_the_hot_value_only(skewed):
    salted = skewed.select(
        "k", salted_key(F.col("k"), "hot", steady_salt(F.col("order_id"), 5)).alias("s")
    ).distinct()
    by_key = {}
    for row in salted.collect():
        by_key.setdefault(row.k, set()).add(row.s)
    assert by_key["hot"] == {f"hot_{salt}" for salt in range(5)}
    assert by_key[None] == {None}
    assert all(values == {key} for key, values in by_key.items() if key != "hot")


def test_steady_salt_is_steady_and_random_salt_is_in_range(spark, skewed):
    ids = spark.createDataFrame([(-7,), (None,), (12,)], "n BIGINT")
    salted = ids.select(steady_salt(F.col("n"), 5).alias("salt"))
    assert salted.collect() == salted.collect()
    assert all(0 <= row.salt < 5 for row in salted.collect())
    texts = ids.select(steady_salt(F.col("n").cast("string"), 5).alias("salt"))
    assert all(0 <= row.salt < 5 for row in texts.collect())
    salts = skewed.select(random_salt(5, seed=1).alias("salt"))
    assert {row.salt for row in salts.distinct().collect()} == set(range(5))
    assert salts.schema["salt"].dataType.simpleString() == "int"


def test_two_stages_equal_one(skewed):
    salted = skew.salted_sales(skewed, "k", "order_id", 7)
    plain = skewed.groupBy("k").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("line_total").cast("double").alias("total_sales"),
        F.sum("quantity").alias("total_items_sold"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    key = str
    assert sorted(salted.collect(), key=key) == sorted(plain.collect(), key=key)


def test_hot_keys_split_into_even_pieces_and_no_row_is_lost(skewed):
    split = skew.split_hot_keys(skewed, "k", 20, F.col("id"), finer=1)
    assert split.columns == [*skewed.columns, "piece"]
    assert split.count() == ROWS
    pieces = {}
    for row in count_per_key(split, "k", "piece").collect():
        pieces.setdefault(row.k, []).append(row.row_count)
    share = ROWS // 20
    assert len(pieces["hot"]) == 7 and max(pieces["hot"]) < 1.3 * share
    assert len(pieces[None]) == 4 and max(pieces[None]) < 1.3 * share
    assert all(len(sizes) == 1 for key, sizes in pieces.items() if key not in ("hot", None))


def test_ids_of_one_residue_are_spread(spark):
    ids = spark.range(1_000).select(steady_salt(F.col("id") * 5, 5).alias("salt"))
    sizes = [row["count"] for row in ids.groupBy("salt").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 300


def test_empty_partitions_are_listed(spark):
    df = spark.range(10).selectExpr("id", "1 AS k").repartition(4, "k")
    assert sorted(sizes_of(layout.partition_sizes(df, 4)).values()) == [0, 0, 0, 10]
    assert sorted(sizes_of(layout.partition_sizes(df)).values()) == [10]
    stats = layout.partition_stats(layout.partition_sizes(df, 4)).first()
    assert tuple(stats) == (4, 10, 10, 0)


def test_each_key_is_in_one_partition_after_repartition_by_key(skewed):
    placed = layout.key_partitions(skewed.repartition(8, "k"), "k").collect()
    assert {row.partitions for row in placed} == {1}
    assert sum(row.row_count for row in placed) == ROWS
    dealt = layout.key_partitions(skewed.repartition(8), "k").collect()
    assert max(row.partitions for row in dealt) == 8


def test_splitting_evens_out_real_placements(skewed):
    split = skew.split_hot_keys(skewed, "k", 12, F.col("id") * 5)
    report = skew.placement_report(split, 12, {"key": ["k"], "piece": ["k", "piece"]})
    ratios = {row.placed_by: row.max_to_mean for row in report.collect()}
    assert ratios["key"] > 3.9 and ratios["piece"] < 1.5


def test_salts_follow_the_measured_share(skewed):
    assert skew.salts_for(skewed, "k", "hot", 12, finer=1) == 4
    assert skew.salts_for(skewed, "k", "hot", 12, finer=10) == 40
    assert skew.salts_for(skewed, "k", "absent", 12) == 1
    assert skew.salts_for(skewed.where("false"), "k", "hot", 12) == 1


def test_round_robin_sizes_differ_by_no_more_than_the_input_tasks(skewed):
    sizes = sizes_of(layout.partition_sizes(skewed.repartition(5), 5)).values()
    assert sum(sizes) == ROWS and max(sizes) - min(sizes) <= 6
    merged = sizes_of(layout.partition_sizes(skewed.repartition(50).coalesce(5), 5)).values()
    assert sum(merged) == ROWS and len(merged) == 5


def test_decimal_sums_do_not_depend_on_order(skewed):
    expected = sum((number % 11 + Decimal("0.5") for number in range(ROWS)), Decimal(0))
    assert skewed.agg(F.sum("line_total")).first()[0] == expected

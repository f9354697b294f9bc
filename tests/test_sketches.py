"""Summaries that merge: frequent keys, distinct orders, column profiles, partition sizes."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lamina.operators import distinct, drift, heavy, layout, profile, skew
from lamina.operators.numbering import numbered
from lamina.plans.report import plan_nodes


# Heavy keys


def skewed(spark, rows=120_000):
    """A third of the rows has key 7, a fiftieth none; the others are almost all different."""
    return spark.range(rows, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k", "id"
    )


def plain_heavy(df, pieces):
    counts = Counter(row.k for row in df.select("k").collect())
    total = sum(counts.values())
    return {(key, n) for key, n in counts.items() if n > total / pieces}


@pytest.mark.parametrize("pieces", [10, 1_000, 5_000])
def test_heavy_keys_have_exact_counts(spark, pieces):
    df = skewed(spark)
    found = heavy.heavy_keys(df, "k", pieces).collect()
    assert {(row.k, row.row_count) for row in found} == plain_heavy(df, pieces)
    assert all(row.share == row.row_count / 120_000 for row in found)


def test_sketches_of_batches_are_combined(spark):
    df = skewed(spark)
    parts = [df.where(F.col("id") % 4 == part) for part in range(4)]
    sketches = heavy.key_sketches(parts[0], "k", 1_000)
    for part in parts[1:]:
        sketches = sketches.unionAll(heavy.key_sketches(part, "k", 1_000))
    found = heavy.heavy_keys(df, "k", 1_000, heavy.combined(sketches)).collect()
    assert {(row.k, row.row_count) for row in found} == plain_heavy(df, 1_000)


def test_more_keys_than_a_sketch_holds_are_dealt_over_several(spark, monkeypatch):
    monkeypatch.setattr(heavy, "TRACKED", 64)
    monkeypatch.setattr(heavy, "TRACKED_PER_PIECE", 8)
    df = spark.range(30_000).selectExpr("CASE WHEN id % 2 = 0 THEN id % 40 ELSE id END AS k")
    sketches = heavy.key_sketches(df, "k", 100)
    assert sketches.count() == 13
    found = heavy.heavy_keys(df, "k", 100).collect()
    assert {(row.k, row.row_count) for row in found} == plain_heavy(df, 100)


def test_no_table_of_all_keys_is_made(spark):
    """Nothing above the scan and the join with the candidates gives a row a key."""
    df = skewed(spark)
    found = heavy.heavy_keys(df, "k", 1_000)
    found.collect()
    aggregates = [n.rows for n in plan_nodes(found) if n.name == "HashAggregate" and n.rows]
    assert max(aggregates) <= 2 * 6
    assert not [n for n in plan_nodes(found) if n.name == "SortMergeJoin"]


def test_no_rows_no_heavy_keys(spark):
    empty = spark.createDataFrame([], "k string")
    assert heavy.heavy_keys(empty, "k", 10).collect() == []
    text = spark.createDataFrame([("a",)] * 30 + [(f"b{i}",) for i in range(70)], "k string")
    assert [tuple(row) for row in heavy.heavy_keys(text, "k", 10).collect()] == [("a", 30, 0.3)]
    split = skew.split_hot_keys(text, "k", 4, F.col("k"), finer=1)
    assert split.count() == 100


# Distinct orders


def sales(spark, orders, first=0, hot=0):
    """Orders over 90 days, in one to three categories each; order `first` has `hot` items."""
    start = dt.datetime(2024, 1, 1, 10)
    order_rows = [(first + i, start + dt.timedelta(days=(first + i) * 7 % 90)) for i in range(orders)]
    item_rows = [(o, o % 5 + part) for o, _ in order_rows for part in range(o % 3 + 1)]
    item_rows += [(first, n % 7) for n in range(hot)]
    days = spark.createDataFrame(order_rows, "order_id bigint, order_timestamp timestamp_ntz")
    items = spark.createDataFrame(item_rows, "order_id bigint, product_id bigint")
    products = spark.range(7).selectExpr("id AS product_id", "concat('c', id % 3) AS category")
    return days, items, products, order_rows, item_rows


def plain_levels(order_rows, item_rows):
    dates = {order: when.date() for order, when in order_rows}
    found = defaultdict(set)
    for order, product in item_rows:
        day, category = dates[order], f"c{product % 3}"
        month = day.replace(day=1)
        found["day and category", day, category].add(order)
        found["day", day, None].add(order)
        found["month and category", month, category].add(order)
        found["month", month, None].add(order)
        found["all", None, None].add(order)
    return {(*key, len(orders)) for key, orders in found.items()}


def test_bitmaps_count_each_order_once_at_every_level(spark):
    days, items, products, order_rows, item_rows = sales(spark, 700, hot=3_000)
    bitmaps = distinct.order_bitmaps(distinct.number_orders(days), items, products)
    found = {tuple(row) for row in distinct.orders_by_level(bitmaps).collect()}
    assert found == plain_levels(order_rows, item_rows)


def test_a_later_batch_is_numbered_on_and_added(spark):
    one, two = sales(spark, 400), sales(spark, 300, first=400)
    bitmaps = distinct.order_bitmaps(distinct.number_orders(one[0]), one[1], one[2])
    later = distinct.order_bitmaps(distinct.number_orders(two[0], first=401), two[1], two[2])
    both = bitmaps.unionAll(later)
    found = {tuple(row) for row in distinct.orders_by_level(both).collect()}
    assert found == plain_levels(one[3] + two[3], one[4] + two[4])


def test_a_day_lies_in_one_bucket_or_two(spark):
    days = spark.range(100_000).selectExpr(
        "id * 7919 % 100003 AS order_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 50) AS order_timestamp",
    )
    items = days.selectExpr("order_id", "0L AS product_id")
    products = spark.sql("SELECT 0L AS product_id, 'c' AS category")
    bitmaps = distinct.order_bitmaps(distinct.number_orders(days), items, products)
    per_day = bitmaps.groupBy("order_date").count().collect()
    assert len(per_day) == 50 and max(row["count"] for row in per_day) <= 2
    assert distinct.counted(bitmaps, "order_date").agg(F.sum("total_orders")).first()[0] == 100_000


def test_numbers_begin_where_they_are_told_to(spark):
    rows = numbered(spark.range(1_000).repartition(7), "id", first=5).collect()
    assert {row.number - row.id for row in rows} == {5}
    assert numbered(spark.range(0), "id").count() == 0


# Column profiles


def test_merged_profiles_are_as_close_as_the_sketches_promise(spark):
    df = spark.range(60_000).selectExpr(
        "id", "id * 7 % 25000 AS k", "concat('c', id % 300) AS c", "CAST(id % 977 AS DECIMAL(18,2)) AS p"
    )
    columns = ["k", "c", "p"]
    sketches = profile.column_sketches(df.where("id % 3 = 0"), *columns)
    for part in (1, 2):
        sketches = sketches.unionAll(profile.column_sketches(df.where(f"id % 3 = {part}"), *columns))
    found = profile.sketched_profile(profile.merged_sketches(sketches), 0.1, 0.5, 0.9)
    rows = {row.column_name: row for row in found.collect()}
    for name, exact in (("k", 25_000), ("c", 300), ("p", 977)):
        row = rows[name]
        assert (row.row_count, row.value_count) == (60_000, 60_000)
        assert abs(row.distinct_values - exact) <= profile.DISTINCT_ERROR * exact + 1
    assert rows["c"].quantiles is None
    values = {"k": [i * 7 % 25_000 for i in range(60_000)], "p": [i % 977 for i in range(60_000)]}
    for name, own in values.items():
        for rank, value in zip((0.1, 0.5, 0.9), rows[name].quantiles, strict=True):
            below, up_to = (sum(map(compare, own)) for compare in (value.__gt__, value.__ge__))
            assert below <= (rank + profile.QUANTILE_ERROR) * 60_000
            assert up_to >= (rank - profile.QUANTILE_ERROR) * 60_000


def test_columns_without_values_have_no_quantiles(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    sketches = profile.column_sketches(df, "a", "b")
    merged = profile.merged_sketches(sketches.unionAll(profile.column_sketches(df.limit(0), "a", "b")))
    rows = {row.column_name: tuple(row)[1:] for row in profile.sketched_profile(merged, 1.0).collect()}
    assert rows == {"a": (2, 2, 2, [2.0]), "b": (2, 0, 0, None)}


# Sizes and heads of files


def test_sizes_observed_while_rows_are_written(spark, tmp_path):
    df = spark.range(50_000, numPartitions=9).where("id % 3 = 0 OR id < 9000")
    observed = layout.write_observed(df, str(tmp_path / "rows"))
    counted = layout.partition_sizes(df)
    assert sorted(map(tuple, observed.collect())) == sorted(map(tuple, counted.collect()))
    written = spark.read.parquet(str(tmp_path / "rows"))
    assert written.columns == ["id"] and written.count() == df.count()


def test_drift_of_parquet_files(spark, tmp_path):
    declared = "a bigint, b string, c decimal(18,2)"
    same = spark.sql("SELECT 1L AS a, 'x' AS b, 1.0BD AS c").withColumn("c", F.col("c").cast("decimal(18,2)"))
    same.write.parquet(str(tmp_path / "in" / "same"))
    same.drop("b").withColumn("d", F.lit(True)).write.parquet(str(tmp_path / "in" / "other"))
    same.withColumn("a", F.lit("1")).write.parquet(str(tmp_path / "in" / "typed"))
    found = drift.schema_drift(spark, str(tmp_path / "in"), declared).collect()
    assert {(row.file.split("/")[0], *tuple(row)[1:]) for row in found} == {
        ("other", "b", "missing", "string", None),
        ("other", "d", "extra", None, "boolean"),
        ("typed", "a", "retyped", "bigint", "string"),
    }


def test_drift_of_csv_headers(spark, tmp_path):
    heads = {"same": "a,b,c", "moved": "a,c,b", "short": "a,b", "wide": "a,b,c,d"}
    for name, head in heads.items():
        (tmp_path / f"{name}.csv").write_text(f"{head}\n{','.join('1' for _ in head.split(','))}\n")
    found = drift.schema_drift(spark, str(tmp_path), "a int, b int, c int", "csv").collect()
    assert {(row.file, row.column_name, row.finding) for row in found} == {
        ("moved.csv", "c", "moved"),
        ("short.csv", "c", "missing"),
        ("wide.csv", "d", "extra"),
    }
    assert drift.schema_drift(spark, str(tmp_path), "a int", "orc").count() == 0

"""The physical paths: which joins, which shuffles, which settings, what reaches the scan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lamina.model import Layers
from lamina.operators import bronze, bucketed, gold, layout, silver
from lamina.operators.dedupe import smallest_per_key
from lamina.operators.reuse import kept
from lamina.plans import joins, settings
from lamina.plans.report import join_counts, plan_nodes, plan_summary, plan_text, scanned_rows
from lamina.plans.settings import (
    ADAPTIVE,
    BROADCAST_THRESHOLD,
    NO_BROADCAST,
    SHUFFLE_PARTITIONS,
    large_job_settings,
    session_with,
)
from lamina.plans.timing import compare, timed
from lamina.plans.together import together
from lamina.sources import read_table, write_csv
from lamina.workload import feeds, queries

FOLDER = "/root/testdata/sf0.001"


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|Single|Round|range|REPART)", plan_text(df)))


def test_threshold_decides_the_joins(spark):
    merge = queries.QUERIES["daily_sales_sort_merge"](spark, FOLDER)
    automatic = queries.QUERIES["daily_sales_auto_broadcast"](spark, FOLDER)
    hinted = queries.QUERIES["daily_sales_broadcast_hint"](spark, FOLDER)
    assert join_counts(merge) == {"BroadcastHashJoin": 0, "SortMergeJoin": 2}
    assert join_counts(automatic) == {"BroadcastHashJoin": 2, "SortMergeJoin": 0}
    assert join_counts(hinted) == {"BroadcastHashJoin": 1, "SortMergeJoin": 1}


def test_settings_stay_in_their_session(spark):
    before = dict(spark.conf.getAll)
    other = session_with(spark, {SHUFFLE_PARTITIONS: "3", ADAPTIVE: "false"})
    assert other.conf.get(SHUFFLE_PARTITIONS) == "3"
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert dict(spark.conf.getAll) == before
    grouped = other.range(100).groupBy((F.col("id") % 10).alias("k")).count()
    assert grouped.rdd.getNumPartitions() == 3
    assert "AdaptiveSparkPlan" not in plan_text(grouped)
    assert "AdaptiveSparkPlan" in plan_text(spark.range(9).groupBy("id").count())


def test_frame_keeps_the_settings_it_was_made_under(spark):
    merge = queries.QUERIES["daily_sales_sort_merge"](spark, FOLDER)
    merge.collect()
    final = plan_text(merge)
    assert "isFinalPlan=true" in final
    assert "BroadcastHashJoin" not in final


def test_checked_broadcast(spark):
    session = session_with(spark, {BROADCAST_THRESHOLD: NO_BROADCAST})
    other = session.range(100)
    small = other.selectExpr("id", "concat('n', id) AS name")
    within = other.join(joins.broadcast_within(small), "id")
    beyond = other.join(joins.broadcast_within(small, limit=1_000), "id")
    assert join_counts(within) == {"BroadcastHashJoin": 1, "SortMergeJoin": 0}
    assert join_counts(beyond) == {"BroadcastHashJoin": 0, "SortMergeJoin": 1}
    assert within.count() == beyond.count() == 100


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a INT, b STRING")
    assert joins.measured_bytes(df) == 2 * (joins.ROW_BYTES + 2 * joins.FIELD_BYTES) + 3
    assert joins.measured_bytes(df.limit(0)) == 0
    listed = df.select(F.array("a").alias("list"))
    # {"list":[1]} and {"list":[2]}
    assert joins.measured_bytes(listed) == 2 * (joins.ROW_BYTES + joins.FIELD_BYTES + 12)
    assert "broadcast" in plan_text(joins.broadcast_within(listed), "extended").lower()


def test_only_needed_columns_and_filters_reach_the_scan(spark):
    text = plan_text(queries.daily_sales(spark, FOLDER), "formatted")
    scanned = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert sorted(scanned) == [
        "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double,"
        "l_discount:double",
        "o_orderkey:bigint,o_orderdate:timestamp_ntz",
        "p_partkey:bigint,p_type:string",
    ]
    assert "PushedFilters: [IsNotNull(l_partkey), IsNotNull(l_orderkey)]" in text


def test_unneeded_measures_are_not_computed(spark):
    text = plan_text(queries.category_total_sales(spark, FOLDER))
    assert "sum(line_total" in text
    assert "sum(quantity" not in text
    assert "count(" not in text


def test_shuffles_of_daily_sales(spark):
    """One per (order, category), one per (day, category); broadcast joins add none."""
    broadcast = queries.daily_sales(spark, FOLDER)
    assert exchanges(broadcast) == 2
    distinct = gold.daily_sales(
        feeds.orders(spark, FOLDER), feeds.order_items(spark, FOLDER), feeds.products(spark, FOLDER)
    )
    assert exchanges(distinct) == 2


def test_rows_combine_before_each_shuffle(spark):
    items = feeds.raw_order_items(spark, FOLDER)
    for df in (smallest_per_key(items, ["order_item_id"]), queries.daily_sales(spark, FOLDER)):
        assert "partial_" in plan_text(df)


def test_key_filter_moves_below_the_deduplication_and_others_do_not(spark, tmp_path):
    feeds.raw_orders(spark, FOLDER).write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    text = plan_text(silver.clean(stored, "orders"), "formatted")
    assert "PushedFilters: [IsNotNull(order_id)]" in text


def test_kept_frame_is_read_from_memory_and_released(spark):
    df = spark.range(1_000).selectExpr("id", "id % 3 AS k")
    with kept(df) as held:
        assert "InMemoryTableScan" in plan_text(held.groupBy("k").count())
        assert held.storageLevel.useMemory and held.storageLevel.useDisk
    assert not df.storageLevel.useMemory
    assert "InMemoryTableScan" not in plan_text(df.groupBy("k").count())


def test_kept_frame_is_released_after_an_error(spark):
    df = spark.range(10).selectExpr("id + 1 AS n")
    with pytest.raises(RuntimeError), kept(df):
        raise RuntimeError
    assert not df.storageLevel.useMemory


def test_repartition_collapses_and_coalesce_adds_no_shuffle(spark):
    df = spark.range(1_000, numPartitions=4)
    assert exchanges(df.repartition(50).repartition(5)) == 1
    assert exchanges(df.repartition(50).coalesce(5)) == 1
    assert exchanges(df.coalesce(2)) == 0


def test_skewed_product_is_split_at_run_time(spark):
    """Beyond the broadcast size, a product with a third of all items is split."""
    session = session_with(
        spark,
        {
            BROADCAST_THRESHOLD: NO_BROADCAST,
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        },
    )
    items = session.range(60_000, numPartitions=8).selectExpr(
        "id AS order_id",
        "IF(id % 3 = 0, 1, id) AS product_id",
        "CAST(1 AS DECIMAL(18,2)) AS line_total",
        "1 AS quantity",
    )
    products = session.range(60_000).selectExpr(
        "id AS product_id", "concat('c', id % 5) AS category"
    )
    orders = session.range(60_000).selectExpr(
        "id AS order_id", "timestamp_ntz'2024-01-01 00:00:00' AS order_timestamp"
    )
    daily = gold.daily_sales(orders, items, products)
    rows = daily.collect()
    assert sum(row.total_orders for row in rows) == 60_000
    assert "SortMergeJoin(skew=true)" in plan_text(daily)


def test_skewed_order_is_split_below_the_aggregate_of_joined_rows(spark):
    """Under default settings but for sizes that suit a small table."""
    settings = {
        BROADCAST_THRESHOLD: NO_BROADCAST,
        SHUFFLE_PARTITIONS: "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    session = session_with(spark, settings)
    items = session.range(60_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 1, id) AS order_id",
        "id % 10 AS product_id",
        "CAST(1 AS DECIMAL(18,2)) AS line_total",
        "1 AS quantity",
    )
    products = session.range(10).selectExpr("id AS product_id", "'all' AS category")
    orders = session.range(60_000).selectExpr(
        "id AS order_id", "timestamp_ntz'2024-01-01 00:00:00' AS order_timestamp"
    )
    with_items = gold.join_on(orders, items, "order_id")
    joined = with_items.join(F.broadcast(products), "product_id").withColumn(
        "order_date", F.to_date("order_timestamp")
    )
    daily = gold.summarise_sales(joined)
    row = daily.collect()[0]
    assert (row.total_items_sold, row.total_orders) == (60_000, 40_000)
    assert "SortMergeJoin(skew=true)" in plan_text(daily)


def test_jobs_run_together(spark):
    counts = together(spark, ["3", "5"], lambda name: spark.range(int(name)).count())
    assert counts == {"3": 3, "5": 5}
    with pytest.raises(ValueError, match="no number"):
        together(spark, ["no number"], fail)


def fail(name):
    raise ValueError(name)


def test_large_job_settings_keep_the_partition_size():
    scan = "spark.sql.files.maxPartitionBytes"
    sizes = {size: large_job_settings(size) for size in (1, 10**12, 10**14)}
    assert [sizes[size][SHUFFLE_PARTITIONS] for size in sizes] == ["200", "7451", "745059"]
    assert {sizes[size][scan] for size in sizes} == {"134217728"}
    assert large_job_settings(10**14, 2**30)[SHUFFLE_PARTITIONS] == "93133"


def test_executed_plans_are_walked_not_counted_in_their_text(spark):
    """The text of a frame that has run holds its final and its first plan."""
    daily = queries.daily_sales(spark, FOLDER)
    planned = plan_summary(daily)
    daily.collect()
    executed = plan_summary(daily)
    assert join_counts(daily) == {"BroadcastHashJoin": 2, "SortMergeJoin": 0}
    assert (planned.broadcast_joins, planned.shuffles, planned.final) == (2, 2, False)
    assert (executed.broadcast_joins, executed.shuffles, executed.final) == (2, 2, True)
    assert executed.coalesced_reads > 0 == planned.coalesced_reads
    given = [node.rows for node in plan_nodes(daily) if node.name == "HashAggregate"]
    assert given[0] == daily.count()


def test_a_join_that_changes_at_run_time_counts_as_what_it_became(spark):
    session = session_with(
        spark,
        {BROADCAST_THRESHOLD: "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760"},
    )
    left = session.range(10_000).selectExpr("id", "id % 10 AS k")
    right = session.range(10_000).where("id % 100 = 0").withColumnRenamed("id", "k")
    joined = left.join(right, "k")
    assert join_counts(joined) == {"BroadcastHashJoin": 0, "SortMergeJoin": 1}
    assert joined.count() == len(joined.collect()) == 1_000
    assert join_counts(joined) == {"BroadcastHashJoin": 1, "SortMergeJoin": 0}


def test_plans_without_adaptive_execution_and_reused_shuffles(spark):
    session = session_with(spark, {ADAPTIVE: "false", BROADCAST_THRESHOLD: NO_BROADCAST})
    counts = session.range(1_000).selectExpr("id % 7 AS k").groupBy("k").count()
    joined = counts.join(counts.withColumnRenamed("count", "n"), "k")
    summary = plan_summary(joined)
    assert (summary.sort_merge_joins, summary.final) == (1, True)
    names = [node.name for node in plan_nodes(joined)]
    assert names.count("ShuffleExchange") + names.count("ReusedExchange") == 2


def sales_with_hot_order(spark, rows=30_000):
    items = spark.range(rows).selectExpr(
        "IF(id % 3 = 0, 1, id % 2000) AS order_id",
        "id % 40 AS product_id",
        "CAST(id % 50 + 1 AS DECIMAL(18,2)) AS line_total",
        "CAST(id % 4 + 1 AS INT) AS quantity",
    )
    orders = spark.range(2_000).selectExpr(
        "id AS order_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 30) AS order_timestamp",
    )
    products = spark.range(40).selectExpr("id AS product_id", "concat('c', id % 3) AS category")
    return orders, items, products


def test_bucketed_tables_join_without_a_shuffle(spark):
    orders, items, products = sales_with_hot_order(spark)
    tables = bucketed.store_bucketed(orders, items, 8)
    assert {row.order_id for row in spark.table(tables.apart).distinct().collect()} == {1}
    assert not spark.table(tables.items).where("order_id = 1").count()
    merge = session_with(spark, {BROADCAST_THRESHOLD: NO_BROADCAST})
    daily = bucketed.daily_sales(merge, tables, products)
    for _ in range(2):
        nodes = list(plan_nodes(daily))
        place = next(i for i, node in enumerate(nodes) if node.name == "SortMergeJoin")
        below = []
        for node in nodes[place + 1 :]:
            if node.depth <= nodes[place].depth:
                break
            below.append(node.name)
        assert below.count("FileSourceScan") == 2
        assert not {"ShuffleExchange", "ReusedExchange", "AQEShuffleRead"} & set(below)
        got = {tuple(row) for row in daily.collect()}
    expected = gold.daily_sales(orders, items, products, orders_are_unique=True)
    assert got == {tuple(row) for row in expected.select(*daily.columns).collect()}
    bucketed.drop_bucketed(spark, tables)
    assert not spark.catalog.tableExists(tables.items)


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    orders, items, products = sales_with_hot_order(spark)
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", items.count() // 19)
    tables = bucketed.store_bucketed(orders, items, 8)
    assert tables.buckets == 20
    largest = spark.table(tables.items).groupBy(F.input_file_name()).count().agg(F.max("count"))
    assert largest.first()[0] < 2 * bucketed.BUCKET_ROWS
    daily = bucketed.daily_sales(spark, tables, products)
    expected = gold.daily_sales(orders, items, products, orders_are_unique=True)
    assert set(map(tuple, daily.collect())) == {
        tuple(row) for row in expected.select(*daily.columns).collect()
    }
    bucketed.drop_bucketed(spark, tables)


def test_bounded_tasks_keep_what_is_smaller_already(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(20_000, numPartitions=1).write.option("parquet.block.size", 4_096).parquet(path)
    monkeypatch.setattr(settings, "TASK_BYTES", 8_192)
    session = settings.bounded_session(spark, path)
    assert session.read.parquet(path).rdd.getNumPartitions() >= 4
    assert int(session.conf.get(settings.SHUFFLE_PARTITIONS)) >= 30
    smaller = session_with(spark, {settings.SHUFFLED_BYTES: "1k"})
    bounded = settings.bounded_session(smaller, path)
    assert bounded.conf.get(settings.SHUFFLED_BYTES) == "1024b"
    assert bounded.conf.get(settings.SCAN_BYTES) == "8192b"


def test_layers_are_made_in_bounded_tasks(spark, tmp_path, monkeypatch):
    layers = Layers.under(str(tmp_path))
    sold = spark.range(8_000).selectExpr(
        "id AS order_item_id", "id % 500 AS order_id", "id % 40 AS product_id", "1 AS quantity",
        "2.5 AS unit_price", "2.5 AS line_total",
    )
    write_csv(sold, layers.raw_file("order_items"))
    bronze.ingest_dataset(spark, "order_items", layers)
    monkeypatch.setattr(settings, "TASK_BYTES", 8_192)
    small = session_with(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"})
    assert silver.process_dataset(small, "order_items", layers) == 8_000
    # A file a task; the given session has eight shuffle partitions.
    assert len(read_table(spark, f"{layers.silver}/order_items").inputFiles()) > 8


def test_a_filter_reads_few_rows_of_a_clustered_table(spark, tmp_path):
    rows = spark.range(100_000).selectExpr(
        "id", "date_add(date'2020-01-01', CAST(id * 7919 % 1000 AS INT)) AS day", "concat('c', id % 5) AS c"
    )
    path = str(tmp_path / "clustered")
    assert layout.write_clustered(rows, path, "day", "c", group_rows=1_000) == 100_000
    plain = str(tmp_path / "plain")
    rows.write.option("parquet.block.row.count.limit", 1_000).parquet(plain)

    def read(folder, condition):
        found = spark.read.parquet(folder).where(condition)
        return len(found.collect()), scanned_rows(found)

    ranges = ["day = '2021-01-01'", "day BETWEEN '2021-01-01' AND '2021-01-31'", "day >= '2021-01-01'"]
    scans = []
    for condition in ranges:
        got, scanned = read(path, condition)
        assert (got, 100_000) == read(plain, condition)
        assert got <= scanned <= got + 2_000 + 1_000 * 8
        scans.append(scanned)
    assert scans == sorted(scans) and scans[0] <= 3_000
    got, scanned = read(path, "day BETWEEN '2021-01-01' AND '2021-03-31' AND c = 'c1'")
    assert scanned < 4 * got + 3_000


def test_plan_text_shows_all_stages(spark):
    text = plan_text(spark.range(5).filter("id > 2"), "extended")
    for stage in ("Parsed", "Analyzed", "Optimized", "Physical"):
        assert stage in text


def test_timing():
    calls = []
    result, seconds = timed(lambda: calls.append(1) or "done")
    assert result == "done" and seconds >= 0
    medians = compare({"a": lambda: calls.append("a"), "b": lambda: calls.append("b")}, 3)
    assert set(medians) == {"a", "b"}
    assert "".join(calls[1:]) == "ab" + "ab" + "ba" + "ab"

"""Every query by name. Each takes a session and a folder of test tables.

All of them read their tables whole. Those that go through files write below the
shared folder, each run to a path of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lamina.functions import positive, present, random_salt, salted_key, steady_salt
from lamina.model import (
    DAILY_SALES,
    DATASETS,
    DEFAULT_BATCH_ID,
    HOT_CATEGORY,
    HOT_PROVINCE,
    HOT_PROVINCE_PERCENT,
    PROCESSED_AT,
    PROVINCES,
    RAW_SCHEMAS,
    Layers,
)
from lamina.operators import (
    bronze,
    bucketed,
    derive,
    distinct,
    drift,
    gold,
    heavy,
    layout,
    profile,
    silver,
    skew,
)
from lamina.operators.dedupe import smallest_per_key
from lamina.operators.reuse import kept
from lamina.plans.joins import broadcast_within
from lamina.plans.report import join_counts, plan_summary, report_frame, scanned_rows
from lamina.plans.settings import (
    ADAPTIVE,
    BROADCAST_THRESHOLD,
    DEFAULT_BROADCAST_BYTES,
    NO_BROADCAST,
    SHUFFLE_PARTITIONS,
    bounded_session,
    session_with,
)
from lamina.plans.together import together
from lamina.sources import (
    current_path,
    fresh_path,
    read_csv,
    read_table,
    stored,
    versions,
    write_csv,
    write_table,
)
from lamina.workload import feeds

Query = Callable[[SparkSession, str], DataFrame]

PARTITIONS = 8
PRICE_COLUMNS = ("unit_price", "line_total")
#: The largest partition of a placement in pieces may hold this many times the mean.
EVEN = 1.5
COUNTED_CATEGORY = "economy"
#: A heavy key holds more than one part of so many of all rows.
HEAVY_PIECES = 1_000


# Daily sales and its physical variants


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_sales(
        feeds.orders(spark, folder),
        feeds.order_items(spark, folder),
        feeds.products(spark, folder),
        orders_are_unique=True,
    )


def daily_sales_with(settings: dict[str, str]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return daily_sales(session_with(spark, settings), folder)

    return query


def daily_sales_broadcast_hint(spark: SparkSession, folder: str) -> DataFrame:
    """Sort-merge everywhere but for the products, which measure small."""
    session = session_with(spark, {BROADCAST_THRESHOLD: NO_BROADCAST})
    categories = feeds.products(session, folder).select("product_id", "category")
    return gold.daily_sales(
        feeds.orders(session, folder),
        feeds.order_items(session, folder),
        broadcast_within(categories),
        orders_are_unique=True,
    )


def cached_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """Two counts and the daily table from one joined frame that is kept meanwhile."""
    needed = joined_sales(spark, folder).select(
        "order_date", "category", "order_id", "line_total", "quantity"
    )
    with kept(needed) as held:
        joined_rows = held.count()
        counted = gold.count_equal(held, "category", COUNTED_CATEGORY).first()["row_count"]
        daily = stored(gold.summarise_sales(held), "cached-daily-sales")
    return daily.withColumns(
        {
            "joined_rows": F.lit(joined_rows).cast("bigint"),
            "category_rows": F.lit(counted).cast("bigint"),
        }
    )


def plan_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per variant the joins that Spark plans, and what the variant computes."""
    variants = {
        "sort_merge": daily_sales_with({BROADCAST_THRESHOLD: NO_BROADCAST}),
        "broadcast_hint": daily_sales_broadcast_hint,
    }
    return _union(
        [_planned(query(spark, folder), variant) for variant, query in variants.items()]
    )


def _planned(daily: DataFrame, variant: str) -> DataFrame:
    joins = join_counts(daily)
    return daily.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("total_items_sold").alias("items_sold"),
    ).select(
        F.lit(variant).alias("variant"),
        F.lit(joins["BroadcastHashJoin"]).cast("bigint").alias("broadcast_joins"),
        F.lit(joins["SortMergeJoin"]).cast("bigint").alias("sort_merge_joins"),
        "row_count",
        "items_sold",
    )


def executed_plan_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per variant the joins that Spark plans and those that have run, and the rows they gave."""
    variants = {
        "sort_merge": daily_sales_with({BROADCAST_THRESHOLD: NO_BROADCAST}),
        "automatic": daily_sales_with({BROADCAST_THRESHOLD: DEFAULT_BROADCAST_BYTES}),
        "broadcast_hint": daily_sales_broadcast_hint,
    }
    rows = []
    for variant, query in variants.items():
        daily = query(spark, folder)
        planned = plan_summary(daily)
        given = len(daily.toArrow())
        for phase, plan, seen in (("planned", planned, None), ("executed", plan_summary(daily), given)):
            joins = (plan.broadcast_joins, plan.sort_merge_joins)
            rows.append((variant, phase, *joins, plan.final, str(seen)))
    return report_frame(
        spark,
        rows,
        "variant string, phase string, broadcast_joins bigint, sort_merge_joins bigint, "
        "final boolean, row_count string",
    )


def sales_in_one_pass(spark: SparkSession, folder: str) -> DataFrame:
    """Sums by day and category, by category and in all, and two counts, from one scan."""
    session = _bounded(spark, folder, "orders", "lineitem", "part")
    needed = joined_sales(session, folder).select(
        "order_date", "category", "order_id", "line_total", "quantity"
    )
    levels, rows, of_category = gold.sales_in_one_pass(needed, COUNTED_CATEGORY)
    return levels.withColumns(
        {
            "joined_rows": F.lit(rows).cast("bigint"),
            "category_rows": F.lit(of_category).cast("bigint"),
        }
    )


def orders_by_level(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct orders by day, month, category and in all, from stored bitmaps."""
    numbers = distinct.number_orders(feeds.orders(spark, folder))
    bitmaps = distinct.order_bitmaps(
        numbers, feeds.order_items(spark, folder), feeds.products(spark, folder)
    )
    return distinct.orders_by_level(stored(bitmaps, "order-bitmaps"))


def bucketed_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales from bucketed tables, with an order that holds a third of all items."""
    session = _bounded(spark, folder, "orders", "lineitem", "part")
    tables = bucketed.store_bucketed(
        feeds.orders(session, folder), feeds.items_with_hot_order(session, folder), PARTITIONS
    )
    return bucketed.daily_sales(session, tables, feeds.products(session, folder))


def _bounded(spark: SparkSession, folder: str, *tables: str) -> SparkSession:
    return bounded_session(spark, *[f"{folder}/{name}.parquet" for name in tables])


# Joins, counts, sorts


def joined_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.joined_sales(
        feeds.orders(spark, folder),
        feeds.order_items(spark, folder),
        feeds.products(spark, folder),
    )


def join_orders_items_products(spark: SparkSession, folder: str) -> DataFrame:
    return joined_sales(spark, folder).select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        "order_date",
        "order_status",
        "category",
        "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("line_total").cast("double").alias("line_total"),
    )


def join_items_products(spark: SparkSession, folder: str) -> DataFrame:
    joined = gold.join_on(
        feeds.order_items(spark, folder), feeds.products(spark, folder), "product_id"
    )
    return joined.select(
        "order_item_id",
        "product_id",
        "product_name",
        "category",
        "brand",
        "quantity",
        F.col("line_total").cast("double").alias("line_total"),
    )


def category_total_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.sales_per_category(daily_sales(spark, folder))


def category_sales_shuffle(partitions: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        session = session_with(spark, {SHUFFLE_PARTITIONS: str(partitions)})
        return category_total_sales(session, folder)

    return query


def product_count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return gold.count_per_key(feeds.products(spark, folder), "category")


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = [
        gold.count_rows(feed(spark, folder), name)
        for name, feed in feeds.CLEAN_FEEDS.items()
    ]
    return _union([*counted, gold.count_rows(daily_sales(spark, folder), DAILY_SALES)])


def orders_per_day(spark: SparkSession, folder: str) -> DataFrame:
    dated = feeds.orders(spark, folder).select(
        F.to_date("order_timestamp").alias("order_date")
    )
    return gold.count_per_key(dated, "order_date")


def filter_equals_count(spark: SparkSession, folder: str) -> DataFrame:
    return gold.count_equal(joined_sales(spark, folder), "category", COUNTED_CATEGORY)


def top20_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.top_days(daily_sales(spark, folder), 20)


# Cleaning


def dedupe_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = feeds.table(spark, folder, "lineitem")
    return smallest_per_key(lines, ["l_orderkey", "l_linenumber"])


def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    items = feeds.raw_order_items(spark, folder)
    kept = items.filter(present("order_item_id", "order_id", "product_id"))
    return _comparable(kept, "quantity")


def filter_positive(spark: SparkSession, folder: str) -> DataFrame:
    items = feeds.raw_order_items(spark, folder)
    kept = items.filter(positive(items, "quantity", "unit_price"))
    return _comparable(kept, "order_id", "product_id")


def standardize_strings(spark: SparkSession, folder: str) -> DataFrame:
    rules = silver.CLEANING["customers"]
    standard = silver.standardise(feeds.raw_customers(spark, folder), rules)
    return _comparable(standard, "customer_id")


def recompute_line_total(spark: SparkSession, folder: str) -> DataFrame:
    items = feeds.raw_order_items(spark, folder)
    return _comparable(
        silver.recompute_line_total(items), "order_id", "product_id", "quantity"
    )


def silver_dataset(dataset: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        cleaned = silver.clean(feeds.RAW_FEEDS[dataset](spark, folder), dataset)
        stamped = F.col(PROCESSED_AT).isNotNull().alias("stamped")
        nullable = ["product_id"] if dataset == "products" else []
        return _comparable(cleaned.select("*", stamped).drop(PROCESSED_AT), *nullable)

    return query


# Raw files, bronze, whole way to gold


def bronze_audit(spark: SparkSession, folder: str) -> DataFrame:
    audited = bronze.with_audit_columns(
        feeds.orders(spark, folder), "orders", DEFAULT_BATCH_ID
    )
    return _comparable(
        audited.withColumns(
            {
                "source_file": F.element_at(F.split("source_file", "/"), -1),
                "stamped": F.col("ingestion_timestamp").isNotNull(),
            }
        ).drop("ingestion_timestamp")
    )


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Per dataset the batch, its rows and those that have a time and a source file."""
    layers = _landed(spark, folder)
    bronze.ingest_all(spark, layers)
    return _union(
        [
            read_table(spark, f"{layers.bronze}/{name}")
            .groupBy("source_system", "batch_id")
            .agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count("ingestion_timestamp").alias("stamped_rows"),
                F.count_if(F.col("source_file").contains(f"/raw/{name}/{name}.csv/")).alias(
                    "traced_rows"
                ),
            )
            for name in DATASETS
        ]
    )


def validate_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze tables pass; the raw files, which have no lineage columns, do not."""
    layers = _landed(spark, folder)
    bronze.ingest_all(spark, layers)
    return _union(
        [
            report.withColumn("layer", F.lit(layer))
            for name in DATASETS
            for layer, report in (
                ("bronze", bronze.validate_dataset(spark, name, layers)),
                ("raw", bronze.validation_row(_raw_csv(spark, layers, name), name)),
            )
        ]
    )


def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    return _union(
        [
            bronze.schema_report(feed(spark, folder), name)
            for name, feed in feeds.RAW_FEEDS.items()
        ]
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "orders-csv")
    write_csv(feeds.raw_orders(spark, folder), path)
    read = read_csv(spark, path, RAW_SCHEMAS["orders"])
    return _comparable(read, "order_id", "customer_id", "store_id")


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "items-csv")
    write_csv(feeds.raw_order_items(spark, folder), path)
    inferred = read_csv(spark, path)
    kinds = {field.name: field.dataType.simpleString() for field in inferred.schema}
    shown = inferred.withColumns(
        {f"{name}_type": F.lit(kinds[name]) for name in inferred.columns}
    )
    return _comparable(
        shown.withColumns({name: F.col(name).cast("double") for name in PRICE_COLUMNS}).withColumn(
            "order_item_id", F.col("order_item_id").cast("bigint")
        ),
        "order_id",
        "product_id",
        "quantity",
    )


def overwrite_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The second table replaces the first, whatever columns that one had."""
    path = fresh_path(spark, "overwritten")
    write_table(feeds.products(spark, folder), path)
    write_table(feeds.customers(spark, folder), path)
    return read_table(spark, path)


def replacement_history(spark: SparkSession, folder: str) -> DataFrame:
    """The versions of a table that was replaced twice, and which one readers get.

    A frame made before a replacement keeps to its version.
    """
    path = fresh_path(spark, "replaced")
    write_table(feeds.products(spark, folder), path)
    before = read_table(spark, path)
    write_table(feeds.orders(spark, folder), path)
    write_table(feeds.order_items(spark, folder), path)
    rows = [
        (version.number, spark.read.parquet(version.path).count(), version.path == current_path(spark, path))
        for version in versions(spark, path)
    ]
    history = report_frame(spark, rows, "number bigint, row_count bigint, is_current boolean")
    return history.withColumn("first_reader_rows", F.lit(before.count()).cast("bigint"))


def batch_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of items; the second comes again, corrected, and takes its own place only."""
    layers = Layers.under(fresh_path(spark, "layers"))
    items = feeds.raw_order_items(spark, folder)
    odd = F.col("order_item_id") % 2 == 1
    deliveries = [
        ("2024-05-01", items.where(~odd)),
        ("2024-05-02", items.where(odd)),
        ("2024-05-02", items.where(odd & (F.col("unit_price") > 0))),
    ]
    for number, (batch, rows) in enumerate(deliveries):
        raw = f"{layers.raw}/delivery-{number}"
        write_csv(rows, raw)
        bronze.load_batch(spark, "order_items", layers, batch, raw)
    loaded = bronze.read_batches(spark, "order_items", layers)
    return loaded.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("order_item_id").alias("sum_of_ids"),
        F.count_if(F.col("unit_price") > 0).alias("priced_rows"),
    )


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of items that a source system dropped, added or retyped in some deliveries."""
    path = fresh_path(spark, "deliveries")
    items = feeds.raw_order_items(spark, folder)
    part = F.col("order_item_id") % 4
    deliveries = {
        "as_declared": items.where(part == 0),
        "renamed": items.where(part == 1).withColumnRenamed("quantity", "qty"),
        "retyped": items.where(part == 2).withColumn("unit_price", F.col("unit_price").cast("double")),
        "extended": items.where(part == 3).withColumn("currency", F.lit("CAD")),
    }
    for name, rows in deliveries.items():
        rows.write.parquet(f"{path}/{name}")
    found = drift.schema_drift(spark, path, RAW_SCHEMAS["order_items"])
    return found.select(
        F.substring_index("file", "/", 1).alias("delivery"),
        "column_name",
        "finding",
        F.coalesce("declared_type", F.lit("none")).alias("declared_type"),
        F.coalesce("found_type", F.lit("none")).alias("found_type"),
    ).distinct()


def sketched_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of items from merged sketches of three batches, held against exact figures."""
    columns = ["order_id", "product_id", "quantity", "line_total"]
    items = stored(feeds.order_items(spark, folder).select("order_item_id", *columns), "profiled")
    batches = [items.where(F.col("order_item_id") % 3 == part) for part in range(3)]
    sketches = stored(
        _union([profile.column_sketches(batch, *columns) for batch in batches]), "column-sketches"
    )
    found = stored(
        profile.sketched_profile(profile.merged_sketches(sketches), 0.5), "column-profile"
    )
    return _union([_held_against(found, items, name) for name in columns])


def _held_against(found: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """One column's estimates, and whether they are as close as the sketches promise."""
    row = found.where(F.col("column_name") == name).first()
    value = F.col(name).cast("double")
    median = row["quantiles"][0]
    below, up_to = F.count_if(value < median), F.count_if(value <= median)
    rows, error = F.count(value), profile.QUANTILE_ERROR
    exact = items.select(name).where(F.col(name).isNotNull()).distinct().count()
    distinct_within = abs(exact - row["distinct_values"]) <= profile.DISTINCT_ERROR * exact
    return items.agg(
        F.lit(name).alias("column_name"),
        F.lit(row["row_count"]).cast("bigint").alias("row_count"),
        rows.alias("value_count"),
        F.lit(distinct_within).alias("distinct_within"),
        ((below <= (0.5 + error) * rows) & (up_to >= (0.5 - error) * rows)).alias("median_within"),
    )


def bronze_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per dataset, and those whose record is kept since a value is unreadable."""
    layers = _landed(spark, folder, _with_bad_values)
    bronze.ingest_all(spark, layers)
    return _union([bronze.rejects(spark, name, layers) for name in DATASETS])


def _with_bad_values(df: DataFrame, dataset: str) -> DataFrame:
    """Some quantities of items and dates of customers as text that cannot be read."""
    if dataset == "order_items":
        bad = F.col("order_item_id") % 10 == 3
        return df.withColumn(
            "quantity", F.when(bad, F.lit("N/A")).otherwise(F.col("quantity").cast("string"))
        )
    if dataset == "customers":
        bad = F.col("is_active") & (F.col("signup_date") >= F.lit("2023-01-01").cast("date"))
        return df.withColumn(
            "signup_date", F.when(bad, F.lit("soon")).otherwise(F.col("signup_date").cast("string"))
        )
    return df


def inferred_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Items with some unreadable quantities, read with inferred types, cleaned, by type."""
    layers = _landed(spark, folder, _with_bad_values)
    bronze.ingest_dataset(spark, "order_items", layers, infer_types=True)
    silver.process_dataset(spark, "order_items", layers)
    cleaned = read_table(spark, f"{layers.silver}/order_items")
    kinds = {field.name: field.dataType.simpleString() for field in cleaned.schema}
    columns = ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"]
    shown = cleaned.select(*columns).withColumns(
        {f"{name}_type": F.lit(kinds[name]) for name in columns[3:]}
    )
    return _comparable(shown)


def products_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.products_profile(_whole(feeds.products(spark, folder)))


def gold_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.gold_profile(_whole(daily_sales(spark, folder)))


def _whole(df: DataFrame) -> DataFrame:
    """The rows as a table of eight partitions, which the profiles show."""
    return stored(df, "profiled").repartition(PARTITIONS)


def raw_to_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files through bronze and silver to the stored daily table."""
    layers = _landed(spark, folder)
    bronze.ingest_all(spark, layers)
    for name in DATASETS:
        bronze.validate_dataset(spark, name, layers)
    silver.process_all(spark, layers)
    gold.build_daily_sales(spark, layers)
    return read_table(spark, f"{layers.gold}/{DAILY_SALES}")


def _landed(
    spark: SparkSession,
    folder: str,
    change: Callable[[DataFrame, str], DataFrame] = lambda df, dataset: df,
) -> Layers:
    """Layers whose raw files hold what the source systems deliver, changed if need be."""
    layers = Layers.under(fresh_path(spark, "layers"))

    def land(name: str) -> None:
        write_csv(change(feeds.RAW_FEEDS[name](spark, folder), name), layers.raw_file(name))

    together(spark, DATASETS, land)
    return layers


def _raw_csv(spark: SparkSession, layers: Layers, dataset: str) -> DataFrame:
    return read_csv(spark, layers.raw_file(dataset), RAW_SCHEMAS[dataset])


# Skew and layout


def hot_key_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.skewed_products(spark, folder).select("product_id", "category", "brand")


def hot_region_assignment(spark: SparkSession, folder: str) -> DataFrame:
    province = derive.hot_or_other(
        F.col("customer_id"), PROVINCES, HOT_PROVINCE, HOT_PROVINCE_PERCENT
    )
    return feeds.customers(spark, folder).select(
        "customer_id", "last_name", province.alias("province")
    )


def skewed_items(spark: SparkSession, folder: str) -> DataFrame:
    return gold.join_on(
        feeds.order_items(spark, folder), feeds.skewed_products(spark, folder), "product_id"
    )


def salted_items(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The hot category in as many salts as its measured share calls for.

    The rows are measured and used, so the asked columns of the join are stored.
    """
    needed = dict.fromkeys(["category", "order_item_id", *columns])
    items = stored(skewed_items(spark, folder).select(*needed), "items-to-salt")
    salts = skew.salts_for(items, "category", HOT_CATEGORY, PARTITIONS)
    salt = steady_salt(F.col("order_item_id"), salts)
    return items.withColumn("salted_category", salted_key(F.col("category"), HOT_CATEGORY, salt))


def hot_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with more than a thousandth of all items; one holds a third of them."""
    return heavy.heavy_keys(feeds.items_with_hot_order(spark, folder), "order_id", HEAVY_PIECES)


def hot_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with more than a thousandth of all orders, of sketches made batch by batch."""
    orders = feeds.orders(spark, folder)
    batches = [orders.where(F.col("order_id") % 3 == part) for part in range(3)]
    sketches = stored(
        _union([heavy.key_sketches(batch, "customer_id", HEAVY_PIECES) for batch in batches]),
        "batch-sketches",
    )
    merged = stored(heavy.combined(sketches), "merged-sketches")
    return heavy.heavy_keys(orders, "customer_id", HEAVY_PIECES, merged)


def category_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return skew.key_distribution(skewed_items(spark, folder), "category")


def skew_report(spark: SparkSession, folder: str) -> DataFrame:
    return skew.skew_report(skewed_items(spark, folder), "category")


def salted_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per category, its salted keys, and whether the largest is near their mean."""
    parts = skew.key_distribution(
        salted_items(spark, folder).select("category", "salted_category"), "salted_category"
    )
    category = F.when(
        F.col("salted_category").startswith(f"{HOT_CATEGORY}_"), HOT_CATEGORY
    ).otherwise(F.col("salted_category"))
    return parts.groupBy(category.alias("category")).agg(
        F.sum("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("salted_keys"),
        (F.max("row_count") <= 2 * F.avg("row_count")).alias("even"),
    )


def salted_placement(spark: SparkSession, folder: str) -> DataFrame:
    """Items really placed by category, by salted category and in pieces.

    Each must keep the largest partition within a bound, as a ratio to the mean: by
    category the hot one is in one partition, salted it is spread but the others stay
    whole, and in pieces all are near the mean.
    """
    columns = ["category", "salted_category", "order_item_id"]
    salted = stored(salted_items(spark, folder).select(*columns), "salted-items")
    pieces = skew.split_hot_keys(
        salted, "category", PARTITIONS, F.col("order_item_id"), run_once=False
    )
    hot_rows = salted.where(F.col("category") == HOT_CATEGORY).count()
    placements = {
        "category": ["category"],
        "salted_category": ["salted_category"],
        "category_and_piece": ["category", "piece"],
    }
    report = skew.placement_report(stored(pieces, "pieces"), PARTITIONS, placements)
    name = F.col("placed_by")
    bound = F.when(name == "category", PARTITIONS).when(name == "salted_category", 2.5)
    return report.select(
        "placed_by",
        "partitions",
        "row_count",
        (F.col("max_rows") >= hot_rows).alias("hot_key_in_one"),
        bound.otherwise(EVEN).cast("double").alias("bound"),
        (F.col("max_to_mean") <= bound.otherwise(EVEN)).alias("within_bound"),
    )


def random_salt_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per category and the number of salted keys they are spread over."""
    items = stored(skewed_items(spark, folder).select("category"), "items-to-salt")
    salts = skew.salts_for(items, "category", HOT_CATEGORY, PARTITIONS, finer=1)
    salted = salted_key(F.col("category"), HOT_CATEGORY, random_salt(salts, seed=7))
    keyed = items.select("category", salted.alias("salted_category"))
    counted = keyed.groupBy("category", "salted_category").agg(
        F.count(F.lit(1)).alias("part_rows")
    )
    return counted.groupBy("category").agg(
        F.sum("part_rows").alias("row_count"), F.count(F.lit(1)).alias("salted_keys")
    )


def salted_two_stage_agg(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["category", "order_id", "line_total", "quantity"]
    items = stored(skewed_items(spark, folder).select(*columns), "items-to-salt")
    salts = skew.salts_for(items, "category", HOT_CATEGORY, _shuffle_partitions(spark))
    return skew.salted_sales(items, "category", "order_id", salts)


def split_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per category, and whether its largest piece is near an even share."""
    partitions = _shuffle_partitions(spark)
    split = _split_items(spark, folder, partitions)
    pieces = stored(
        split.groupBy("category", "piece").agg(F.count(F.lit(1)).alias("part_rows")),
        "pieces",
    )
    even_share = pieces.agg(F.sum("part_rows") / (partitions * skew.FINER)).scalar()
    return pieces.groupBy("category").agg(
        F.sum("part_rows").alias("row_count"),
        (F.max("part_rows") <= 2 * even_share + 5 * F.sqrt(even_share) + 2).alias(
            "pieces_are_small"
        ),
    )


def key_colocation(spark: SparkSession, folder: str) -> DataFrame:
    """Rows placed by category, the hot ones in pieces: no piece is in two partitions."""
    partitions = _shuffle_partitions(spark)
    split = _split_items(spark, folder, partitions)
    placed = split.repartition(partitions, "category", "piece")
    return (
        layout.key_partitions(placed, "category", "piece")
        .groupBy("category")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.max("partitions").alias("partitions_per_piece"),
        )
    )


def _split_items(spark: SparkSession, folder: str, partitions: int) -> DataFrame:
    items = skewed_items(spark, folder).select("category", "order_item_id")
    return skew.split_hot_keys(items, "category", partitions, F.col("order_item_id"))


def partition_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Items dealt out evenly over as many partitions as the session shuffles into."""
    partitions = _shuffle_partitions(spark)
    dealt = skewed_items(spark, folder).repartition(partitions)
    stats = layout.partition_stats(layout.partition_sizes(dealt, partitions))
    return stats.select(
        "row_count",
        (F.col("partitions") == partitions).alias("as_asked"),
        (F.col("min_rows") > 0).alias("none_empty"),
    )


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(SHUFFLE_PARTITIONS))


def observed_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Items written by category, their partitions counted meanwhile and once more afterwards."""
    placed = skewed_items(spark, folder).select("category", "order_item_id")
    placed = placed.repartition(PARTITIONS, "category")
    seen = stored(layout.write_observed(placed, fresh_path(spark, "observed") + "/rows"), "sizes")
    again = layout.partition_sizes(placed)
    same = seen.exceptAll(again).isEmpty() and again.exceptAll(seen).isEmpty()
    return seen.agg(
        F.sum("row_count").alias("row_count"), F.lit(same).alias("same_as_counted")
    )


def clustered_days(spark: SparkSession, folder: str) -> DataFrame:
    """One category's sales in a quarter, read from a table that is clustered by day."""
    sold = joined_sales(spark, folder).select("order_date", "category", "order_id", "line_total")
    path = fresh_path(spark, "clustered") + "/rows"
    rows = layout.write_clustered(sold, path, "order_date", "category", group_rows=500)
    quarter = F.col("order_date").between(F.lit("1997-01-01"), F.lit("1997-03-31"))
    chosen = spark.read.parquet(path).where(quarter & (F.col("category") == COUNTED_CATEGORY))
    sales = chosen.groupBy("order_date").agg(
        F.sum("line_total").cast("double").alias("total_sales"),
        F.count(F.lit(1)).alias("row_count"),
    )
    sales.collect()  # a row a day of the quarter, for what the scan has counted
    return sales.withColumn("most_rows_skipped", F.lit(scanned_rows(sales) * 4 < rows))


def repartition_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The daily table, a row per day and category, dealt out over five partitions."""
    daily = daily_sales(spark, folder).repartition(5)
    return _evenness(layout.partition_sizes(daily, 5))


def coalesce_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The daily table in fifty partitions, of which ten each are read as one."""
    daily = daily_sales(spark, folder).repartition(50).coalesce(5)
    return _evenness(layout.partition_sizes(daily, 5))


def _evenness(sizes: DataFrame) -> DataFrame:
    """Partitions, rows, and whether the largest is at most a tenth above the mean."""
    mean_rows = F.col("row_count") / F.col("partitions")
    return layout.partition_stats(sizes).select(
        "partitions", "row_count", (F.col("max_rows") <= 1.1 * mean_rows).alias("even")
    )


# Derived data


def order_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Items of the raw orders, of which some have none."""
    return derive.order_fanout(_numbered_orders(spark, folder), feeds.products(spark, folder))


def _numbered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with 0 to 4 items, and every hundredth with 12."""
    few = F.when(F.col("order_id") % 100 == 0, F.lit(12)).otherwise(F.col("item_count") - 1)
    return feeds.orders(spark, folder).withColumn("item_count", few)


def price_lookup(spark: SparkSession, folder: str) -> DataFrame:
    items = order_fanout(spark, folder)
    return _comparable(derive.with_prices(items, feeds.products(spark, folder)))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _comparable(df: DataFrame, *nullable: str) -> DataFrame:
    """Decimals as doubles, and integers that may be missing as text.

    The results are compared across engines, whose clients show both differently; as text
    a missing integer stays missing.
    """
    kinds = {field.name: field.dataType for field in df.schema}
    decimals = [name for name, kind in kinds.items() if isinstance(kind, DecimalType)]
    return df.withColumns(
        {name: F.col(name).cast("double") for name in decimals}
        | {name: F.col(name).cast("string") for name in nullable}
    )


QUERIES: dict[str, Query] = {
    "daily_sales_by_category": daily_sales,
    "dedupe_by_key": dedupe_by_key,
    "filter_not_null": filter_not_null,
    "filter_positive": filter_positive,
    "standardize_strings": standardize_strings,
    "recompute_line_total": recompute_line_total,
    "silver_products": silver_dataset("products"),
    "silver_customers": silver_dataset("customers"),
    "silver_orders": silver_dataset("orders"),
    "silver_order_items": silver_dataset("order_items"),
    "bronze_audit": bronze_audit,
    "bronze_ingest": bronze_ingest,
    "validate_bronze": validate_bronze,
    "schema_report": schema_report,
    "csv_roundtrip": csv_roundtrip,
    "csv_inferred": csv_inferred,
    "overwrite_roundtrip": overwrite_roundtrip,
    "bronze_rejects": bronze_rejects,
    "inferred_to_silver": inferred_to_silver,
    "products_profile": products_profile,
    "gold_profile": gold_profile,
    "raw_to_gold": raw_to_gold,
    "join_orders_items_products": join_orders_items_products,
    "join_items_products": join_items_products,
    "category_total_sales": category_total_sales,
    "product_count_by_category": product_count_by_category,
    "row_counts": row_counts,
    "orders_per_day": orders_per_day,
    "filter_equals_count": filter_equals_count,
    "category_distribution": category_distribution,
    "top20_daily_sales": top20_daily_sales,
    "daily_sales_sort_merge": daily_sales_with({BROADCAST_THRESHOLD: NO_BROADCAST}),
    "daily_sales_auto_broadcast": daily_sales_with(
        {BROADCAST_THRESHOLD: DEFAULT_BROADCAST_BYTES}
    ),
    "daily_sales_broadcast_hint": daily_sales_broadcast_hint,
    "daily_sales_aqe_off": daily_sales_with({ADAPTIVE: "false"}),
    "daily_sales_aqe_on": daily_sales_with({ADAPTIVE: "true"}),
    "category_sales_shuffle_8": category_sales_shuffle(8),
    "category_sales_shuffle_200": category_sales_shuffle(200),
    "cached_reuse": cached_reuse,
    "plan_report": plan_report,
    "hot_key_assignment": hot_key_assignment,
    "hot_region_assignment": hot_region_assignment,
    "skew_report": skew_report,
    "salted_distribution": salted_distribution,
    "salted_placement": salted_placement,
    "random_salt_spread": random_salt_spread,
    "salted_two_stage_agg": salted_two_stage_agg,
    "split_hot_keys": split_hot_keys,
    "key_colocation": key_colocation,
    "partition_stats": partition_stats,
    "repartition_sizes": repartition_sizes,
    "coalesce_sizes": coalesce_sizes,
    "orders_by_level": orders_by_level,
    "hot_orders": hot_orders,
    "hot_customers": hot_customers,
    "replacement_history": replacement_history,
    "batch_replay": batch_replay,
    "bucketed_daily_sales": bucketed_daily_sales,
    "clustered_days": clustered_days,
    "executed_plan_report": executed_plan_report,
    "sales_in_one_pass": sales_in_one_pass,
    "sketched_profile": sketched_profile,
    "schema_drift": schema_drift,
    "observed_sizes": observed_sizes,
    "order_fanout": order_fanout,
    "price_lookup": price_lookup,
}

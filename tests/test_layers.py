"""Files, lineage columns, the shared folder and the jobs between the layers."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lamina.model import AUDIT_COLUMNS, DAILY_SALES, DATASETS, PROCESSED_AT, RAW_SCHEMAS, UNREADABLE, Layers
from lamina.operators import bronze, gold, silver
from lamina.operators.profile import products_profile
from lamina.sources import (
    fresh_path,
    held,
    read_csv,
    read_table,
    shared_folder,
    stored,
    write_csv,
    write_table,
)
from lamina.workload import feeds

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    built = Layers.under(str(tmp_path_factory.mktemp("layers")))
    for name, feed in feeds.RAW_FEEDS.items():
        write_csv(feed(spark, FOLDER), built.raw_file(name))
    return built


def test_single_file_with_quotes_and_padding(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text(
        "product_id,product_name,category,brand,unit_price,is_active\n"
        '1,  Red Bolt ,TOYS,"Smith, Jones and Co",5.25,True\n'
        "2,Blue Nut,home,Acme,bad,False\n"
    )
    declared = read_csv(spark, str(path), RAW_SCHEMAS["products"]).collect()
    assert declared[0].product_name == "  Red Bolt "
    assert declared[0].brand == "Smith, Jones and Co"
    assert declared[0].is_active is True
    assert declared[1].unit_price is None
    inferred = read_csv(spark, str(path))
    types = {field.name: field.dataType.simpleString() for field in inferred.schema}
    assert types["product_id"] == "int" and types["is_active"] == "boolean"
    assert types["unit_price"] == "string"


def test_times_with_a_space_or_a_letter_between_day_and_hour(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "order_id,customer_id,order_timestamp,store_id,order_status,payment_method,"
        "total_amount,item_count\n"
        "1,2,2023-05-04 23:59:59,3,pending,debit,12.34,2\n"
        "2,2,2023-05-04T23:59:59.000,3,pending,debit,1e3,2\n"
        "3,2,2023-05-04,3,pending,debit,7,many\n"
    )
    rows = read_csv(spark, str(path), RAW_SCHEMAS["orders"]).collect()
    last_second = dt.datetime(2023, 5, 4, 23, 59, 59)
    assert [row.order_timestamp for row in rows] == [
        last_second,
        last_second,
        dt.datetime(2023, 5, 4),
    ]
    assert [row.total_amount for row in rows] == [Decimal("12.34"), 1000, 7]
    assert [row.item_count for row in rows] == [2, 2, None]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("product_name,product_id,category,brand,unit_price,is_active\na,1,b,c,1,True\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(path), RAW_SCHEMAS["products"]).collect()


def test_ingest_adds_lineage_and_keeps_every_row(spark, layers):
    rows = bronze.ingest_all(spark, layers, batch_id="b7")
    for name in DATASETS:
        table = read_table(spark, f"{layers.bronze}/{name}")
        assert rows[name] == table.count() == feeds.RAW_FEEDS[name](spark, FOLDER).count()
        assert table.columns[-5:] == [*AUDIT_COLUMNS, UNREADABLE]
        seen = table.select("source_system", "batch_id").distinct().collect()
        assert [tuple(row) for row in seen] == [(name, "b7")]
        assert table.filter(~F.col("source_file").contains(f"{name}.csv")).count() == 0
        assert bronze.validate_dataset(spark, name, layers).first().passed


def test_inferred_types_clean_to_the_same_items(spark, layers, tmp_path):
    other = Layers(layers.raw, str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "g"))
    bronze.ingest_all(spark, layers)
    bronze.ingest_all(spark, other, infer_types=True)
    for name in DATASETS:
        assert silver.process_dataset(spark, name, layers) == silver.process_dataset(
            spark, name, other
        )
    assert gold.build_daily_sales(spark, layers) == gold.build_daily_sales(spark, other)
    ours = read_table(spark, f"{layers.gold}/{DAILY_SALES}")
    theirs = read_table(spark, f"{other.gold}/{DAILY_SALES}")
    assert ours.exceptAll(theirs).count() == 0
    assert [(field.name, field.dataType.simpleString()) for field in ours.schema] == [
        ("order_date", "date"),
        ("category", "string"),
        ("total_sales", "double"),
        ("total_items_sold", "bigint"),
        ("total_orders", "bigint"),
    ]
    assert PROCESSED_AT in read_table(spark, f"{layers.silver}/orders").columns


def test_validation_names_what_is_missing(spark, tmp_path):
    layers = Layers.under(str(tmp_path))
    partly = spark.range(3).withColumns({"batch_id": F.lit("x"), "source_file": F.lit("y")})
    write_table(partly, f"{layers.bronze}/orders")
    with pytest.raises(
        ValueError, match="orders lacks lineage columns: source_system, ingestion_timestamp"
    ):
        bronze.validate_dataset(spark, "orders", layers)


def test_lineage_needs_a_plain_scan(spark):
    with pytest.raises(ValueError, match="read from files"):
        bronze.with_audit_columns(spark.range(2), "orders", "b")
    scanned = bronze.with_audit_columns(
        read_table(spark, f"{FOLDER}/orders.parquet"), "orders", "b"
    )
    assert scanned.first().source_file.endswith("/orders.parquet")


def test_unreadable_records_keep_their_text(spark, tmp_path):
    layers = Layers.under(str(tmp_path))
    folder = tmp_path / "raw" / "order_items"
    folder.mkdir(parents=True)
    (folder / "order_items.csv").write_text(
        "order_item_id,order_id,product_id,quantity,unit_price,line_total\n"
        "1,1,1,2,1.5,3\n2,1,1,N/A,1.5,3\n3,1,1,,1.5,3\n4,1,1,1,2.5,2.5\n"
    )
    for infer in (False, True):
        bronze.ingest_dataset(spark, "order_items", layers, infer_types=infer)
        table = read_table(spark, f"{layers.bronze}/order_items")
        if not infer:
            kept = [row[0] for row in table.select(UNREADABLE).orderBy("order_item_id").collect()]
            assert kept == [None, "2,1,1,N/A,1.5,3", None, None]
            assert tuple(bronze.rejects(spark, "order_items", layers).first())[1:] == (4, 1)
        else:
            assert dict(table.dtypes)["quantity"] == "string"
        silver.process_dataset(spark, "order_items", layers)
        cleaned = read_table(spark, f"{layers.silver}/order_items")
        kinds = dict(cleaned.dtypes)
        assert kinds["quantity"] == "int" and kinds["unit_price"] == "decimal(18,4)"
        assert {row.order_item_id for row in cleaned.collect()} == {1, 4}


def test_a_failing_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(10), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(broken, path)
    assert read_table(spark, path).count() == 10
    assert write_table(read_table(spark, path).where("id < 4"), path) == 4
    assert read_table(spark, path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_profiles(spark):
    products = spark.range(5).selectExpr("id", "concat('c', id % 2) AS category").repartition(2)
    rows = {(r.part, r.label): r.value for r in products_profile(products).collect()}
    assert rows == {("size", "rows"): 5, ("size", "partitions"): 2,
                    ("category", "c0"): 3, ("category", "c1"): 2}


def test_schema_report_counts_values(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a INT, b STRING")
    rows = bronze.schema_report(df, "t").collect()
    assert [tuple(row) for row in rows] == [
        ("t", 3, 1, "a", "int", 2),
        ("t", 3, 2, "b", "string", 2),
    ]


def test_write_replaces_and_counts(spark, tmp_path):
    path = str(tmp_path / "table")
    assert write_table(spark.range(10), path) == 10
    assert write_table(spark.range(3).selectExpr("id AS other"), path) == 3
    assert read_table(spark, path).columns == ["other"]
    assert write_table(spark.range(0), path) == 0


def test_stored_frame_reads_files_below_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = stored(spark.range(5).selectExpr("id * 2 AS n"), "doubled")
    assert sorted(row.n for row in kept.collect()) == [0, 2, 4, 6, 8]
    assert all(folder in name for name in kept.inputFiles())
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def session_on(cluster, warehouse):
    class Session:
        class conf:
            @staticmethod
            def get(key, *default):
                return {"spark.sql.warehouse.dir": warehouse}.get(key, *default)

        class sparkContext:
            master = cluster

            @staticmethod
            def getCheckpointDir():
                return None

    return Session()


def test_shared_folder_without_the_setting_is_below_the_warehouse():
    common = session_on("yarn", "hdfs://name/warehouse")
    assert shared_folder(common) == "hdfs://name/warehouse/_intermediate"
    own = session_on("local[4]", "file:/home/me/warehouse")
    assert shared_folder(own) == "file:/home/me/warehouse/_intermediate"
    for warehouse in ("file:/home/me/warehouse", "/home/me/warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session_on("spark://head:7077", warehouse))


def test_held_table_goes_with_its_block(spark):
    with held(spark.range(5).toDF("n"), "held-test") as table:
        path = table.inputFiles()[0].removeprefix("file:").replace("///", "/")
        assert table.count() == 5
        assert Path(path).exists()
    assert not Path(path).exists()

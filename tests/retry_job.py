"""A job in which every scan task fails once after it has given its rows.

It needs a session that allows retries, so `test_retries` runs it as a process.
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lamina.model import PROCESSED_AT  # noqa: E402
from lamina.operators import gold, skew  # noqa: E402
from lamina.operators.silver import clean  # noqa: E402
from lamina.sources import read_table, write_table  # noqa: E402
from lamina.workload import feeds, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
#: Given by the test that runs this job; all its executors are in the driver.
FOLDER_OF_RUN = sys.argv[1]


def failing_once(df: DataFrame) -> DataFrame:
    def give_then_fail(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("first attempt")

    return df.repartition(3).mapInArrow(give_then_fail, df.schema)


def differing_rows(left: DataFrame, right: DataFrame) -> int:
    return left.exceptAll(right).count() + right.exceptAll(left).count()


def main() -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", f"{FOLDER_OF_RUN}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    tables = [
        feed(spark, FOLDER) for feed in (feeds.orders, feeds.order_items, feeds.products)
    ]
    daily = gold.daily_sales(*tables)
    daily_again = gold.daily_sales(*map(failing_once, tables))

    raw = feeds.raw_order_items(spark, FOLDER)
    path = f"{FOLDER_OF_RUN}/table"
    written = write_table(clean(failing_once(raw), "order_items"), path)
    silver_again = read_table(spark, path)

    items = queries.skewed_items(spark, FOLDER).select("category", "order_item_id")
    pieces, pieces_again = (
        skew.split_hot_keys(df, "category", 8, F.col("order_item_id"))
        for df in (items, failing_once(items))
    )
    print(
        json.dumps(
            {
                "daily": differing_rows(daily, daily_again),
                "silver": differing_rows(
                    clean(raw, "order_items").drop(PROCESSED_AT),
                    silver_again.drop(PROCESSED_AT),
                ),
                "rows_counted_wrong": written - silver_again.count(),
                "pieces": differing_rows(pieces, pieces_again),
            }
        )
    )


if __name__ == "__main__":
    main()

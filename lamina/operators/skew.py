"""How evenly rows are spread over keys, and salting of hot keys."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import steady_salt
from lamina.model import AMOUNT
from lamina.operators.gold import count_per_key
from lamina.operators.heavy import candidates, exact_counts, key_sketches
from lamina.operators.layout import partition_sizes, partition_stats
from lamina.plans.joins import broadcast_within
from lamina.sources import stored

#: Pieces of hot keys per partition.
FINER = 32


def key_distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, largest first."""
    return count_per_key(df, key).orderBy(F.desc("row_count"), key)


def skew_report(df: DataFrame, key: str) -> DataFrame:
    """Rows per key with the share of all rows and the ratio to the mean key.

    `placement_report` measures where a placement by the key puts them.

    The counts are stored first, so `df` runs once. The totals are a scalar
    subquery over those counts; the keys never meet in one task.
    """
    counts = stored(count_per_key(df, key), "key-counts")
    rows = counts.agg(F.sum("row_count")).scalar()
    keys = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        key,
        "row_count",
        (F.col("row_count") / rows).alias("share"),
        (F.col("row_count") * keys / rows).alias("ratio_to_mean"),
    )


def salted_sales(df: DataFrame, key: str, distinct_on: str, salts: int) -> DataFrame:
    """Sales per key in two stages: per key and salt first, then per key.

    The salt comes from the column whose distinct values are counted. Each value
    then lies under one salt only, and the distinct counts of the salts add up.
    """
    parts = (
        df.withColumn("salt", steady_salt(F.col(distinct_on), salts))
        .groupBy(key, "salt")
        .agg(
            F.count(F.lit(1)).alias("part_rows"),
            F.sum(F.col("line_total").cast(AMOUNT)).alias("part_sales"),
            F.sum("quantity").alias("part_items"),
            F.count_distinct(distinct_on).alias("part_orders"),
        )
    )
    return parts.groupBy(key).agg(
        F.sum("part_rows").alias("row_count"),
        F.sum("part_sales").cast("double").alias("total_sales"),
        F.sum("part_items").alias("total_items_sold"),
        F.sum("part_orders").alias("total_orders"),
    )


def salts_for(df: DataFrame, key: str, hot_value: str, partitions: int, finer: int = FINER) -> int:
    """Into how many salts a hot value must go, from its measured share.

    A share of one partition's rows is cut into `finer` salts, since salts are placed by
    their hash and a few large ones would meet in one partition.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key) == hot_value).alias("hot")
    ).first()
    return max(1, ceil(row["hot"] * partitions * finer / max(row["rows"], 1)))


def split_hot_keys(
    df: DataFrame,
    key: str,
    partitions: int,
    salt_on: Column,
    finer: int = FINER,
    run_once: bool = True,
) -> DataFrame:
    """Add a `piece` column that splits each hot key into pieces that are alike.

    A piece holds a share of all rows divided by `partitions * finer`. A key above it,
    null too, is split by the hash of `salt_on` into as many pieces as its measured size
    calls for, so the split holds at any scale. Pieces are placed by their hash: with
    `finer` times as many as partitions, the fullest partition stays near the mean. Fewer
    than `partitions * finer` keys can be above the share, which bounds the side that is
    broadcast. They come from a sketch and an exact count of its candidates, so no table of
    all keys is made. The rows are read three times, so they are stored in between; for a
    plain scan `run_once=False` saves that.
    """
    rows = stored(df, "rows-to-split") if run_once else df
    most = partitions * finer
    sketches = stored(key_sketches(rows, key, most), "key-sketches")
    total = sketches.agg(F.sum("rows")).first()[0] or 0
    share = max(1, ceil(total / most))
    hot = (
        exact_counts(rows, key, candidates(sketches, key))
        .filter(F.col("row_count") > share)
        .select(
            F.col(key).alias("hot_key"),
            F.ceil(F.col("row_count") / share).cast("int").alias("pieces"),
        )
    )
    is_hot = F.col(key).eqNullSafe(F.col("hot_key"))
    piece = F.pmod(F.xxhash64(salt_on), F.coalesce("pieces", F.lit(1))).cast("int")
    return (
        rows.join(broadcast_within(hot), is_hot, "left")
        .withColumn("piece", piece)
        .drop("hot_key", "pieces")
    )


def placement_report(df: DataFrame, partitions: int, placements: dict[str, list[str]]) -> DataFrame:
    """How `df` lies when it is really placed by each of some keys.

    One row a placement: its name, partitions, rows, largest and smallest partition, and
    the largest one's ratio to the mean. A placement that puts a hot key into one task is
    what is measured here, so that task takes as long as it takes.
    """
    reports = [
        partition_stats(
            partition_sizes(df.select(*keys).repartition(partitions, *keys), partitions)
        ).select(
            F.lit(name).alias("placed_by"),
            "partitions",
            "row_count",
            "max_rows",
            "min_rows",
            (F.col("max_rows") * F.col("partitions") / F.col("row_count")).alias("max_to_mean"),
        )
        for name, keys in placements.items()
    ]
    return reduce(DataFrame.unionAll, reports)

"""Consecutive numbers for rows in an order, without bringing the rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.sources import stored

# Fixed value: where `monotonically_increasing_id` puts the partition above the row.
PARTITION_SHIFT = 33


def numbered(df: DataFrame, *keys: str, first: int = 0) -> DataFrame:
    """The rows with their `number` in the order of `keys`, from `first` on.

    Rows are dealt out by ranges of the keys, sorted there and stored once with their place.
    A number is the place in the range and what the ranges before hold; that small table
    has a row a range, so it is broadcast. Rows with equal keys are numbered in any order,
    so the keys should be unique.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    range_of = F.shiftrightunsigned("_place", PARTITION_SHIFT)
    ranges = placed.groupBy(range_of.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    spans = ranges.agg(F.sort_array(F.collect_list(F.struct("_range", "_rows"))).alias("_spans"))
    none = F.array().cast("array<struct<range:bigint,before:bigint>>")
    before = F.aggregate(
        "_spans",
        F.struct(F.lit(first).cast("bigint").alias("total"), none.alias("found")),
        lambda done, span: F.struct(
            (done["total"] + span["_rows"]).alias("total"),
            F.concat(
                done["found"],
                F.array(F.struct(span["_range"].alias("range"), done["total"].alias("before"))),
            ).alias("found"),
        ),
        lambda done: done["found"],
    )
    offsets = spans.select(F.explode(before).alias("o")).select("o.range", "o.before")
    own = F.col("_place") - F.shiftleft("range", PARTITION_SHIFT)
    return placed.join(F.broadcast(offsets), range_of == F.col("range")).select(
        *[F.col(f"`{name}`") for name in df.columns], (F.col("before") + own).alias("number")
    )

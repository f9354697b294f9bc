"""How rows lie in partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

#: Rows of a Parquet row group in clustered tables.
GROUP_ROWS = 100_000
#: Partitions whose sizes can be counted while they are written.
MOST_PARTITIONS = 100_000


def partition_sizes(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in each partition of `df`.

    An empty partition has no row to count. Where the number of partitions is
    given, the empty ones are listed with zero rows as well.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return sizes if partitions is None else _with_empty(sizes, partitions)


def _with_empty(sizes: DataFrame, partitions: int) -> DataFrame:
    numbers = sizes.sparkSession.range(partitions).select(
        F.col("id").cast("int").alias("partition_id")
    )
    return numbers.join(sizes, "partition_id", "left").fillna(0, ["row_count"])


def partition_stats(sizes: DataFrame) -> DataFrame:
    """One row: number of partitions, rows in all, largest and smallest partition."""
    return sizes.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("row_count").alias("row_count"),
        F.max("row_count").alias("max_rows"),
        F.min("row_count").alias("min_rows"),
    )


def key_partitions(df: DataFrame, *keys: str) -> DataFrame:
    """For each key its rows and the number of partitions that hold them."""
    per_partition = df.groupBy(*keys, F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("part_rows")
    )
    return per_partition.groupBy(*keys).agg(
        F.sum("part_rows").alias("row_count"),
        F.count(F.lit(1)).alias("partitions"),
    )


def write_clustered(df: DataFrame, path: str, *keys: str, group_rows: int = GROUP_ROWS) -> int:
    """Write the rows in the order of `keys` over all files; returns how many there are.

    Each file holds a range of the keys, sorted, and a row group holds at most `group_rows`
    neighbours. The smallest and largest values that Parquet keeps of each group are then
    close together, so a read with a filter on the first keys skips most groups.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    written = Observation()
    (
        ranged.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.option("parquet.block.row.count.limit", group_rows)
        .option("parquet.page.row.count.limit", group_rows)
        .parquet(path)
    )
    return written.get["rows"]


def write_observed(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as it lies and return the rows of each partition, as `partition_sizes` does.

    The rows are counted by partition while they are written, so there is one job. The
    counts are a sketch of the partition numbers, which is exact as long as it has a place
    for each number.
    """
    spark = df.sparkSession
    written = Observation()
    sketch = F.expr(f"approx_top_k_accumulate(_partition, {MOST_PARTITIONS})").alias("sizes")
    numbered = df.withColumn("_partition", F.spark_partition_id())
    numbered.observe(written, sketch).drop("_partition").write.parquet(path)
    shape = numbered.agg(sketch).schema
    state = spark.createDataFrame([(written.get["sizes"],)], shape)
    counted = state.select(
        F.explode(F.expr(f"approx_top_k_estimate(sizes, {MOST_PARTITIONS})")).alias("size")
    )
    return counted.select(
        F.col("size.item").cast("int").alias("partition_id"), F.col("size.count").alias("row_count")
    )

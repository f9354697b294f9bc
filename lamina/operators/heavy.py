"""Keys with a large share of all rows, found without counting every key.

A sketch of frequent items is made in one pass and takes the same space for any number of
keys. It holds every key above the share; the rows of these candidates alone are counted
in a second pass, which makes the counts exact. Sketches of several batches can be combined,
so a batch is sketched once, when it is loaded.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.plans.joins import broadcast_within
from lamina.sources import stored

#: Items that one sketch tracks. It counts an item too low by 2.7 times the mean of them at
#: most, and names those that are above twice that error.
TRACKED = 16_384
#: Tracked items for each key that can be above the share.
TRACKED_PER_PIECE = 8


def key_sketches(df: DataFrame, key: str, pieces: int) -> DataFrame:
    """`part`, `rows` and a `sketch` of the keys that hold a share of 1 / `pieces` or more.

    Keys are dealt out over as many sketches as such a share calls for, by their hash. A
    sketch combines on the map side; nulls are a key like others.
    """
    parts = ceil(pieces * TRACKED_PER_PIECE / TRACKED)
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k_accumulate(`{key}`, {TRACKED})").alias("sketch"),
    )


def combined(sketches: DataFrame) -> DataFrame:
    """Sketches of several batches, made for the same number of pieces, as one of all."""
    return sketches.groupBy("part").agg(
        F.sum("rows").alias("rows"),
        F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"),
    )


def candidates(sketches: DataFrame, key: str) -> DataFrame:
    """The keys that may be above the share: at most `TRACKED` of each sketch."""
    found = F.expr(f"approx_top_k_estimate(sketch, {TRACKED})")
    return sketches.select(F.explode(found).alias("found")).select(
        F.col("found.item").alias(key)
    )


def exact_counts(df: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """Rows of each chosen key: the others are dropped before anything is shuffled."""
    named = chosen.select(F.col(key).alias("_chosen")).distinct()
    few = broadcast_within(named)
    kept = df.select(key).join(few, F.col(key).eqNullSafe(F.col("_chosen")), "left_semi")
    return kept.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))


def heavy_keys(
    df: DataFrame, key: str, pieces: int, sketches: DataFrame | None = None
) -> DataFrame:
    """`key`, its exact `row_count` and `share`, of keys above 1 / `pieces` of all rows.

    There are fewer than `pieces` of them. Without `sketches`, made for as many pieces or
    more, `df` is sketched first.
    """
    if sketches is None:
        sketches = stored(key_sketches(df, key, pieces), "key-sketches")
    total = sketches.agg(F.sum("rows")).first()[0] or 0
    counted = exact_counts(df, key, candidates(sketches, key))
    return counted.where(F.col("row_count") > total / pieces).select(
        key, "row_count", (F.col("row_count") / F.lit(float(max(total, 1)))).alias("share")
    )

"""Connected components of a link table: contracted in tasks, then by alternating stars."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from lamina.sources import stored

#: Links that one task takes; their measured number sets how many tasks there are.
LINKS_PER_TASK = 250_000


def _contract_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as one from each node to the smallest node linked to it there."""
    above: dict[int, int] = {}

    def root(node: int) -> int:
        while (parent := above.setdefault(node, node)) != node:
            above[node] = node = above[parent]
        return node

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one, two = root(a), root(b)
            if one != two:
                above[max(one, two)] = min(one, two)
    found = [(node, root(node)) for node in above]
    moved = [(node, least) for node, least in found if node != least]
    nodes, roots = zip(*moved, strict=True) if moved else ((), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"]
    )


def _contracted(links: DataFrame, tasks: int) -> DataFrame:
    """Links with the same components: each task's own part contracted, stars around its
    smallest nodes. Memory is that of the links of a task."""
    dealt = links.select("a", "b").coalesce(1) if tasks == 1 else links.repartition(tasks, "a")
    return dealt.select("a", "b").mapInArrow(_contract_batches, "a bigint, b bigint")


def _both_ways(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionAll(back)


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    smallest = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    least = stored(smallest.coalesce(tasks), "star-least")
    larger = around.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.where("a > b")
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    least = stored(smallest.coalesce(tasks), "star-least")
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionAll(own).distinct().coalesce(tasks)


def _stored_with_state(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The stored links, and a count and checksum taken while they are written."""
    seen = Observation()
    watched = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")
    )
    table = stored(watched, "star-links")
    return table, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node linked to it; smallest nodes are left out.

    `links` has the columns `a` and `b`. What fits a task is contracted there; links of
    several tasks go on by alternating stars. Each of their steps groups and joins by node,
    never by component, and is stored; nothing but a count and a checksum comes to the
    driver. The minima are stored before they are joined, so the join is by broadcast where
    they are few, and the adaptive join can split a node with many links where they are not.
    """
    ordered = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links"
    )
    tasks = ceil(ordered.count() / LINKS_PER_TASK)
    edges = stored(_contracted(ordered, max(1, tasks)), "contracted-links")
    if tasks > 1:
        edges = _alternating(edges, max(8, tasks))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _alternating(links: DataFrame, tasks: int) -> DataFrame:
    """Alternating stars until a step changes nothing: `b` is then the smallest node of `a`'s
    component."""
    edges, state = _stored_with_state(_small_star(links, tasks))
    while True:
        wide = stored(_large_star(edges, tasks), "star-large")
        edges, now = _stored_with_state(_small_star(wide, tasks))
        if now == state:
            return edges
        state = now

"""What Spark plans for a frame, and what it did once the frame has run.

Plans are walked node by node. An adaptive plan is followed through the stages that have
run, so each node counts once, and what adaptive execution changed on the way is seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

JOIN_NAMES = ("BroadcastHashJoin", "SortMergeJoin")
_STAGES = ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "TableCacheQueryStageExec", "ResultQueryStageExec")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text that `df.explain` would print; mode `extended` shows all four stages."""
    explained = df.sparkSession._jvm.PythonSQLUtils.explainString
    return explained(df._jdf.queryExecution(), mode)


@dataclass(frozen=True)
class PlanNode:
    """One physical operator: its kind as in the plan's text, its depth, what it has counted."""

    name: str
    depth: int
    rows: int | None
    skew_join: bool
    coalesced: bool
    skewed: bool


def plan_nodes(df: DataFrame) -> Iterator[PlanNode]:
    """The operators of the physical plan, from the top down.

    Before a frame runs that is the plan it begins with, afterwards the one that ran. Rows
    are what an operator gave, if it counts them.
    """
    return _walk(df._jdf.queryExecution().executedPlan(), 0)


def _walk(node, depth: int) -> Iterator[PlanNode]:
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _walk(node.executedPlan(), depth)
        return
    if kind in _STAGES:
        yield from _walk(node.plan(), depth)
        return
    below = node.children()
    if kind == "InputAdapter" or kind == "WholeStageCodegenExec":
        yield from _walk(below.apply(0), depth)
        return
    if kind == "ReusedExchangeExec":
        yield _described(node, "ReusedExchange", depth)
        return
    yield _described(node, kind.removesuffix("Exec"), depth)
    for place in range(below.length()):
        yield from _walk(below.apply(place), depth + 1)


def _described(node, name: str, depth: int) -> PlanNode:
    counted = node.metrics()
    rows = counted.apply("numOutputRows").value() if counted.contains("numOutputRows") else None
    read = name == "AQEShuffleRead"
    return PlanNode(
        name,
        depth,
        rows,
        name in ("SortMergeJoin", "ShuffledHashJoin") and node.isSkewJoin(),
        read and node.hasCoalescedPartition(),
        read and node.hasSkewedPartition(),
    )


def join_counts(df: DataFrame) -> dict[str, int]:
    """How many joins of each kind the physical plan has."""
    found = Counter(node.name for node in plan_nodes(df))
    return {name: found[name] for name in JOIN_NAMES}


@dataclass(frozen=True)
class PlanSummary:
    """Joins and shuffles of a plan, and what adaptive execution did to them."""

    broadcast_joins: int
    sort_merge_joins: int
    shuffles: int
    broadcasts: int
    skew_joins: int
    coalesced_reads: int
    final: bool


def plan_summary(df: DataFrame) -> PlanSummary:
    """The plan as it stands: before `df` has run what is planned, afterwards what was done."""
    nodes = list(plan_nodes(df))
    found = Counter(node.name for node in nodes)
    top = df._jdf.queryExecution().executedPlan()
    adaptive = top.getClass().getSimpleName() == "AdaptiveSparkPlanExec"
    return PlanSummary(
        broadcast_joins=found["BroadcastHashJoin"],
        sort_merge_joins=found["SortMergeJoin"],
        shuffles=found["ShuffleExchange"],
        broadcasts=found["BroadcastExchange"],
        skew_joins=sum(node.skew_join for node in nodes),
        coalesced_reads=sum(node.coalesced for node in nodes),
        final=not adaptive or top.isFinalPlan(),
    )


def scanned_rows(df: DataFrame) -> int:
    """Rows that the file scans of a frame gave, once it has run, as they counted them."""
    return sum(node.rows or 0 for node in plan_nodes(df) if node.name.endswith("FileSourceScan"))


def report_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of the few rows that a report has gathered, as literals of the plan."""
    shape = StructType.fromDDL(schema)
    listed = [
        F.struct(
            *[
                F.lit(value).cast(field.dataType).alias(field.name)
                for value, field in zip(row, shape, strict=True)
            ]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*listed).cast(ArrayType(shape))))

"""Conversations as bounded pieces in the order of their turns, and states carried over them.

Rows are dealt out by ranges of conversation and turn, so a conversation of any length lies
over as many partitions as its rows call for. What one range holds of a conversation is
sorted and cut into pieces of a fixed number of turns; the pieces of a conversation are
numbered from 0 on. No step gathers a conversation in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.sources import stored

#: Turns of a piece.
PIECE = 64
#: Characters of role and text that place a row among those of the same turn.
PLACED_BY = 32


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """`conv`, `number`, `total` (of the conversation's pieces), `turns` (at most `size`).

    `rows` has `conv`, `turn`, `role` and `text`. Turns are in the order of turn, role and
    text, nulls first. Rows without a conversation are one conversation.
    """
    near = [F.substring(name, 1, PLACED_BY) for name in ("role", "text")]
    ranged = rows.repartitionByRange("conv", "turn", *near).withColumn(
        "range", F.spark_partition_id()
    )
    found = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = stored(ranged.groupBy("conv", "range").agg(found.alias("turns")), "turns")

    own = F.ceil(F.size("turns") / size).cast("int")
    # A boundary between two ranges cuts one conversation, so those that lie over several
    # ranges have at most two entries a range; that bounds what is broadcast.
    spans = (
        grouped.select(F.col("conv").alias("cut"), F.struct("range", own.alias("n")).alias("span"))
        .groupBy("cut")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
        .where(F.size("spans") > 1)
    )
    placed = grouped.join(F.broadcast(spans), F.col("conv").eqNullSafe(F.col("cut")), "left")

    def pieces_in(chosen):
        return F.aggregate(chosen, F.lit(0), lambda total, span: total + span["n"])

    before = pieces_in(F.filter("spans", lambda span: span["range"] < F.col("range")))
    cut_up = F.transform(
        F.sequence(F.lit(0), own - 1),
        lambda i: F.struct(
            (F.coalesce("before", F.lit(0)) + i).alias("number"),
            F.slice("turns", i * size + 1, size).alias("turns"),
        ),
    )
    counted = placed.select(
        "conv", "turns", before.alias("before"), F.coalesce(pieces_in("spans"), own).alias("total")
    )
    return counted.select("conv", "total", F.explode(cut_up).alias("piece")).select(
        "conv", "piece.number", "total", "piece.turns"
    )


def states_before(maps: DataFrame, start: int) -> DataFrame:
    """`conv`, `number` and the `state` in which each piece is entered.

    `maps` has `conv`, `number` and `after`: for each state, from 0 on, the one that the
    piece leads to. A piece that leads to one state from all others settles it for the next
    piece. Those that do not are joined with what lies before them, which doubles their
    reach each time, until they settle it or reach the start of the conversation.
    """
    known = stored(maps.select("conv", "number", "after", F.col("number").alias("first")), "maps")
    unsettled = (F.col("first") > 0) & (F.array_min("after") != F.array_max("after"))
    while not known.where(unsettled).isEmpty():
        earlier = known.select(
            F.col("conv").alias("of"),
            (F.col("number") + 1).alias("next"),
            F.col("after").alias("begins"),
            F.col("first").alias("reached"),
        )
        same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("first") == F.col("next"))
        through = F.transform("begins", lambda state: F.element_at("after", state + 1))
        longer = (
            known.where(unsettled)
            .join(earlier, same)
            .select("conv", "number", through.alias("after"), F.col("reached").alias("first"))
        )
        known = stored(known.where(~unsettled).unionAll(longer), "maps")
    given = known.select(
        F.col("conv").alias("of"),
        (F.col("number") + 1).alias("next"),
        F.element_at("after", start + 1).alias("given"),
    )
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("number") == F.col("next"))
    return maps.select("conv", "number").join(given, same, "left").select(
        "conv", "number", F.coalesce("given", F.lit(start)).alias("state")
    )

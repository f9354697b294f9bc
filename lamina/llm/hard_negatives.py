"""Hard negatives of anchors, found by Fagin's threshold algorithm.

Vectors are integers: each component times a scale, rounded down. For an anchor its
positives are the rows of its own label with the highest inner products, and the negatives
of a positive are the rows of other labels whose products lie in a window below the
positive's, highest first.

Rows are packed into blocks of bounded size, sorted by label. Each dimension of a block is a
sorted list. A search reads all lists in step, from the top where the anchor's component is
positive and from the bottom where it is negative, and scores each row that comes up for
the first time on its whole vector. No row that has not come up can score more than the
threshold, the product of the anchor with what the lists have reached. The search of a
block ends once the threshold is strictly below what every window still wants: the score of
its last place, or its lower end while places are free. Places are kept from block to
block, so later blocks end sooner. The threshold is taken at depths that double.

Anchors are a stated share of all rows. They come in slabs of bounded size, each broadcast
to the blocks; the places of all tasks meet by anchor and window.

Rows with a null id, label or vector, or with a component that is null or not finite, take
no part. Rows that are equal in id, label and vector are one row; rows with one id that
differ are rows of their own, and equal scores are in the order of ids. A vector shorter
than the longest ends in zeros. Scores that exceed 64 bits are refused. An empty table gives
an empty one. Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.sources import fresh_path, read_table, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: The window of a positive, in hundredths of its score.
LEAST_SHARE, MOST_SHARE = 30, 90
#: Rows of a block, and anchors of a slab (on average; they are drawn by a hash).
BLOCK, SLAB = 4096, 4096
#: Depth of the lists at which a search looks at the threshold first.
FIRST_DEPTH = 32

_BLOCKS = "ids binary, labels array<string>, sizes array<int>, vectors binary"
_PLACES = "anchor int, window int, score bigint, id bigint"
_EXACT = 2.0**53


class Lists:
    """The sorted lists of some rows, and how far down a search is at each depth."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        self.vectors, self.ids = vectors, ids
        self.order = np.argsort(vectors, axis=0, kind="stable")
        n = len(ids)
        self.depths = []
        depth = min(FIRST_DEPTH, n)
        while depth < n:
            self.depths.append(depth)
            depth *= 2
        self.depths.append(n)
        ordered = np.take_along_axis(vectors, self.order, axis=0)
        self._from_top = np.array([ordered[n - depth] for depth in self.depths])
        self._from_bottom = np.array([ordered[depth - 1] for depth in self.depths])

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """For each anchor and depth, the most that a row not seen by then can score."""
        return np.maximum(anchors, 0) @ self._from_top.T + np.minimum(anchors, 0) @ self._from_bottom.T

    def newly_seen(self, anchor: np.ndarray, start: int, end: int, seen: np.ndarray) -> np.ndarray:
        """The rows that come up between two depths for the first time; marks them as seen."""
        n = len(self.ids)
        fresh = np.zeros(n, bool)
        fresh[self.order[n - end : n - start, anchor >= 0]] = True
        fresh[self.order[start:end, anchor < 0]] = True
        fresh &= ~seen
        seen |= fresh
        return np.flatnonzero(fresh)


class Places:
    """The best scores between `low` and `high` so far, ties by id, at most `k`."""

    def __init__(self, k: int, low: float, high: float) -> None:
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def wanted(self) -> float:
        """Rows that score less cannot come in."""
        return self.scores[-1] if len(self.scores) == self.k else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fitting = (scores >= self.wanted) & (scores <= self.high)
        if not fitting.any():
            return
        scores = np.concatenate([self.scores, scores[fitting].astype(np.int64)])
        ids = np.concatenate([self.ids, ids[fitting]])
        if len(scores) > 4 * self.k:
            least = np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[scores >= least], ids[scores >= least]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search(
    lists: Lists,
    anchor: np.ndarray,
    thresholds: np.ndarray,
    windows: list[Places],
    left_out: np.ndarray | None = None,
) -> int:
    """Give the windows the rows of the lists that they want; returns how many were scored."""
    seen = np.zeros(len(lists.ids), bool)
    scored = start = 0
    for depth, threshold in zip(lists.depths, thresholds, strict=True):
        rows = lists.newly_seen(anchor, start, depth, seen)
        scored += len(rows)
        if left_out is not None:
            rows = rows[~left_out[rows]]
        scores, ids = lists.vectors[rows] @ anchor, lists.ids[rows]
        for window in windows:
            window.offer(scores, ids)
        if all(threshold < window.wanted for window in windows):
            break
        start = depth
    return scored


def integer_vector(vector: Column, scale: int = SCALE) -> Column:
    """Each component, as a double, times `scale` and rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE,
    most_share: int = MOST_SHARE,
    block: int = BLOCK,
    slab: int = SLAB,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    `is_anchor` is a condition on the rows. Ranks begin at 1 for each anchor and positive.
    """
    spark = rows.sparkSession
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select(
        F.col(id).cast("bigint").alias("id"),
        F.col(label).cast("string").alias("label"),
        F.when(usable, integer_vector(F.col(vector))).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    given = kept.where("id is not null and label is not null and vector is not null").distinct()
    # Equal rows combine before the shuffle; a large label is cut by the hash of the ids.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = given.repartitionByRange(partitions, "label", F.xxhash64("id")).sortWithinPartitions(
        "label", "id"
    )
    table = stored(ordered, "vectors")
    width = table.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = stored(
        table.select("id", "label", "vector").mapInArrow(_packer(width, block), _BLOCKS), "blocks"
    )
    chosen = table.where("anchor").select("id", "label", "vector")
    slabs = max(1, ceil(chosen.count() / slab))
    drawn = stored(
        chosen.withColumn("slab", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(slabs))), "anchors"
    )
    shares, counts = (least_share, most_share), (positives, negatives)
    path = fresh_path(spark, "hard-negatives")
    _mined(blocks, drawn.where("slab = 0"), width, shares, counts).write.mode("append").parquet(path)
    for number in range(1, slabs):
        part = drawn.where(F.col("slab") == number)
        _mined(blocks, part, width, shares, counts).write.mode("append").parquet(path)
    return read_table(spark, path)


def _mined(
    blocks: DataFrame, anchors: DataFrame, width: int, shares: tuple[int, int], counts: tuple[int, int]
) -> DataFrame:
    """The negatives of one slab of anchors, which comes to the driver and is broadcast."""
    spark = blocks.sparkSession
    positives, negatives = counts
    packed = anchors.select("id", "label", "vector").toArrow().combine_chunks()
    labels = np.array(packed["label"].to_pylist(), object)
    ids = packed["id"].to_numpy()
    vectors = _filled(packed["vector"].combine_chunks(), width)
    shared = spark.sparkContext.broadcast((ids, labels, vectors))

    found = blocks.mapInArrow(_nearest(shared, positives), _PLACES)
    # At most `positives` rows an anchor of the slab.
    best = _first(found, positives).toArrow().to_pylist()
    windows: dict[int, list[tuple[int, int, int]]] = {}
    for row in best:
        low, high = -(-shares[0] * row["score"] // 100), shares[1] * row["score"] // 100
        if low <= high:
            windows.setdefault(row["anchor"], []).append((row["window"], low, high))
    wanted = spark.sparkContext.broadcast(windows)
    known = [(int(ids[r["anchor"]]), r["anchor"], r["window"], r["id"], r["score"]) for r in best]
    named = spark.createDataFrame(
        known, "anchor_id bigint, anchor int, window int, positive_id bigint, positive_score bigint"
    )
    placed = _first(blocks.mapInArrow(_in_windows(shared, wanted, negatives), _PLACES), negatives, True)
    return placed.join(F.broadcast(named), ["anchor", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _first(places: DataFrame, k: int, by_window: bool = False) -> DataFrame:
    """The best `k` places of each anchor, or of each window, of all tasks; they bring `k` each
    at most. Without windows the place of a positive becomes the number of its window."""
    keys = ["anchor", "window"] if by_window else ["anchor"]
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    ranked = places.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if by_window:
        return ranked
    return ranked.withColumn("window", F.col("rank"))


def _filled(vectors: pa.ListArray, width: int) -> np.ndarray:
    """A matrix of the vectors; short ones end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    matrix = np.zeros((len(sizes), width), np.int64)
    line = np.repeat(np.arange(len(sizes)), sizes)
    matrix[line, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return matrix


def _packer(width: int, block: int) -> Callable:
    """Rows in the order of labels to blocks: ids, runs of labels and the vectors' bytes."""

    def packed(table: pa.Table) -> pa.RecordBatch:
        labels = table["label"].to_numpy()
        starts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
        sizes = np.diff(np.r_[starts, len(labels)])
        vectors = _filled(table["vector"].combine_chunks(), width)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([table["id"].to_numpy().tobytes()], pa.binary()),
                pa.array([list(labels[starts])], pa.list_(pa.string())),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([vectors.tobytes()], pa.binary()),
            ],
            names=["ids", "labels", "sizes", "vectors"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= block:
                table = pa.Table.from_batches(waiting).combine_chunks()
                whole = rows - rows % block
                for start in range(0, whole, block):
                    yield packed(table.slice(start, block).combine_chunks())
                waiting, rows = table.slice(whole).to_batches(), rows - whole
        if rows:
            yield packed(pa.Table.from_batches(waiting).combine_chunks())

    return run


def _blocks_of(
    batches: Iterable[pa.RecordBatch], width: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels of runs, their bounds, and the matrix of each block."""
    for batch in batches:
        for ids, labels, sizes, vectors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            numbers = np.frombuffer(ids, np.int64)
            matrix = np.frombuffer(vectors, np.int64).reshape(len(numbers), width)
            yield numbers, np.array(labels, object), np.r_[0, np.cumsum(sizes)], matrix


def _computable(matrix: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in doubles where all products are exact in them, else in integers of 64 bits."""
    top = np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)
    bound = top * np.abs(matrix.astype(np.float64)).max(initial=0)
    if bound >= 2.0**63:
        raise OverflowError("inner products of these vectors exceed 64 bits")
    if bound < _EXACT:
        return matrix.astype(np.float64), anchors.astype(np.float64)
    return matrix, anchors


def _places(found: dict[tuple[int, int], Places]) -> Iterator[pa.RecordBatch]:
    rows = [
        (anchor, window, score, id)
        for (anchor, window), places in found.items()
        for score, id in zip(places.scores.tolist(), places.ids.tolist(), strict=True)
    ]
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "window", "score", "id"])


def _nearest(shared, k: int) -> Callable:
    """The best rows of each anchor's own label that are not the anchor itself."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own_labels, own_vectors = shared.value
        by_label: dict[str, list[int]] = {}
        for number, label in enumerate(own_labels):
            by_label.setdefault(label, []).append(number)
        found: dict[tuple[int, int], Places] = {}
        for ids, labels, bounds, matrix in _blocks_of(batches, own_vectors.shape[1]):
            for run_number, label in enumerate(labels):
                numbers = by_label.get(label)
                if not numbers:
                    continue
                span = slice(bounds[run_number], bounds[run_number + 1])
                rows, anchors = _computable(matrix[span], own_vectors[numbers])
                lists = Lists(rows, ids[span])
                for number, anchor, line in zip(numbers, anchors, lists.thresholds(anchors), strict=True):
                    itself = lists.ids == own_ids[number]
                    if itself.any():
                        itself &= (rows == anchor).all(axis=1)
                    places = found.setdefault((number, 0), Places(k, -np.inf, np.inf))
                    search(lists, anchor, line, [places], itself)
        yield from _places(found)

    return run


def _in_windows(shared, wanted, k: int) -> Callable:
    """The best rows of other labels in each window of each anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, own_labels, own_vectors = shared.value
        numbers = np.array(sorted(wanted.value), np.int64)
        found = {
            (number, window): Places(k, low, high)
            for number, own in wanted.value.items()
            for window, low, high in own
        }
        for ids, labels, bounds, matrix in _blocks_of(batches, own_vectors.shape[1]):
            rows, anchors = _computable(matrix, own_vectors[numbers])
            lists = Lists(rows, ids)
            places = {label: slice(bounds[i], bounds[i + 1]) for i, label in enumerate(labels)}
            for number, anchor, line in zip(
                numbers.tolist(), anchors, lists.thresholds(anchors), strict=True
            ):
                own = places.get(own_labels[number])
                left_out = None
                if own is not None:
                    if own.stop - own.start == len(ids):
                        continue
                    left_out = np.zeros(len(ids), bool)
                    left_out[own] = True
                windows = [found[number, window] for window, _, _ in wanted.value[number]]
                search(lists, anchor, line, windows, left_out)
        yield from _places(found)

    return run

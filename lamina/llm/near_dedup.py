"""Near-duplicate documents: DartMinHash signatures, banded joining, exact verification.

A text is the multiset of its shingles of five words. Every shingle owns a strip as wide as
its count, on which hashed darts fall one by one, on average one a unit of area; the same
shingle gets the same darts in every text. The earliest dart of each coordinate is the
signature, so two texts agree in a coordinate with the probability of their generalised
Jaccard similarity. Only about `k log k` darts are thrown, whatever the text's length.

Texts with the same words are one node from the start. Nodes that agree in all rows of a
band share a bucket, and each bucket compares its members with one of them, its head. Bands
take turns: after one band the components found so far are contracted, and the next bands
compare only members that are not in their head's component yet. So a family of copies is
compared about once a member, not once a member and band. Then other heads follow, over all
bands, as long as a round links many of the pairs it compares: each takes all members of the
open buckets again. Members of a bucket that are still in different components meet exactly:
a pair that is similar enough shares one of the rarest shingles of both, and only such pairs
are listed. So no link depends on how many rounds there are. Every link is verified on the
exact multisets.

A document without words has the class of the documents with the same text; null and empty
texts are alone. Rows with the same id are one document, whose links are those of all its
texts. Rows with a null id keep a null class. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lamina.llm.components import components
from lamina.llm.frames import small_batches, without
from lamina.llm.shingles import (
    counted,
    generalised_jaccard,
    mixed,
    shingle_hashes,
    word_hashes,
    words_of,
)
from lamina.sources import stored

BANDS, ROWS = 24, 5
SIMILARITY = 0.8
#: Counters of shingles. They only set the order in which prefixes take shingles.
COUNTERS = 1 << 20
#: Postings of a shingle that one task joins.
POSTINGS = 2_000
#: Another round of heads follows if the last one linked one in so many of its pairs.
PAIRS_PER_LINK = 10
#: Texts that are signed together.
TEXTS = 128
#: Texts, or pairs of multisets, that a Python worker gets at once.
BATCH = 256

_CELL, _STEP, _DART = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_UNIT = 2.0**-53
_TOP = np.uint64(11)


def _poisson_bounds() -> np.ndarray:
    """Where the count of darts in a unit cell goes up, as bounds of a 64-bit hash."""
    share, total, bounds = np.exp(-1.0), 0.0, []
    for count in range(1, 20):
        total += share
        bounds.append(min(int(total * 2.0**64), 2**64 - 1))
        share /= count
    return np.array(bounds, np.uint64)


_BOUNDS = _poisson_bounds()


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _TOP).astype(np.float64) * _UNIT


def _counted_up(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of `counts`: its place as often as it says, and numbers from 0 on beside it."""
    place = np.repeat(np.arange(len(counts)), counts)
    return place, np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)


def _darts(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, limits: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Identities, ranks and texts of the darts that fall on the elements' strips.

    `owner` is the text of each element; a text takes darts of rank below its limit.
    """
    element, column = _counted_up(np.ceil(weights).astype(np.int64))
    strip = mixed(elements[element] + column.astype(np.uint64) * _CELL)
    part, row = _counted_up(np.ceil(limits).astype(np.int64)[owner[element]])
    cell = mixed(strip[part] + (row.astype(np.uint64) + np.uint64(1)) * _STEP)
    at, number = _counted_up(np.searchsorted(_BOUNDS, cell, side="right"))
    dart = mixed(cell[at] + (number.astype(np.uint64) + np.uint64(1)) * _DART)
    text = owner[element[part[at]]]
    rank = row[at] + _uniform(dart)
    hit = rank < limits[text]
    dart, rank, text, part = dart[hit], rank[hit], text[hit], part[at][hit]
    across = column[part] + _uniform(mixed(dart ^ _STEP))
    hit = across < weights[element[part]]
    return dart[hit], rank[hit], text[hit]


def signatures_of(
    elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int
) -> np.ndarray:
    """A row of `k` darts a text: the earliest of each coordinate.

    The texts' elements stand one after another, `sizes` of each; no text is without any
    and weights are positive. A text with an empty coordinate is thrown at again, further.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    totals = np.add.reduceat(weights, np.cumsum(sizes) - sizes)
    limits = k * (np.log(k) + 2) / totals
    table = np.zeros((len(sizes), k), np.uint64)
    open_texts = np.arange(len(sizes))
    while len(open_texts):
        wanted = np.zeros(len(sizes), bool)
        wanted[open_texts] = True
        own = wanted[owner]
        ids, ranks, text = _darts(elements[own], weights[own], owner[own], limits)
        coordinate = (mixed(ids ^ _CELL) % np.uint64(k)).astype(np.int64)
        # The coordinate above the rank in one number; ranks differ in their first bits.
        place = text * k + coordinate
        scaled = (ranks * (2.0**39 / limits[text])).astype(np.uint64)
        order = np.argsort((place.astype(np.uint64) << np.uint64(39)) | scaled, kind="stable")
        filled, first = np.unique(place[order], return_index=True)
        table.reshape(-1)[filled] = ids[order[first]]
        counts = np.bincount(filled // k, minlength=len(sizes))
        open_texts = open_texts[counts[open_texts] < k]
        limits[open_texts] *= 2
    return table


def signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The signature of one text."""
    return signatures_of(elements, weights, np.array([len(elements)]), k)[0]


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key a band, for each row of signatures."""
    table = found[:, : bands * rows].reshape(len(found), bands, rows)
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None] * _CELL, len(found), axis=0)
    for i in range(rows):
        keys = mixed(keys * _STEP + table[:, :, i])
    return keys


def _content(text: str, hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that equal texts share: of the words, or of a text without any."""
    raw = hashes.tobytes() if len(hashes) else b"text:" + text.encode()
    number = xxhash.xxh3_128_intdigest(raw)
    low, high = number & (2**64 - 1), number >> 64
    return low - 2**63, high - 2**63


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`doc`, the content hash `c1`, `c2`, and the `keys` of its bands; none without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                piece = batch.slice(start, TEXTS)
                low, high, sets, real = [], [], [], []
                for place, text in enumerate(piece.column(1).to_pylist()):
                    hashes = word_hashes(words_of(text))
                    a, b = _content(text, hashes)
                    low.append(a)
                    high.append(b)
                    if len(hashes):
                        real.append(place)
                        sets.append(counted(shingle_hashes(hashes)))
                keys = [None] * piece.num_rows
                if sets:
                    own = signatures_of(
                        np.concatenate([x for x, _ in sets]),
                        np.concatenate([n for _, n in sets]).astype(np.float64),
                        np.array([len(x) for x, _ in sets]),
                        bands * rows,
                    )
                    found = band_keys(own, bands, rows).view(np.int64)
                    for place, row in zip(real, found, strict=True):
                        keys[place] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(low, pa.int64()),
                        pa.array(high, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc", "c1", "c2", "keys"],
                )

    return docs.mapInArrow(run, "doc long, c1 long, c2 long, keys array<long>")


def multisets(docs: DataFrame) -> DataFrame:
    """`doc`, and its distinct shingles and their counts as packed bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                piece = batch.slice(start, TEXTS)
                found = [
                    counted(shingle_hashes(word_hashes(words_of(text))))
                    for text in piece.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array([s.tobytes() for s, _ in found], pa.binary()),
                        pa.array([n.astype("<u4").tobytes() for _, n in found], pa.binary()),
                    ],
                    names=["doc", "shingles", "counts"],
                )

    return docs.mapInArrow(run, "doc long, shingles binary, counts binary")


@F.pandas_udf(DoubleType())
def _similarity(a: pd.Series, wa: pd.Series, b: pd.Series, wb: pd.Series) -> pd.Series:
    def unpacked(keys: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(keys, np.uint64), np.frombuffer(weights, "<u4")

    rows = zip(a, wa, b, wb, strict=True)
    return pd.Series(
        [generalised_jaccard(*unpacked(x, u), *unpacked(y, v)) for x, u, y, v in rows], dtype=float
    )


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose multisets, those of `a` and `b`, are similar enough.

    The second join meets a hot head on one side and its one row on the other, so the
    adaptive join can split it.
    """
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"), F.col("counts").alias("na"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"), F.col("counts").alias("nb"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(_similarity("sa", "na", "sb", "nb") >= similarity).select(*pairs.columns)


def band_turns(bands: int) -> list[tuple[int, int]]:
    """First and last bands that are compared together: one, then twice as many each time."""
    turns, start, width = [], 0, 1
    while start < bands:
        turns.append((start, min(start + width, bands) - 1))
        start, width = start + width, 2 * width
    return turns


def _labelled(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of buckets with their components. `roots` has the `node` and `root` of
    those that are no roots."""
    return stored(
        buckets.join(roots, F.col("doc") == F.col("node"), "left").select(
            "key", "doc", "company", F.coalesce("root", "doc").alias("root")
        ),
        "labelled",
    )


def heads_of(labelled: DataFrame, order: int) -> DataFrame:
    """`key`, `head` and `head_root` of the buckets whose members are in several components.

    A head is the member that comes first in an order of all documents, so one document
    heads most buckets of a group, and another order brings others. The first order is by
    company, the members of all buckets of a document: the text that the others are copies
    of shares more buckets than they share with each other.
    """
    rank = F.xxhash64(F.lit(order), "doc") if order else -F.col("company")
    return stored(
        labelled.groupBy("key")
        .agg(
            F.min(F.struct(rank.alias("rank"), F.col("doc"), F.col("root"))).alias("head"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .where("low < high")
        .select("key", F.col("head.doc").alias("head"), F.col("head.root").alias("head_root")),
        "bucket-heads",
    )


def head_pairs(labelled: DataFrame, heads: DataFrame) -> DataFrame:
    """`a`, `b` and their components `ra`, `rb`: members of buckets and their head, if apart."""
    apart = labelled.join(heads, "key").where("root != head_root")
    larger = F.col("doc") > F.col("head")
    return apart.select(
        F.greatest("doc", "head").alias("a"),
        F.least("doc", "head").alias("b"),
        F.when(larger, F.col("root")).otherwise(F.col("head_root")).alias("ra"),
        F.when(larger, F.col("head_root")).otherwise(F.col("root")).alias("rb"),
    ).distinct()


def contracted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` after `links` between the components `ra` and `rb`; only these are followed."""
    moved = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    onward = moved.select(F.col("node").alias("passed"), F.col("root").alias("reached"))
    kept = roots.join(onward, F.col("root") == F.col("passed"), "left").select(
        "node", F.coalesce("reached", "root").alias("root")
    )
    return stored(kept.unionAll(moved.select("node", "root")), "roots")


def _linked(
    pairs: DataFrame, sets: DataFrame, similarity: float, roots: DataFrame
) -> tuple[DataFrame, bool]:
    """`roots` after the pairs that are similar enough, and whether these are one in
    `PAIRS_PER_LINK` or more."""
    pairs = stored(pairs, "pairs")
    tried = pairs.count()
    if not tried:
        return roots, False
    new = stored(verified(pairs, sets, similarity), "verified")
    links = new.count()
    if not links:
        return roots, False
    return contracted(roots, new), links * PAIRS_PER_LINK >= tried


def _occurrences(shingles: bytes, counts: bytes) -> np.ndarray:
    """A token for each occurrence of a shingle; two texts share as many as their minima."""
    place, number = _counted_up(np.frombuffer(counts, "<u4").astype(np.int64))
    return mixed(np.frombuffer(shingles, np.uint64)[place] + number.astype(np.uint64) * _CELL)


def _token_counts(sets: DataFrame) -> np.ndarray:
    """How often each of `COUNTERS` slots of tokens occurs, counted in the tasks and summed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                slots, n = np.unique(_occurrences(*packed) % np.uint64(COUNTERS), return_counts=True)
                counts[slots] += n
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int64()), pa.array(counts[slots], pa.int64())], names=["slot", "n"]
        )

    found = sets.select("shingles", "counts").mapInArrow(run, "slot long, n long")
    # At most COUNTERS rows come to the driver.
    table = found.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return counts


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """The rarest tokens of each text: `token`, `doc`, `root`, the text's `size`, the `left`
    tokens from this one on, and whether the text can be met there as the `shorter` one."""
    shared = sets.sparkSession.sparkContext.broadcast(_token_counts(sets))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, root, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = _occurrences(*packed)
                size = len(tokens)
                order = np.lexsort((tokens, shared.value[tokens % np.uint64(COUNTERS)]))
                longest = size - int(np.ceil(similarity * size - 1e-6)) + 1
                own = size - int(np.ceil(2 * similarity / (1 + similarity) * size - 1e-6)) + 1
                first = tokens[order[:longest]].view(np.int64)
                at = np.arange(len(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first),
                        pa.array(np.full(len(first), doc, np.int64)),
                        pa.array(np.full(len(first), root, np.int64)),
                        pa.array(np.full(len(first), size, np.int64)),
                        pa.array(size - at),
                        pa.array(at < own),
                    ],
                    names=["token", "doc", "root", "size", "left", "shorter"],
                )

    schema = "token long, doc long, root long, size long, left long, shorter boolean"
    return sets.select("doc", "root", "shingles", "counts").mapInArrow(run, schema)


def _unmet_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """Every pair `a`, `b` of different roots in `sets` that can be similar enough.

    Of two texts as similar as that, the first token that both have, in the order of all
    tokens, has so many tokens of both texts after it as they must share. It is among the
    `shorter` ones of the shorter text and in the prefix of the longer. What a whole family
    of texts shares comes last in the order, and stands in no `shorter` prefix unless the
    family is similar enough. A token of many texts is dealt out to a grid of tasks: its
    shorter texts to the lines, all its texts to the columns. Each text is repeated once a
    task of its line or column, so the rows follow the pairs that are possible there; a
    token of one shorter text repeats that text alone.
    """
    postings = stored(_prefixes(sets, similarity), "prefixes")
    tokens = stored(
        postings.groupBy("token")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.count_if("shorter").alias("short"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("low < high and short > 0")
        .select(
            "token",
            F.ceil(F.col("short") / POSTINGS).cast("int").alias("lines"),
            F.ceil(F.col("n") / POSTINGS).cast("int").alias("columns"),
        ),
        "prefix-tokens",
    )
    x, y = grid(postings.join(tokens, "token"))
    shared = similarity / (1 + similarity) * (F.col("size_x") + F.col("size_y")) - 1e-6
    met = x.join(y, ["token", "line", "column"]).where(
        (F.col("root_x") != F.col("root_y"))
        & (F.struct("size_x", "doc_x") < F.struct("size_y", "doc_y"))
        & (F.least("left_x", "left_y") >= shared)
    )
    first = F.col("doc_x") > F.col("doc_y")
    return met.select(
        F.greatest("doc_x", "doc_y").alias("a"),
        F.least("doc_x", "doc_y").alias("b"),
        F.when(first, F.col("root_x")).otherwise(F.col("root_y")).alias("ra"),
        F.when(first, F.col("root_y")).otherwise(F.col("root_x")).alias("rb"),
    ).distinct()


def grid(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join by token, line and column: shorter texts, and all texts."""

    def side(mark: str, line, column) -> DataFrame:
        names = [F.col(c).alias(f"{c}_{mark}") for c in ("doc", "root", "size", "left")]
        chosen = placed.where("shorter" if mark == "x" else "true")
        return chosen.select("token", *names, line.alias("line"), column.alias("column"))

    def one_of(count: str):
        return F.pmod(F.xxhash64("doc"), F.col(count)).cast("int")

    def each_of(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    return (
        side("x", one_of("lines"), each_of("columns")),
        side("y", each_of("lines"), one_of("columns")),
    )


def _unmet(labelled: DataFrame) -> DataFrame:
    """`doc` and `root` of the members of buckets that hold several roots. Two members alone
    have met as head and member."""
    mixed_keys = (
        labelled.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high and n > 2")
        .select("key")
    )
    return labelled.join(mixed_keys, "key", "left_semi").select("doc", "root").distinct()


def classes(
    docs: DataFrame,
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """`doc_id` and `class_id`, the smallest id among the documents linked to it."""
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    with small_batches(docs.sparkSession, BATCH):
        roots = _roots(given, similarity, bands, rows)
    named = given.select(F.col("doc").alias("doc_id"))
    return named.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("class_id")
    )


def _roots(given: DataFrame, similarity: float, bands: int, rows: int) -> DataFrame:
    """`node` and `root`, a stored table, of the documents that are not their class's first."""
    real = given.where("doc is not null and text is not null and text != ''")
    signed = stored(signatures(real, bands, rows), "signatures")

    # Copies meet by their content hash; the group combines before it is shuffled.
    first = stored(signed.groupBy("c1", "c2").agg(F.min("doc").alias("first")), "first-copies")
    copies = stored(
        signed.select("doc", "c1", "c2").join(first, ["c1", "c2"]).where("doc > first")
        .select(F.col("doc").alias("a"), F.col("first").alias("b")).distinct(),
        "copies",
    )
    # Rows with one id and several texts can link copies further.
    roots = stored(components(copies), "roots")
    nodes = signed.join(
        first.select("c1", "c2", F.col("first").alias("doc")), ["c1", "c2", "doc"], "left_semi"
    )
    every = nodes.select("doc", F.posexplode("keys").alias("band", "key"))
    span = every.groupBy("key").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n")
    )
    shared = stored(span.where("low < high").select("key", "n"), "shared-keys")
    crowded = stored(every.join(shared, "key"), "crowded")
    company = stored(crowded.groupBy("doc").agg(F.sum("n").alias("company")), "company")
    buckets = stored(crowded.select("band", "key", "doc").join(company, "doc"), "buckets")
    members = company.select("doc")
    sets = stored(multisets(real.join(members, "doc", "left_semi")), "multisets")

    # A bucket whose members are in one component stays so: later rounds leave it out.
    mixed_buckets, many = [], False
    for start, end in band_turns(bands):
        own = buckets.where(F.col("band").between(start, end))
        labelled = _labelled(own, roots)
        heads = heads_of(labelled, 0)
        roots, many = _linked(head_pairs(labelled, heads), sets, similarity, roots)
        mixed_buckets.append(own.join(heads.select("key"), "key", "left_semi"))
    remaining = stored(reduce(DataFrame.unionAll, mixed_buckets), "mixed-buckets")
    labelled = _labelled(remaining, roots)
    for order in count(1):
        if not many:
            break
        heads = heads_of(labelled, order)
        roots, many = _linked(head_pairs(labelled, heads), sets, similarity, roots)
        remaining = stored(remaining.join(heads.select("key"), "key", "left_semi"), "mixed-buckets")
        labelled = _labelled(remaining, roots)
    unmet = stored(_unmet(labelled), "unmet")
    if not unmet.isEmpty():
        residual = stored(sets.join(unmet, "doc"), "unmet-multisets")
        roots, _ = _linked(_unmet_pairs(residual, similarity), sets, similarity, roots)
    return roots


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class, the one with the smallest id; null ids stay."""
    return without(docs, classes(docs, **settings).where("doc_id != class_id").select("doc_id"))

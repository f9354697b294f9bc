"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are parted by the number of their distinct shingles, by powers of two. For each
hash function the item's smallest shingle is a sample of it: a document that contains a
share `c` of the item contains each sample with probability `c`, however long it is. A
partition sets how many functions its items use and how many of their samples must be in
the document so that less than one item in a million is missed; items with fewer shingles
than functions are sampled whole. Every candidate is verified by exact containment.

Texts are compared by runs of five words in lower case. An item of fewer words is one run of
all its words, and documents are searched for runs of that length as well. Items without
words are never found; null or empty documents contain nothing. Rows with equal ids are
one document or item and hold the shingles of all their texts; rows with a null id are
left out of the search and are kept when contaminated documents are removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lamina.llm.frames import without
from lamina.llm.shingles import WORDS, mixed, shingle_hashes, word_hashes, words_of
from lamina.sources import stored

CONTAINMENT = 0.8
MISSED = 1e-6
FUNCTIONS = 24
#: The filter that documents are read against has this many bits, whatever the items.
FILTER_BITS = 22
ROWS = 256


def needed_hits(functions: int, containment: float, missed: float) -> int:
    """The most samples to ask for so that no more than the share `missed` is lost."""
    lost = 0.0
    for hits in range(functions + 1):
        lost += comb(functions, hits) * containment**hits * (1 - containment) ** (functions - hits)
        if lost > missed:
            return max(hits, 1)
    return functions


def functions_of(size: int, most: int = FUNCTIONS) -> int:
    """Hash functions of the partition that holds items of this size; 0: sampled whole."""
    upper = 1 << (size - 1).bit_length()
    return most if upper > most else 0


def samples_of(shingles: np.ndarray, functions: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct smallest shingles and the number of functions that chose each."""
    if functions == 0:
        return shingles, np.ones(len(shingles), np.int64)
    chosen = [
        shingles[mixed(shingles ^ seed).argmin()]
        for seed in mixed(np.arange(1, functions + 1, dtype=np.uint64))
    ]
    return np.unique(np.array(chosen, np.uint64), return_counts=True)


def _item_shingles(text: str | None) -> tuple[int, np.ndarray]:
    hashes = word_hashes(words_of(text))
    size = min(WORDS, len(hashes))
    return size, np.unique(shingle_hashes(hashes, size))


def sample_items(
    items: DataFrame,
    containment: float = CONTAINMENT,
    missed: float = MISSED,
    functions: int = FUNCTIONS,
) -> DataFrame:
    """A row an item: `item`, `words` of its runs, `shingles`, `samples`, `votes`, `needed`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [
                ("item", pa.int64()),
                ("words", pa.int64()),
                ("shingles", pa.binary()),
                ("samples", pa.list_(pa.int64())),
                ("votes", pa.list_(pa.int64())),
                ("needed", pa.int64()),
            ]
        )
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, own = _item_shingles(text)
                if not len(own):
                    continue
                used = functions_of(len(own), functions)
                samples, votes = samples_of(own, used)
                if used:
                    needed = needed_hits(used, containment, missed)
                else:
                    needed = int(np.ceil(containment * len(own) - 1e-9))
                rows.append(
                    {
                        "item": item,
                        "words": words,
                        "shingles": own.tobytes(),
                        "samples": samples.view(np.int64),
                        "votes": votes,
                        "needed": needed,
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, kinds)

    schema = (
        "item long, words long, shingles binary, samples array<long>, votes array<long>,"
        " needed long"
    )
    return items.mapInArrow(run, schema)


def _document_shingles(text: str | None, sizes: list[int]) -> np.ndarray:
    hashes = word_hashes(words_of(text))
    found = [shingle_hashes(hashes, n) for n in sizes if len(hashes) >= n]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def _places(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - FILTER_BITS)


def _matching(docs: DataFrame, places: list[int], sizes: list[int]) -> DataFrame:
    """`doc`, `hash` for each shingle of a document that may be a sample.

    The filter has a fixed number of bits, so what is broadcast does not grow with the
    items; with very many items it only lets more rows through to the join.
    """
    allowed = np.zeros(1 << FILTER_BITS, bool)
    allowed[places] = True
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(allowed), sizes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, lengths = shared.value
        bits = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                texts = piece.column(1).to_pylist()
                ids, hashes = [], []
                for doc, text in zip(piece.column(0).to_pylist(), texts, strict=True):
                    own = word_hashes(words_of(text))
                    for n in lengths:
                        if len(own) >= n:
                            found = shingle_hashes(own, n)
                            found = np.unique(found[bits[_places(found)]])
                            ids.append(np.full(len(found), doc, np.int64))
                            hashes.append(found)
                if ids:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(ids)),
                            pa.array(np.concatenate(hashes).view(np.int64)),
                        ],
                        names=["doc", "hash"],
                    )

    return docs.mapInArrow(run, "doc long, hash long")


def _sets(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """`doc` and all its distinct shingles as packed bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                found = [
                    _document_shingles(text, sizes).tobytes()
                    for text in piece.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(found, pa.binary())], names=["doc", "shingles"]
                )

    return docs.mapInArrow(run, "doc long, shingles binary")


@F.pandas_udf(DoubleType())
def _containment(document: pd.Series, item: pd.Series) -> pd.Series:
    shares = []
    for d, i in zip(document, item, strict=True):
        whole, part = np.frombuffer(d, np.uint64), np.frombuffer(i, np.uint64)
        shares.append(np.isin(part, whole, assume_unique=True).mean())
    return pd.Series(shares, dtype=float)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    missed: float = MISSED,
    functions: int = FUNCTIONS,
) -> DataFrame:
    """`doc_id`, `item_id` and `containment`, the share of the item that the document holds."""
    real = docs.select(
        F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text")
    ).where("doc is not null and text is not null")
    asked = items.select(
        F.col("item_id").cast("bigint").alias("item"), F.col("text").cast("string").alias("text")
    ).where("item is not null and text is not null")
    # Texts of one item become one text per row; each is searched for by itself.
    sampled = stored(
        sample_items(asked, containment, missed, functions).withColumn(
            "part", F.monotonically_increasing_id()
        ),
        "items",
    )
    votes = stored(
        sampled.select("item", "part", "needed", F.arrays_zip("samples", "votes").alias("z"))
        .select("item", "part", "needed", F.explode("z").alias("z"))
        .select(
            "item",
            "part",
            "needed",
            F.col("z.samples").alias("hash"),
            F.col("z.votes").alias("votes"),
        ),
        "item-samples",
    )
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS).cast("int")
    # Bounded by the number of bits, and by the few lengths of short items.
    places = [r[0] for r in votes.select(place).distinct().collect()]
    sizes = sorted(r[0] for r in sampled.select("words").distinct().collect())
    matching = _matching(real, places, sizes)
    candidates = stored(
        matching.join(votes, "hash")
        .groupBy("doc", "item", "part")
        .agg(F.sum("votes").alias("votes"), F.max("needed").alias("needed"))
        .where("votes >= needed")
        .select("doc", "item", "part"),
        "candidates",
    )
    wanted = candidates.select("doc").distinct()
    sets = stored(_sets(real.join(wanted, "doc", "left_semi"), sizes), "candidate-sets")
    own = sampled.select("part", F.col("shingles").alias("item_shingles"))
    joined = candidates.join(sets, "doc").join(own, "part")
    share = joined.withColumn("share", _containment("shingles", "item_shingles"))
    return (
        share.where(F.col("share") >= containment - 1e-9)
        .groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))
        .agg(F.max("share").alias("containment"))
    )


def keep_clean(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents that hold no item, with the columns that they came with."""
    return without(docs, contaminated(docs, items, **settings).select("doc_id"))

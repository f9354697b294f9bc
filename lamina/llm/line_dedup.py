"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches of ascending id. A batch's line hashes are anti-joined with the
runs of all earlier batches: what is found there was seen in a smaller document. The new
hashes become a sorted run of level 0; where a level has `fanout` runs, they are merged
into one run of the next level, so that a batch meets few runs.

A line's key is the line without the white space U+0020 and U+0009 to U+000D at both ends,
with A to Z in lower case. Keys of at least `min_chars` code points that occur in several
documents keep their lines in the document with the smallest id only.

A null or empty text is one empty line. Rows with the same id are one document. A null id
comes after all others. Rows of equal id and text are one document repeated, each kept
with the same result. An empty table gives an empty one. Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.frames import packed, unpacked
from lamina.sources import stored

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2

# The white space of the keys, and what stands in for a null id.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = 2**63 - 1

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line stripped and in ASCII lower case; `lower` is faster where all is ASCII."""
    stripped = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(stripped) == F.length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER))


def lines_of(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """`doc`, `row`, `pos` and the hashes `h1`, `h2` of each line long enough to be compared.

    The hash has 128 bits, so different keys do not meet. `row` tells texts of one id apart.
    """
    split = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(F.col(text)).alias("row"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    keyed = split.select("doc", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc",
        "row",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
    )


@dataclass
class Runs:
    """Sorted runs of the hashes seen so far, by level."""

    fanout: int = FANOUT
    levels: list[list[DataFrame]] = field(default_factory=list)

    def tables(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The hashes that no run holds."""
        return reduce(lambda left, run: left.join(run, HASH, "left_anti"), self.tables(), hashes)

    def add(self, hashes: DataFrame) -> None:
        """Store new hashes as a run, and merge levels that are full."""
        self._put(0, stored(hashes.sortWithinPartitions(*HASH), "line-run"))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = reduce(DataFrame.unionAll, self.levels[level])
            self.levels[level] = []
            ordered = merged.repartition(*HASH).sortWithinPartitions(*HASH)
            self._put(level + 1, stored(ordered, "line-run"))


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into batches of about the same size."""
    if batches < 2:
        return []
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"))
    shares = [i / batches for i in range(1, batches)]
    found = ids.agg(F.percentile_approx("doc", shares, 1000)).first()[0]
    return sorted({x for x in found or [] if x < LAST_ID})


def first_holders(lines: DataFrame, bounds: list[int], runs: Runs) -> DataFrame:
    """For each key that costs lines: `h1`, `h2`, `batch`, and `keeper`, the document that
    keeps it, null where it is in an earlier batch.

    Keys are grouped before they are joined, and the groups combine before the shuffle.
    A key of one document that no run holds costs nothing and is left out.
    """
    found = []
    for number in range(len(bounds) + 1):
        own = lines.where(F.col("batch") == number)
        keys = stored(
            own.groupBy(*HASH).agg(F.min("doc").alias("keeper"), F.max("doc").alias("last")),
            "line-keys",
        )
        last_batch = number == len(bounds)
        if not runs.tables():
            new, old = keys, None
        else:
            new = stored(runs.unseen(keys), "line-new")
            old = keys.join(new.select(*HASH), HASH, "left_anti")
        if not last_batch:
            runs.add(new.select(*HASH))
        costly = new.where("keeper < last").select(*HASH, "keeper")
        if old is not None:
            costly = costly.unionAll(old.select(*HASH, F.lit(None).cast("bigint").alias("keeper")))
        found.append(costly.withColumn("batch", F.lit(number)))
    return stored(reduce(DataFrame.unionAll, found), "line-holders")


def dropped_lines(
    docs: DataFrame,
    text: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """`doc`, `row` and `gone`, the sorted positions of the lines to drop, where there are any."""
    bounds = batch_bounds(docs, batches)
    number = sum([(F.col("doc") > bound).cast("int") for bound in bounds], F.lit(0))
    lines = stored(lines_of(docs, text, min_chars).withColumn("batch", number), "lines")
    holders = first_holders(lines, bounds, Runs(fanout))
    # The holders are unique by key, so a hot line is split on this side by the adaptive join.
    lost = lines.join(holders, [*HASH, "batch"]).where(
        F.col("keeper").isNull() | (F.col("keeper") != F.col("doc"))
    )
    return lost.groupBy("doc", "row").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def deduplicate(
    docs: DataFrame,
    text: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """`docs` with the kept lines in `text`, and `n_lines` and `n_dropped`.

    The positions are of one document's lines; they are walked once beside the lines, so
    the cost is in proportion to the text. Where nothing is dropped the text stays as it is.
    """
    plain = docs.drop("n_lines", "n_dropped", "_doc", "_row", "_gone", "_lines")
    gone = dropped_lines(plain, text, min_chars, batches, fanout).select(
        F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.col("gone").alias("_gone")
    )
    keyed = plain.withColumns(
        {
            "_doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)),
            "_row": F.xxhash64(F.col(text)),
        }
    )
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    joined = keyed.join(gone, ["_doc", "_row"], "left")
    marked = joined.withColumn("_lines", F.when(F.col("_gone").isNotNull(), lines))
    lost = F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint")
    # Slices between the dropped lines; as many as there are dropped lines, and one.
    starts = F.concat(F.array(F.lit(-1)), F.col("_gone"))
    ends = F.concat(F.col("_gone"), F.array(F.size("_lines")))
    slices = F.zip_with(
        starts, ends, lambda a, b: F.slice(F.col("_lines"), a + F.lit(2), b - a - F.lit(1))
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    breaks = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit("")))
    kept = F.when(F.col("_gone").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.flatten(slices), "\n")
    )
    return marked.select(
        *[kept.alias(c) if c == text else F.col(f"`{c}`") for c in plain.columns],
        (breaks + 1).cast("bigint").alias("n_lines"),
        lost.alias("n_dropped"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_lines` before dropping, `n_dropped`, and the SHA-256 of what is kept."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return deduplicate(rows).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with their kept lines, in the columns that they came with.

    `n_chars`, if they have it, is counted anew.
    """
    rows = deduplicate(packed(docs, "doc_id", "text"))
    kept = unpacked(rows, docs.columns, "doc_id", "text")
    counted = {"n_chars": F.length("text").cast("bigint")} if "n_chars" in docs.columns else {}
    return kept.withColumns(counted)

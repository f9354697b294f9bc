"""Document fingerprints by consistent weighted sampling.

A text is a bag of words weighted by their counts. For each sample every word draws, from
its hash, two gamma variables and an offset; the word with the earliest arrival is the
sample, together with the step of its weight. Two texts have the same sample with the
probability of their generalised Jaccard similarity, so the share of equal samples of two
fingerprints estimates it.

Words are runs of letters and digits in lower case. A text without words is sampled as a
whole: equal ones have equal fingerprints, others differ. A null text is an empty one.
Null ids come after all others, repeated ids are in the order of their texts' hashes;
repeated rows stay repeated. An empty table gives an empty one. Only built-in functions
are used.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.frames import hashed_lists
from lamina.sources import stored

SAMPLES = 64
GROUP = 4
DOCS_PER_RANGE = 500
#: Ranges only part the work; beyond this many they grow instead.
MOST_RANGES = 100_000
#: Words and counts whose holders a task collects by hashing, without sorting them first.
HASHED_WORDS = 100_000

# What stands in for a null id, and the fields of the hashes.
LAST_ID = 2**63 - 1
FIELD, FIELD_BITS = 2**21 - 1, 21
WIDE, WIDE_BITS = 2**31 - 1, 31


def _uniform(bits: Column, size: int) -> Column:
    """A number above 0 and at most 1 from a field of a hash."""
    return (bits.cast("double") + 1.0) / F.lit(float(size + 1))


def _in_groups(samples: int) -> Column:
    """The numbers of the groups of `GROUP` samples, one a row."""
    return F.sequence(F.lit(0), F.lit(ceil(samples / GROUP) - 1))


def _arrivals(rows: DataFrame, *keep: str) -> DataFrame:
    """`keep`, and the arrivals `m0`, `m1`, ... of a term in the samples of a `group`.

    `rows` has `term`, `group`, and `ln`, the logarithm of the term's weight. With `r` and
    `c` from a gamma distribution of shape 2 and `b` uniform, all from the hash of term and
    sample, the step of a weight is `t = floor(ln / r + b)` and its arrival
    `c * exp(-r * (t - b + 1))`. The logarithm of the arrival is in the upper bits of a
    number whose least value is the sample; the lower bits are a hash of term and step.

    Each step is a projection of its own: so every logarithm is taken once and the
    generated methods stay small enough to be compiled.
    """
    numbers = range(GROUP)
    hashed = rows.select(
        *keep,
        "ln",
        *[F.xxhash64("term", "group", F.lit(2 * n)).alias(f"x{n}") for n in numbers],
        *[F.xxhash64("term", "group", F.lit(2 * n + 1)).alias(f"y{n}") for n in numbers],
    )

    def gamma(bits: str, size: int, width: int) -> Column:
        low = _uniform(F.col(bits).bitwiseAND(F.lit(size)), size)
        high = _uniform(F.shiftrightunsigned(bits, width).bitwiseAND(F.lit(size)), size)
        return F.lit(1e-12) - F.log(low * high)

    drawn = hashed.select(
        *keep,
        "ln",
        *[f"y{n}" for n in numbers],
        *[gamma(f"x{n}", FIELD, FIELD_BITS).alias(f"r{n}") for n in numbers],
        *[F.log(gamma(f"y{n}", WIDE, WIDE_BITS)).alias(f"c{n}") for n in numbers],
        *[
            _uniform(
                F.shiftrightunsigned(f"x{n}", 2 * FIELD_BITS).bitwiseAND(F.lit(FIELD)), FIELD
            ).alias(f"b{n}")
            for n in numbers
        ],
    )
    stepped = drawn.select(
        *keep,
        *[f"{kind}{n}" for kind in "yrcb" for n in numbers],
        *[F.floor(F.col("ln") / F.col(f"r{n}") + F.col(f"b{n}")).alias(f"t{n}") for n in numbers],
    )

    def arrival(n: int) -> Column:
        t, y = F.col(f"t{n}"), F.col(f"y{n}")
        late = F.col(f"c{n}") - F.col(f"r{n}") * (t.cast("double") - F.col(f"b{n}") + 1.0)
        scaled = ((late + 200.0) * float(2**30)).cast("bigint")
        return F.shiftleft(scaled, 24).bitwiseOR(F.shiftrightunsigned(F.xxhash64(y, t), 40))

    return stepped.select(*keep, *[arrival(n).alias(f"m{n}") for n in numbers])


def _gathered(samples: int, parts: str, side: str) -> Column:
    """The samples of all groups one after another; nulls where there is no term."""
    found = F.slice(F.flatten(F.col(f"{parts}.{side}")), 1, samples)
    none = F.array_repeat(F.lit(None).cast("bigint"), samples)
    return F.when(F.size(parts) > 0, found).otherwise(none)


def _of_texts(samples: str, whole: Column) -> Column:
    """The samples; those of a text without words come from its hash."""
    return F.transform(
        F.col(samples), lambda x, place: F.coalesce(x, F.xxhash64(whole, place))
    )


def words(text: Column) -> Column:
    """The words, and empty strings at the ends or where there is no word."""
    return F.split(F.lower(text), "[^\\p{L}\\p{N}]+", -1)


def as_text(samples: Column) -> Column:
    """Four hexadecimal digits a sample."""
    return F.array_join(
        F.transform(samples, lambda x: F.lpad(F.hex(F.xxhash64(x).bitwiseAND(F.lit(65535))), 4, "0")), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    total = F.aggregate(same, F.lit(0), lambda s, x: s + x)
    return total / F.size(a)


def fingerprints(docs: DataFrame, text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """`doc_id` and the `samples` of each whole text, an array of longs."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    each = rows.select(
        "row",
        "doc_id",
        F.xxhash64("text").alias("whole"),
        F.explode(words(F.col("text"))).alias("word"),
    )
    counted = (
        each.groupBy("row", "doc_id", "whole", F.xxhash64("word").alias("term"))
        .agg(F.sum((F.col("word") != "").cast("int")).alias("n"))
        .withColumn("ln", F.log(F.col("n").cast("double")))
    )
    keys = ["row", "doc_id", "whole"]
    grouped = counted.select(*keys, "term", "ln", F.explode(_in_groups(samples)).alias("group"))
    least = _arrivals(grouped, *keys, "group").groupBy(*keys, "group").agg(
        F.array(*[F.min(f"m{n}") for n in range(GROUP)]).alias("least")
    )
    found = least.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("group", "least"))).alias("parts")
    )
    own = found.select("doc_id", "whole", _gathered(samples, "parts", "least").alias("own"))
    return own.select("doc_id", _of_texts("own", F.col("whole")).alias("samples"))


def _ranged(rows: DataFrame, per_range: int) -> DataFrame:
    """`rows` with the number of the range of ids that holds each."""
    n = rows.count()
    wanted = min(ceil(n / per_range), MOST_RANGES)
    shares = [i / wanted for i in range(1, wanted)]
    found = rows.agg(F.percentile_approx("doc", shares, 10 * wanted)).first()[0] if shares else []
    splits = sorted({float(x) for x in found or []})
    ranges = Bucketizer(
        splits=[-float("inf"), *splits, float("inf")], inputCol="_place", outputCol="range"
    )
    placed = rows.withColumn("_place", F.col("doc").cast("double"))
    if not splits:
        return rows.withColumn("range", F.lit(0))
    return ranges.transform(placed).drop("_place").withColumn("range", F.col("range").cast("int"))


def _placing_keys(spark: SparkSession, partitions: int) -> list[int]:
    """A number for each partition that its hash places there, so no two ranges share one.

    Of sixteen numbers a partition nearly always one fits; where none does, any will do.
    """
    tried = spark.range(16 * partitions).select(
        "id", F.pmod(F.hash("id"), F.lit(partitions)).alias("partition")
    )
    found = tried.groupBy("partition").agg(F.min("id").alias("id")).collect()
    keys = {row["partition"]: row["id"] for row in found}
    return [keys.get(i, 16 * partitions + i) for i in range(partitions)]


def _with_next(rows: DataFrame, per_range: int) -> DataFrame:
    """`rows` with the id, text hash and text of the row after each, the first after the last.

    The rows are dealt out by ranges of ids, and each range also gets the first row of the
    range after it. So the texts are shuffled once, and no window spans the table.
    """
    ranged = _ranged(rows, per_range)
    firsts = ranged.groupBy("range").agg(F.min(F.struct("doc", "whole")).alias("first"))
    # One small row a range, of which there are MOST_RANGES at most.
    order = sorted(firsts.collect())
    previous = [
        (order[i - 1]["range"], at["first"]["doc"], at["first"]["whole"])
        for i, at in enumerate(order)
    ]
    spark = rows.sparkSession
    partitions = max(len(order), 1)
    keys = _placing_keys(spark, partitions)
    slots = spark.createDataFrame(
        [(at["range"], keys[i]) for i, at in enumerate(order)], "slot_range int, slot long"
    )
    heads = spark.createDataFrame(previous, "head_range int, doc long, whole long")
    # A repeated first row would come more than once; any of them will do.
    ghosts = stored(
        rows.join(F.broadcast(heads), ["doc", "whole"])
        .dropDuplicates(["head_range"])
        .select("doc", "doc_id", "whole", "text", F.col("head_range").alias("range"), F.lit(1).alias("ghost")),
        "range-heads",
    )
    every = ranged.select("doc", "doc_id", "whole", "text", "range", F.lit(0).alias("ghost")).unionAll(
        ghosts
    )
    order_by = Window.partitionBy("slot").orderBy("ghost", "doc", "whole")
    # As many partitions as ranges: merged ones would spill when their words are counted.
    placed = every.join(F.broadcast(slots), F.col("range") == F.col("slot_range")).drop(
        "range", "slot_range"
    )
    return placed.repartition(partitions, "slot").withColumns(
        {
            "place": F.row_number().over(order_by),
            "next_doc": F.lead("doc").over(order_by),
            "next_whole": F.lead("whole").over(order_by),
            "next_text": F.lead("text").over(order_by),
        }
    ).where("ghost = 0")


def _sampled_in_ranges(counted: DataFrame, keys: list[str], samples: int) -> DataFrame:
    """`keys` and the samples `own` and `other` of both texts of each document.

    `counted` has a row a document and term with its counts `n0` and `n1` in the texts, and
    a row a document without any count, which carries the document's keys to the end.
    """
    place, known = keys[:2], F.struct(*keys[2:])
    n0, n1 = F.col("n0"), F.col("n1")

    def entry(n: Column, texts: int, document: Column) -> Column:
        return F.struct(n.alias("n"), F.lit(texts).alias("texts"), document.alias("document"))

    none = F.lit(None).cast(counted.select(known).schema[0].dataType)
    entries = (
        F.when(n0 + n1 == 0, F.array(entry(n0, 0, known)))
        .when(n0 == n1, F.array(entry(n0, 3, none)))
        .otherwise(
            F.filter(F.array(entry(n0, 1, none), entry(n1, 2, none)), lambda e: e["n"] > 0)
        )
    )
    held = counted.select(*place, "term", F.explode(entries).alias("e")).select(
        "slot", "term", "e.n", F.struct("place", "e.texts", "e.document").alias("holder")
    )
    # The documents of one range that hold a term as often are a short list.
    once = held.groupBy("slot", "term", "n").agg(F.collect_list("holder").alias("holders"))
    groups = F.when(F.col("n") > 0, _in_groups(samples)).otherwise(F.array(F.lit(-1)))
    drawn = once.select(
        "slot",
        "term",
        F.log(F.when(F.col("n") > 0, F.col("n").cast("double"))).alias("ln"),
        "holders",
        F.explode(groups).alias("group"),
    )
    numbers = range(GROUP)
    arrived = _arrivals(drawn, "slot", "group", "holders").select(
        "slot", "group", *[f"m{n}" for n in numbers], F.inline("holders")
    )

    def least(text: int) -> Column:
        held_there = F.col("texts").bitwiseAND(F.lit(text)) > 0
        return F.array(*[F.min(F.when(held_there, F.col(f"m{n}"))) for n in numbers])

    mins = arrived.groupBy(*place, "document", "group").agg(
        least(1).alias("g0"), least(2).alias("g1")
    )
    whole = mins.groupBy(*place).agg(
        F.sort_array(F.collect_list(F.struct("group", "g0", "g1"))).alias("every"),
        F.max("document").alias("document"),
    )
    parts = whole.select(
        *place, "document.*", F.filter("every", lambda part: part["group"] >= 0).alias("parts")
    )
    sampled = parts.select(
        *keys,
        _gathered(samples, "parts", "g0").alias("s0"),
        _gathered(samples, "parts", "g1").alias("s1"),
    )
    return sampled.select(
        *keys,
        _of_texts("s0", F.col("whole")).alias("own"),
        _of_texts("s1", F.col("edited_whole")).alias("other"),
    )


def with_edits(docs: DataFrame, samples: int = SAMPLES, per_range: int = DOCS_PER_RANGE) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document.

    The edited text has the first half of the document and, in place of the other, as much
    of the next document's beginning. `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`,
    `edited_fingerprint`, and the likenesses `near_edited` and `near_next`.

    In a range of documents a word of one count is drawn for once, however many texts and
    edited texts hold it as often; they take its arrivals from there. Counting and sampling
    stay in the ranges the texts are in, without another shuffle.
    """
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = plain.select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), "doc_id", F.xxhash64("text").alias("whole"), "text"
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = _with_next(rows, per_range).withColumn("n_chars", F.length("text").cast("bigint")).withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
            F.substring("next_text", F.lit(1), half),
        ),
    )
    sha = F.sha2("edited", 256)
    # The digest as four numbers, so that all keys of the groups have a fixed width.
    digest = [
        F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("bigint").alias(f"sha{i}")
        for i in range(4)
    ]
    known = ["doc", "whole", "next_doc", "next_whole", "n_chars", "edited_whole"]
    known += [f"sha{i}" for i in range(4)]
    keys = ["slot", "place", *known]
    # The last side has no words: its one row is there for every document.
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")),
        F.struct(F.lit(2).alias("side"), F.lit("").alias("text")),
    )
    parts = edited.select(
        *keys[:7], F.xxhash64("edited").alias("edited_whole"), *digest, F.explode(sides).alias("part")
    ).select(*keys, "part.side", F.explode(words(F.col("part.text"))).alias("word"))
    counted = (
        parts.where("word != '' or side = 2")
        .groupBy(*keys, F.xxhash64("word").alias("term"))
        .agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"))
    )
    with hashed_lists(docs.sparkSession, HASHED_WORDS):
        found = stored(_sampled_in_ranges(counted, keys, samples), "fingerprints")
    following = found.select(
        F.col("doc").alias("next_doc"), F.col("whole").alias("next_whole"), F.col("own").alias("after")
    ).dropDuplicates(["next_doc", "next_whole"])
    joined = found.join(following, ["next_doc", "next_whole"])
    return joined.select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc_id"),
        "n_chars",
        F.lower(F.concat(*[F.lpad(F.hex(f"sha{i}"), 16, "0") for i in range(4)])).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )

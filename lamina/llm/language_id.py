"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and every run of characters that are no letters, as Unicode has
them, becomes one space; the n-grams of one to `max_n` characters are hashed into `2 ** hash_bits` bins. Counts per
language and bin are gathered over all labelled rows. The matrix of log probabilities has
one row a bin and one column a language, so its size depends on these alone; it is
broadcast. A batch of texts is a sparse matrix of texts by bins, in rows one after another
with the bins of each text's n-grams, and its product with the matrix scores the batch.

Labelled rows whose text is null or has no letter teach nothing; rows without a language
are not learned from. A text that is null or has no letter is `und` with score 0. Equal
texts get equal results. Without any labelled row every text is `und` with score 0. Rows
are kept as they are, also repeated ones; columns that the result adds replace ones of the
same name.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.frames import packed, unpacked
from lamina.sources import held

MAX_N = 4
HASH_BITS = 16
SMOOTHING = 0.5
#: N-grams that count as independent evidence; the score of longer texts grows no further.
EVIDENCE = 20
#: No more languages than this, so that the matrix stays small.
MAX_LANGUAGES = 512
UNKNOWN = "und"
ROWS = 128
CHARACTERS = 1 << 20
#: Numbers that a batch's product gathers.
CELLS = 1 << 19



def _numerals() -> str:
    """The characters that a regular expression has for word characters but that are no
    letters and no decimal digits, as ranges: superscripts, fractions, Roman numerals."""
    marked = [chr(c).isalnum() and not chr(c).isalpha() for c in range(sys.maxunicode + 1)]
    edges = np.flatnonzero(np.diff(np.array([False, *marked, False]).astype(np.int8)))
    return "".join(
        f"\\U{start:08x}-\\U{end - 1:08x}" for start, end in zip(edges[::2], edges[1::2], strict=True)
    )


_NO_WORDS = re.compile(r"[\W\d_]+")
_NO_LETTERS = re.compile(rf"[\W\d_{_numerals()}]+")


def normalised(text: str) -> str:
    """Lower-case letters with single spaces between and around words; empty without any."""
    words = _NO_WORDS.sub(" ", text.lower()).strip()
    if words and not words.replace(" ", "").isalpha():
        words = _NO_LETTERS.sub(" ", words).strip()
    return f" {words} " if words else ""


def ngram_bins(text: str, max_n: int, bits: int) -> Iterator[np.ndarray]:
    """For each length from 1 on, the bins of the n-grams that begin at each place."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    mixed = codes * np.uint32(0x9E3779B1)
    rolling = np.zeros(len(codes), np.uint32)
    for n in range(1, min(max_n, len(codes)) + 1):
        # The n-gram that begins at each place, from the one that is shorter by a character.
        rolling = (rolling[: len(codes) - n + 1] * np.uint32(0x85EBCA6B)) ^ mixed[n - 1 :]
        spread = rolling ^ (rolling >> np.uint32(15))
        spread = (spread + np.uint32(n)) * np.uint32(0xC2B2AE35)
        yield spread >> np.uint32(32 - bits)


def _pieces(text: str, most: int = CHARACTERS) -> Iterator[str]:
    """A long text in pieces cut between words, so that memory stays bounded."""
    at = 0
    while len(text) - at > most:
        cut = text.rfind(" ", at + 1, at + most)
        cut = at + most if cut <= at else cut
        yield text[at : cut + 1]
        at = cut
    yield text[at:]


def count_ngrams(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_n: int = MAX_N,
    bits: int = HASH_BITS,
) -> DataFrame:
    """`lang`, `bin`, `n` over all rows; each task adds up before anything is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def add_up() -> None:
            for language, found in waiting.items():
                own = np.bincount(np.concatenate(found), minlength=1 << bits)
                totals[language] = totals.get(language, 0) + own
            waiting.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                for language, content in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    clean = normalised(content)
                    for piece in _pieces(clean) if clean else ():
                        waiting.setdefault(language, []).extend(ngram_bins(piece, max_n, bits))
                        size += max_n * len(piece)
                        if size > CELLS:
                            add_up()
                            size = 0
        add_up()
        for language, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([language] * len(used), pa.string()),
                    pa.array(used.astype(np.int32)),
                    pa.array(counts[used]),
                ],
                names=["lang", "bin", "n"],
            )

    labelled = docs.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    ).where("lang is not null and text is not null")
    counted = labelled.mapInArrow(run, "lang string, bin int, n long")
    return counted.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


class NaiveBayes:
    """Languages and the log probabilities of the bins under each."""

    def __init__(self, languages: list[str], weights: np.ndarray, max_n: int, bits: int):
        self.languages, self.weights, self.max_n, self.bits = languages, weights, max_n, bits

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its share of the evidence.

        The log probabilities of a text are averaged over its n-grams and weighed as
        `EVIDENCE` of them at most; n-grams overlap, so more would not be independent.
        """
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        cleaned = [normalised(text or "") for text in texts]
        real = [place for place, clean in enumerate(cleaned) if clean]
        totals = np.zeros((len(real), len(self.languages)))
        counts = np.zeros(len(real), np.int64)
        for owners, pieces in self._batches([cleaned[place] for place in real]):
            found, n = self.product(pieces)
            np.add.at(totals, owners, found)
            np.add.at(counts, owners, n)
        best = totals.argmax(axis=1)
        lead = totals[np.arange(len(real)), best][:, None]
        odds = np.exp((totals - lead) * (np.minimum(counts, EVIDENCE) / counts)[:, None])
        for place, language, share in zip(real, best, 1 / odds.sum(axis=1), strict=True):
            names[place], scores[place] = self.languages[language], float(share)
        return names, scores

    def _batches(self, cleaned: list[str]) -> Iterator[tuple[list[int], list[str]]]:
        """Pieces of texts and whose they are, so many that their product stays in `CELLS`."""
        most = max(1, CELLS // (self.max_n * max(1, len(self.languages))))
        owners, pieces, size = [], [], 0
        for owner, clean in enumerate(cleaned):
            for piece in _pieces(clean, most):
                if pieces and size + len(piece) > most:
                    yield owners, pieces
                    owners, pieces, size = [], [], 0
                owners.append(owner)
                pieces.append(piece)
                size += len(piece)
        if pieces:
            yield owners, pieces

    def product(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sparse matrix of normalised texts by bins times the log probabilities, and the
        n-grams of each text. The sum of a text is that of its own rows in their order."""
        lengths = np.array([len(text) for text in texts], np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        ends = np.repeat(np.cumsum(lengths), lengths)
        counts = np.zeros(len(texts), np.int64)
        for n, bins in enumerate(ngram_bins("".join(texts), self.max_n, self.bits), start=1):
            inside = np.arange(len(bins)) + n <= ends[: len(bins)]
            own = np.maximum(lengths - n + 1, 0)
            filled = np.flatnonzero(own)
            starts = (np.cumsum(own) - own)[filled]
            if len(filled):
                rows = self.weights[bins[inside]]
                total[filled] += np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
            counts += own
        return total, counts


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_n: int = MAX_N,
    bits: int = HASH_BITS,
) -> NaiveBayes:
    """A model of all labelled rows. The driver gets a row a language, one after another."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    # One more than the bound shows that it is passed, before any counts are made.
    if labelled.select(lang).distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = count_ngrams(labelled, text, lang, max_n, bits)
    columns = []
    with held(counts, "language-counts") as table:
        languages = sorted(row["lang"] for row in table.select("lang").distinct().collect())
        for language in languages:
            # A row a bin at most.
            own = table.where(F.col("lang") == language).select("bin", "n").toArrow()
            column = np.full(1 << bits, SMOOTHING)
            column[own["bin"].to_numpy()] += own["n"].to_numpy()
            columns.append(np.log(column) - np.log(column.sum()))
    weights = np.column_stack(columns) if columns else np.zeros((1 << bits, 0))
    # Only differences between languages matter; this keeps sums of many rows exact.
    weights -= weights.mean(axis=1, keepdims=True) if languages else 0
    return NaiveBayes(languages, weights.astype(np.float32), max_n, bits)


def predict(docs: DataFrame, model: NaiveBayes, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], []
        for start in range(0, len(texts), ROWS):
            some = shared.value.score(texts.iloc[start : start + ROWS].tolist())
            names += some[0]
            scores += some[1]
        return pd.DataFrame({"lang_pred": names, "score": scores})

    added = docs.drop("lang_pred", "score", "_language").withColumn(
        "_language", scored(F.col(text).cast("string"))
    )
    return added.select(
        *[f"`{c}`" for c in added.columns if c != "_language"],
        F.col("_language.lang_pred").alias("lang_pred"),
        F.col("_language.score").alias("score"),
    )


def held_out(doc_id: str = "doc_id"):
    """A fifth of the documents, by a checksum of their id; null ids are never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and predict all of them."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        held_out().alias("held_out"),
    )
    model = train(rows.where("not held_out"))
    return predict(rows.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents whose language is recognised, with the columns that they came with.

    Rejected are texts without letters and those where no language reaches `min_score`.
    The model is trained on the documents given that have a language.
    """
    model = train(docs.where(~held_out()))
    judged = predict(packed(docs, "text"), model).where(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
    )
    return unpacked(judged, docs.columns, "text")

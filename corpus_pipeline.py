"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes what its predecessor kept and returns the columns of `documents`; the
last returns the token ids. `run` writes each stage's rows to the shared folder and reads
them again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lamina.llm import decontamination, language_id, line_dedup, near_dedup, sentencepiece
from lamina.llm.frames import small_batches
from lamina.sources import stored

#: Texts that a Python worker gets at once. Where a stage's rows go through Python, they are
#: made inside a block with this setting, as a plan takes it when it is run.
BATCH = 256


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay."""
    with small_batches(spark, BATCH):
        return stored(language_id.keep_identified(docs), "identified")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of earlier documents go; the documents stay, also those left empty."""
    return line_dedup.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with small_batches(spark, BATCH):
        return stored(decontamination.keep_clean(docs, items), "clean")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, decoded again: `doc_id`, `lang`, `source`, `n_tokens`,
    `ids`, `parity` with the SentencePiece library, `round_trip` whether the text came back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select("doc_id", "lang", "source", "text")
    decoded = sentencepiece.encode_and_decode(rows, model).selectExpr(
        "doc_id",
        "lang",
        "source",
        "cast(size(ids) as bigint) as n_tokens",
        "ids",
        "parity",
        "decoded = coalesce(text, '') as round_trip",
    )
    with small_batches(spark, BATCH):
        return stored(decoded, "pieces")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: A trained model decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs

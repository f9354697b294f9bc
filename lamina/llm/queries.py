"""One query for each operator over the test tables, and the SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    chat_format,
    decontamination,
    fingerprints,
    hard_negatives,
    html_tree,
    language_id,
    line_dedup,
    near_dedup,
    pii,
    repair,
    sentencepiece,
    token_store,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    records = warc.round_trip(spark, _table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded, with parity to the SentencePiece library."""
    docs = _table(spark, folder, "documents")
    return sentencepiece.digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens written as directly addressable codes and read back."""
    docs = _table(spark, folder, "documents")
    tokens = token_store.round_trip(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data in every document."""
    return pii.find(_table(spark, folder, "documents")).drop("redacted")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from four fifths of the labelled ones."""
    return language_id.identify(_table(spark, folder, "documents"))


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprints of every document and its edited text, and how alike they are."""
    return fingerprints.with_edits(_table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that stand in several documents kept in the first one only."""
    return line_dedup.digest(_table(spark, folder, "documents"))


def op8_html_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_tree.extract(_table(spark, folder, "pages"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that contains a benchmark item, and which."""
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return decontamination.contaminated(docs, items)


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_dedup.classes(_table(spark, folder, "documents"))


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted and read back, and one that is full of control strings."""
    columns = ["conv_id", "turn", "role", "text"]
    convs = _table(spark, folder, "conversations").select(*columns)
    hostile = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_format.digest(chat_format.format_conversations(convs.unionByName(hostile)))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation damaged by the hash of its rows and repaired at the least cost."""
    convs = _table(spark, folder, "conversations")
    return repair.digest(convs, repair.damage(convs))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector; each seventh has another label first."""
    vectors = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


LLM_QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_token_store": op3_token_store,
    "op4_pii": op4_pii,
    "op5_language_id": op5_language_id,
    "op6_fingerprints": op6_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_tree": op8_html_tree,
    "op9_decontamination": op9_decontamination,
    "op10_near_dedup": op10_near_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_repair": op12_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

# Five hexadecimal digits are four digits to the base of 32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',"
    f" ((('0x' || substr(sha, {group * 5 + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

LLM_ORACLES: dict[str, str] = {
    "op1_warc": f"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS sha
            FROM pages
        ), f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first_id FROM p)
        SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op7_line_dedup": """
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), k AS (
            SELECT *, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), h AS (SELECT *, min(doc_id) OVER (PARTITION BY key) AS keeper FROM k),
        m AS (SELECT *, length(key) >= 10 AND keeper <> doc_id AS gone FROM h)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    # Items of five words or more; the tables hold no shorter ones.
    "op9_decontamination": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w
            FROM documents
        ), v AS (
            SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w
            FROM benchmark
        ), d AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3),
                   lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle
            FROM w
        ), b AS (
            SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3),
                   lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle
            FROM v
        ), n AS (SELECT item_id, count(*) AS size FROM b GROUP BY item_id),
        m AS (SELECT doc_id, item_id, count(*) AS common FROM b JOIN d USING (shingle) GROUP BY ALL)
        SELECT doc_id, item_id, common / size AS containment
        FROM m JOIN n USING (item_id) WHERE common >= 0.8 * size
    """,
    # Pairs that share a shingle, their generalised Jaccard, and the reach of the links.
    "op10_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w
            FROM documents
        ), s AS (
            SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
                list_transform(range(1, len(w) - 3),
                               lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
            FROM w WHERE len(w) > 0
        ), c AS (SELECT doc_id, shingle, count(*) AS n FROM s GROUP BY ALL),
        t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY doc_id),
        m AS (
            SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS common
            FROM c x JOIN c y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
            GROUP BY ALL
        ), l AS (
            SELECT a, b FROM m JOIN t p ON p.doc_id = a JOIN t q ON q.doc_id = b
            WHERE common >= 0.8 * (p.total + q.total - common)
        ), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (
            SELECT a AS node, a AS seen FROM e
            UNION
            SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a
        ), k AS (SELECT node, min(seen) AS root FROM r GROUP BY node)
        SELECT doc_id, coalesce(root, doc_id) AS class_id
        FROM documents LEFT JOIN k ON node = doc_id
    """,
    # The state before a turn follows from the role of the turn before.
    "op11_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), n AS (
            SELECT *, row_number() OVER w AS place, lag(role) OVER w AS earlier FROM c
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), p AS (
            SELECT *,
                   '<\\*/?s>|\[\\*(?:/?SYS|/?INST|ANS|/?ROLE|END)\]' AS control,
                   place = 1 AND role IN ('system', 'user')
                       OR earlier = 'assistant' AND role = 'user' AS begins,
                   begins OR earlier = 'system' AND role = 'user'
                       OR earlier = 'user' AND role = 'assistant' AS fine
            FROM n
        ), f AS (
            SELECT *,
                   CASE WHEN begins THEN 3 ELSE 0 END
                   + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
                     ELSE 18 + length(role) + len(regexp_extract_all(role, control)) END
                   + length(text) + len(regexp_extract_all(text, control)) AS chars
            FROM p
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place))
                   AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars,
               count(*) FILTER (fine IS NOT TRUE) AS out_of_order
        FROM f GROUP BY conv_id
    """,
    "op13_hard_negatives": """
        WITH e AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END
                   AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), r AS (SELECT *, row_number() OVER () AS place FROM e),
        s AS (
            SELECT a.place AS anchor, a.vec_id AS anchor_id, b.vec_id AS id,
                   a.label = b.label AS same,
                   list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT
                       AS score
            FROM r a JOIN r b ON a.place <> b.place WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS n
            FROM s WHERE same
        ), m AS (
            SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id,
                   p.score AS positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor, p.n ORDER BY s.score DESC, s.id)
                       ::INTEGER AS rank
            FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
            WHERE p.n <= 5 AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        )
        SELECT * FROM m WHERE rank <= 10
    """,
}

"""Archives, SentencePiece and token files: round trips, edge rows and brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lamina.llm import sentencepiece, token_store, warc
from lamina.llm.chunks import ChunkCache, piece_chunks, word_chunks
from lamina.sources import fresh_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

PAGES = "page_id long, url string, html string, sha1 string, path string"


def edge_pages(spark):
    rows = [
        (5, "http://a/1", "<p>same</p>", "x", "x"),
        (3, "http://a/2", "<p>same</p>", "x", "x"),
        (3, "http://a/2", "<p>same</p>", "x", "x"),
        (9, None, None, None, None),
        (10, "http://a/\r\nb c", "", "x", "x"),
        (None, "http://a/3", "<p>same</p>", "x", "x"),
        (11, "u", "é" * 200_000 + "\r\n\r\nWARC/1.1", "x", "x"),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_archives_keep_every_page_and_refer_copies_to_the_smallest_id(spark):
    rows = warc.round_trip(spark, edge_pages(spark), with_payload=True).collect()
    assert len(rows) == 7
    found = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert found == {
        (5, "revisit", 3),
        (3, "response", None),
        (9, "response", None),
        (10, "revisit", 9),
        (None, "revisit", 3),
        (11, "response", None),
    }
    long = next(r for r in rows if r.page_id == 11)
    payload = ("é" * 200_000 + "\r\n\r\nWARC/1.1").encode()
    assert bytes(long.payload) == payload and long.payload_bytes == len(payload)
    assert long.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = next(r for r in rows if r.page_id == 5)
    assert revisit.payload is None and revisit.payload_bytes == 11


def test_small_payloads_below_the_bound_are_all_responses(spark):
    planned = warc.plan_records(edge_pages(spark), min_revisit_bytes=12).collect()
    assert all(r.refers_to is None for r in planned)


def test_an_archive_embeds_its_dictionary_and_gives_single_records(spark):
    pages = spark.range(400).select(
        F.col("id").alias("page_id"),
        F.lit("http://h/").alias("url"),
        F.concat(F.lit("<p>"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 5)).alias("html"),
    )
    index = warc.write_archives(
        warc.plan_records(pages), fresh_path(spark, "w"), file_bytes=60_000, dictionary_bytes=4096
    )
    places = index.collect()
    assert len({p.path for p in places}) > 1
    content = warc.read_file(places[0].path)
    assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_MAGIC
    for place in places[::50]:
        record = warc.read_record(place.path, place.offset, place.length)
        assert record["page_id"] == place.page_id and record["record_type"] == "response"
    with pytest.raises(ValueError):
        list(warc._frames(content[:-3]))
    assert warc.read_archives(spark, index).count() == 400


def test_no_pages_make_no_archive(spark):
    empty = edge_pages(spark).where("false")
    assert warc.round_trip(spark, empty).count() == 0


TEXTS = [
    "", "  ", " a", "a  b", "a\nb\t c", "\n\n  x", "x ", "é€😀\x00", "▁ a▁b", "<s> </s> <unk>",
    "<|endoftext|> it's  they'll go", "a \n b", "a\n  b c", "a  \nb", "one,two; three.four",
    "x" * 30_000, "​ 　 z", "Ünïcödé wörds, 12,5 %", "don't 'twas 're", "end.\n", "\x1c a",
]


def test_pieces_have_parity_with_the_library_and_decode():
    from sentencepiece import SentencePieceProcessor

    original = SentencePieceProcessor(model_file=PIECES)
    codec = sentencepiece.Codec(PIECES, threads=2)
    encoded = codec.encode(TEXTS)
    ids = [np.frombuffer(x, "<u4").tolist() for x, _ in encoded]
    assert ids == original.encode(TEXTS)
    assert all(same for _, same in encoded)
    plain = [(t, d) for t, d in zip(TEXTS, codec.decode(ids), strict=True) if "▁" not in t]
    assert all(t == d for t, d in plain)


def unigram_model() -> bytes:
    """A serialised unigram model with byte fallback and the settings that are usual for it."""

    def field(number: int, value: bytes | int | float) -> bytes:
        if isinstance(value, float):
            return bytes([number << 3 | 5]) + np.float32(value).tobytes()
        if isinstance(value, int):
            return varint(number << 3) + varint(value)
        return varint(number << 3 | 2) + varint(len(value)) + value

    def varint(value: int) -> bytes:
        out = b""
        while value > 127:
            out += bytes([value & 127 | 128])
            value >>= 7
        return out + bytes([value])

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = {"▁the": -2.0, "▁": -3.0, "▁cat": -4.0, "s": -3.5, "t": -4.5, "h": -4.5, "e": -4.4,
             "c": -4.6, "a": -4.2, "he": -3.9, "▁s": -3.8, "at": -3.7}
    pieces += [(w, s, 1) for w, s in words.items()]
    body = b"".join(
        field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in pieces
    )
    trainer = field(3, 1) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2)
    return body + field(2, trainer) + field(3, field(3, 1) + field(4, 1) + field(5, 1))


def test_a_unigram_model_is_rebuilt_too(tmp_path):
    from sentencepiece import SentencePieceProcessor

    path = tmp_path / "unigram.model"
    path.write_bytes(unigram_model())
    codec = sentencepiece.Codec(str(path))
    assert codec.model.kind == sentencepiece.UNIGRAM and not codec.model.cuts_at_spaces
    texts = ["the cats", "  the   cat ", "", "heats", "ché the", "a the"]
    ids = [np.frombuffer(x, "<u4").tolist() for x, _ in codec.encode(texts)]
    assert ids == SentencePieceProcessor(model_file=str(path)).encode(texts)


def documents(spark, rows):
    schema = "doc_id long, text string, ids string, parity string, start string"
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)


EDGE_ROWS = [(4, "b c"), (2, None), (2, "zz"), (9, ""), (None, "n"), (4, "b c"), (1, "long " * 9_000)]


def test_encode_replaces_clashing_columns_and_keeps_rows(spark):
    docs = documents(spark, EDGE_ROWS)
    encoded = sentencepiece.encode(docs, PIECES)
    assert encoded.columns == ["doc_id", "text", "start", "ids", "parity"]
    rows = sentencepiece.decode(encoded, PIECES).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(r.decoded == (r.text or "") and r.parity for r in rows)
    assert sentencepiece.digest(docs.where("false"), PIECES).count() == 0
    digests = sentencepiece.digest(docs, PIECES).where("doc_id = 2 and n_tokens = 0").collect()
    assert [r.ids_crc32 for r in digests] == [0] and digests[0].round_trip


def test_decoding_where_a_row_is_encoded_gives_the_same_rows(spark):
    rows = [*EDGE_ROWS, *enumerate(TEXTS, start=20)]
    docs = documents(spark, rows).withColumn("decoded", F.lit("x")).withColumn("parity", F.lit(1))
    two = sentencepiece.decode(sentencepiece.encode(docs, PIECES), PIECES)
    one = sentencepiece.encode_and_decode(docs, PIECES)
    assert one.schema == two.schema
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert sentencepiece.encode_and_decode(docs.where("false"), PIECES).count() == 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_workers_keep_no_chunks_after_a_task(spark):
    def kept(batches):
        for _ in batches:
            known = sum(len(own.cache.known) for own in sentencepiece._codecs.values())
            yield pa.RecordBatch.from_arrays([pa.array([known], pa.int64())], names=["known"])

    docs = documents(spark, [(i, f"some words {i}") for i in range(64)]).repartition(8)
    assert sentencepiece.encode(docs, PIECES).where("parity").count() == 64
    assert sentencepiece.digest(docs, PIECES).where("parity").count() == 64
    idle = spark.range(64, numPartitions=8).mapInArrow(kept, "known long")
    assert {row.known for row in idle.collect()} == {0}


def test_chunks_give_the_whole_text_back():
    for text in TEXTS:
        assert " ".join(word_chunks(text)) == text
        assert " ".join(piece_chunks(text)) == text


def test_a_full_cache_still_encodes():
    asked = []
    cache = ChunkCache(lambda chunks: asked.append(chunks) or [c.upper() for c in chunks], 2)
    assert cache([["a", "b"], ["a"]]) == [["A", "B"], ["A"]]
    assert cache([["c", "a"], ["c"]]) == [["C", "A"], ["C"]]
    assert asked == [["a", "b"], ["c"]] and len(cache.known) == 2


def test_chunked_byte_tokens_equal_the_whole_text():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BYTE_BPE)
    draw = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "<|endoftext|>", "é", "Ⅻ", "²", "\x1c", "Hello", "'s", ".",
             "!", "23", "word", "日本", "😀", "\r\n", "_", "don't", "\x85", "\u200b"]
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext|>.", "a\nb \nc"]
    texts += ["".join(draw.choices(parts, k=draw.randrange(14))) for _ in range(3_000)]
    for size in (1_000_000, 3):
        encoder = token_store.TextEncoder(BYTE_BPE)
        encoder.after_space.size = encoder.first.size = size
        for text, ids in zip(texts, encoder(texts), strict=True):
            wanted = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == wanted, text
        assert len(encoder.after_space) <= size


def test_a_word_is_encoded_once_whatever_marks_stand_behind_it():
    from tokenizers import Tokenizer

    encoder, asked = token_store.TextEncoder(BYTE_BPE), []
    whole, tokenize = encoder._whole, encoder.tokenizer.model.tokenize
    encoder._whole = lambda text: asked.append(text) or whole(text)
    encoder.tokenize = lambda word: asked.append(word) or tokenize(word)
    text = "so pinanth, pinanth. pinanth### pinanth pinanth;\npinanth, pinanth!?\npinanth'_"
    (ids,) = encoder([text])
    plain = Tokenizer.from_file(BYTE_BPE)
    assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert [word for word in asked if "pinanth" in word] == ["\u0120pinanth", "pinanth"]


@pytest.mark.parametrize("n", [1, 8, 511, 512, 513, 5_000])
def test_every_token_is_found_by_its_place(tmp_path, n):
    rng = np.random.default_rng(n)
    ids = (2 ** rng.uniform(0, 31.9, n)).astype("<u4") - 1
    builder = token_store.FileBuilder()
    builder.add([7, None], [ids[: n // 2].tobytes(), ids[n // 2 :].tobytes()])
    path = tmp_path / "t.dac"
    path.write_bytes(builder.content())
    file = token_store.TokenFile(str(path))
    assert file.doc_ids() == [7, None] and file.ends() == [n // 2, n]
    assert file.all_tokens().tolist() == ids.tolist()
    for i in {0, n - 1, *rng.integers(0, n, 30).tolist()}:
        assert file.token(i) == ids[i]
    with pytest.raises(IndexError):
        file.token(n)


def test_token_files_in_order_of_id(spark):
    from tokenizers import Tokenizer

    docs = documents(spark, EDGE_ROWS).repartition(3)
    folder = fresh_path(spark, "tokens")
    catalog = token_store.write_tokens(docs, folder, BYTE_BPE, file_tokens=2)
    rows = token_store.read_tokens(spark, catalog).orderBy("start").collect()
    plain = Tokenizer.from_file(BYTE_BPE)
    at = 0
    wanted = sorted(EDGE_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for row, (doc_id, text) in zip(rows, wanted, strict=True):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, at, len(ids))
        assert row.ids == ids
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_store.round_trip(spark, docs.where("false"), BYTE_BPE).count() == 0

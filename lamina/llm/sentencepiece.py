"""SentencePiece encoding and decoding with the tokenizers library as its backend.

The model's protobuf is parsed here; normaliser, space marker, scores and byte fallback are
rebuilt as parts of a tokenizers pipeline, for unigram models and for merge models, whose
merges follow from the order of their scores. Encoding takes batches, on one thread a task
unless `threads` says more.
Parity with the SentencePiece library is verified chunk by chunk: each distinct chunk of
text is encoded by both.

A null text is encoded as an empty one, which has no tokens. Every character of a text is
kept: what the vocabulary lacks becomes bytes. Rows stay as they are, also repeated ones.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.chunks import ChunkCache, id_bytes, piece_chunks

# The marker of a space, and the kinds of models and pieces in the format.
MARKER = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

ROWS = 256
#: Chunks that the libraries encode at once.
CHUNKS = 4_096


@dataclass
class Model:
    """What the encoder needs of a SentencePiece model."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True
    suffix_spaces: bool = False

    @property
    def cuts_at_spaces(self) -> bool:
        """No piece has the marker behind another character, and spaces stay as they are."""
        return (
            self.dummy_prefix
            and self.escape_spaces
            and not self.remove_extra_spaces
            and not self.suffix_spaces
            and not self.charsmap
            and all(MARKER not in text.lstrip(MARKER) for text, _, _ in self.pieces)
        )


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 in (1, 5):
            size = 8 if key & 7 == 1 else 4
            yield key >> 3, message[at : at + size]
            at += size
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, message[at : at + size]
            at += size
        else:
            raise ValueError(f"field {key >> 3} has an unknown wire type")


def parse_model(content: bytes) -> Model:
    """Pieces, trainer and normaliser settings of a serialised model."""
    model = Model()
    for number, value in _fields(content):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.unknown = trainer.get(40, 0)
            model.byte_fallback = bool(trainer.get(35, 0))
            model.suffix_spaces = bool(trainer.get(24, 0))
        elif number == 3:
            rules = dict(_fields(value))
            model.charsmap = rules.get(2, b"")
            model.dummy_prefix = bool(rules.get(3, 1))
            model.remove_extra_spaces = bool(rules.get(4, 1))
            model.escape_spaces = bool(rules.get(5, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model.kind} is neither unigram nor merges")
    if model.suffix_spaces or not model.escape_spaces:
        raise ValueError("space markers behind words, or none, are not supported")
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces in the order in which they merge: by the score of what they make."""
    normal = {t: s for t, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    order = {text: i for i, (text, _, _) in enumerate(model.pieces)}
    found = []
    for text, score in normal.items():
        for cut in range(1, len(text)):
            left, right = text[:cut], text[cut:]
            if left in normal and right in normal:
                found.append((-score, order[text], order[left], order[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model):
    """A tokenizers pipeline that encodes and decodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram(
            [(text, score) for text, score, _ in model.pieces],
            unk_id=model.unknown,
            byte_fallback=model.byte_fallback,
        )
    else:
        core = models.BPE(
            {text: i for i, (text, _, _) in enumerate(model.pieces)},
            merges_of(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" +"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    chain = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        chain.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(chain)
    return tokenizer


class Codec:
    """Encodes and decodes batches of texts with one model.

    Texts are cut at lone spaces where the model allows it, so that each distinct chunk
    is encoded once a task; `encode` then gives, for each text, its ids and whether
    both libraries agree on every chunk of it.
    """

    def __init__(self, path: str, threads: int = 1, verify: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        with open(path, "rb") as source:
            content = source.read()
        self.model = parse_model(content)
        self.tokenizer = build_tokenizer(self.model)
        self.verify, self.threads = verify, threads
        if verify:
            from sentencepiece import SentencePieceProcessor

            self.original = SentencePieceProcessor(model_proto=content)
        self.cut = piece_chunks if self.model.cuts_at_spaces else lambda text: [text]
        self.odd: set[str] = set()  # chunks on which the libraries differ
        self.cache = ChunkCache(self._encode)

    def _encode(self, chunks: list[str]) -> Iterator[bytes]:
        for start in range(0, len(chunks), CHUNKS):
            some = chunks[start : start + CHUNKS]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            ids = [encoding.ids for encoding in found]
            if self.verify:
                wanted = self.original.encode(some, num_threads=self.threads)
                self.odd.update(c for c, a, b in zip(some, ids, wanted, strict=True) if a != b)
            yield from map(id_bytes, ids)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Ids as little-endian unsigned 32-bit integers, and parity."""
        cut = [self.cut(text) for text in texts]
        encoded = [b"".join(each) for each in self.cache(cut)]
        return [(x, self.odd.isdisjoint(c)) for x, c in zip(encoded, cut, strict=True)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=True)


_codecs: dict[tuple, Codec] = {}


def codec(path: str, threads: int = 1, verify: bool = True) -> Codec:
    """The worker's codec of a model, kept between tasks."""
    key = (path, threads, verify)
    if key not in _codecs:
        _codecs[key] = Codec(path, threads, verify)
    return _codecs[key]


@contextmanager
def encoder(path: str, threads: int, verify: bool) -> Iterator[Codec]:
    """The worker's codec for one task. Its chunks go with the task, and so does what Arrow
    holds in reserve: an idle worker would keep them while other stages need the memory."""
    own = codec(path, threads, verify)
    try:
        yield own
    finally:
        own.cache.clear()
        pa.default_memory_pool().release_unused()


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _encoded(
    docs: DataFrame, model_path: str, text: str, threads: int, verify: bool, back: bool
) -> DataFrame:
    """`docs` with `ids` and `parity`, and if `back` with `decoded`, the text of the ids."""
    added = ["ids", "parity", "decoded"] if back else ["ids", "parity"]
    kept = docs.drop(*added)
    plain = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    framed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), plain)
    row_type = framed.schema["row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(model_path, threads, verify) as own:
            for batch in _sliced(batches):
                done = own.encode(batch.column(1).to_pylist())
                flat = pa.Array.from_buffers(
                    pa.int32(),
                    sum(len(ids) for ids, _ in done) // 4,
                    [None, pa.py_buffer(b"".join([ids for ids, _ in done]))],
                )
                ends = [0]
                for ids, _ in done:
                    ends.append(ends[-1] + len(ids) // 4)
                columns = [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    pa.array([same for _, same in done], pa.bool_()),
                ]
                if back:
                    texts = own.decode([list(memoryview(ids).cast("I")) for ids, _ in done])
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["row", *added])

    schema = f"row {row_type}, ids array<int>, parity boolean" + ", decoded string" * back
    return framed.mapInArrow(run, schema).select("row.*", *added)


def encode(
    docs: DataFrame, model_path: str, text: str = "text", threads: int = 1, verify: bool = True
) -> DataFrame:
    """`docs` with the ids of each text, `ids array<int>`, and `parity boolean`.

    The columns replace ones of the same names. `model_path` is a file on every machine.
    """
    return _encoded(docs, model_path, text, threads, verify, back=False)


def encode_and_decode(
    docs: DataFrame, model_path: str, text: str = "text", threads: int = 1, verify: bool = True
) -> DataFrame:
    """The rows of `decode(encode(docs))`: each text is encoded, and its ids are decoded.

    Both are done where the row is. As two operators in one task they are two workers at
    once, each with a model of its own, and the rows go to Python twice.
    """
    return _encoded(docs, model_path, text, threads, verify, back=True)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", threads: int = 1) -> DataFrame:
    """`encoded` with the text of its ids as `decoded`; null ids have a null text."""
    kept = encoded.drop("decoded")
    framed = kept.select(
        F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(ids).alias("_ids")
    )
    row_type = framed.schema["row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, threads, False)
        for batch in _sliced(batches):
            given = batch.column(1).to_pylist()
            texts = own.decode([x or [] for x in given])
            texts = [None if x is None else t for x, t in zip(given, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["row", "decoded"]
            )

    return framed.mapInArrow(run, f"row {row_type}, decoded string").select("row.*", "decoded")


def digest(docs: DataFrame, model_path: str, threads: int = 1) -> DataFrame:
    """Each document's tokens as counts and checksums, after encoding and decoding it.

    `doc_id`, `n_tokens`, `ids_crc32` of the ids as little-endian unsigned 32-bit integers,
    `decoded_sha256` of the decoded text, `round_trip` whether that is the text, `parity`
    whether the SentencePiece library gives the same ids.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(model_path, threads, True) as own:
            for batch in _sliced(batches):
                texts = batch.column(1).to_pylist()
                done = own.encode(texts)
                decoded = own.decode([list(memoryview(ids).cast("I")) for ids, _ in done])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(ids) // 4 for ids, _ in done], pa.int64()),
                        pa.array([zlib.crc32(ids) for ids, _ in done], pa.int64()),
                        pa.array(decoded, pa.string()),
                        pa.array([a == b for a, b in zip(texts, decoded, strict=True)], pa.bool_()),
                        pa.array([same for _, same in done], pa.bool_()),
                    ],
                    names=["doc_id", "n_tokens", "ids_crc32", "decoded", "round_trip", "parity"],
                )

    schema = (
        "doc_id long, n_tokens long, ids_crc32 long, decoded string,"
        " round_trip boolean, parity boolean"
    )
    return rows.mapInArrow(run, schema).select(
        "doc_id",
        "n_tokens",
        "ids_crc32",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "round_trip",
        "parity",
    )

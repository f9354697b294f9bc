"""Token ids in files of directly addressable codes.

An id is split into chunks of eight bits, the lowest on level 0. A level holds the chunks
of all ids that reach it and a bitmap that says which go on to the next level; a rank
directory counts the set bits before each block of the bitmap. The place of an id on the
next level is the number of set bits before it, so any token is found by a few small reads,
without decoding what stands before it.

    header     magic, documents n, tokens t, levels v                 (4 x uint64)
    documents  ids and validity, ends in tokens                       (int64, uint8, uint64 x n)
    levels     entries; chunks (uint8), bitmap, rank directory        (v times)

Documents need `doc_id` and `text`, others are ignored. A null text is empty and has only
the end id. Null ids come first and stay null; equal ids are ordered by text, and every
repeated row is stored. An empty table makes no file.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.chunks import id_bytes, word_chunks
from lamina.llm.files import new_name, read_file, read_range, write_file
from lamina.sources import fresh_path, stored

# Fixed values of the format.
MAGIC = 0x3130434144_4B54
BITS = 8
BLOCK_BYTES = 64

END_ID = 0
FILE_TOKENS = 8_000_000
ROWS = 256
#: Encoded chunks that a worker keeps, about 150 bytes each.
KNOWN_CHUNKS = 1_000_000


@dataclass(frozen=True)
class Level:
    """Where a level's parts begin, in bytes from the start of the file."""

    entries: int
    chunks: int
    bitmap: int
    ranks: int


def _padded(content: bytes) -> bytes:
    return content + bytes(-len(content) % 8)


def _level(chunks: np.ndarray, goes_on: np.ndarray) -> list[bytes]:
    """A level's entries, chunks, bitmap and rank directory."""
    bitmap = np.packbits(goes_on, bitorder="little")
    whole = np.zeros(-(-len(bitmap) // BLOCK_BYTES) * BLOCK_BYTES, np.uint8)
    whole[: len(bitmap)] = bitmap
    per_block = np.bitwise_count(whole).reshape(-1, BLOCK_BYTES).sum(axis=1, dtype=np.uint64)
    ranks = np.cumsum(per_block) - per_block
    entries = np.array([len(chunks)], "<u8")
    return [
        entries.tobytes(),
        _padded(chunks.tobytes()),
        whole.tobytes(),
        ranks.astype("<u8").tobytes(),
    ]


class FileBuilder:
    """Collects documents for one file; a token takes a few bytes until it is closed."""

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        self.tokens = 0
        self.levels: list[list[tuple[np.ndarray, np.ndarray]]] = []

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        """Some documents, with their ids as little-endian unsigned 32-bit integers."""
        self.doc_ids += doc_ids
        for own in ids:
            self.tokens += len(own) // 4
            self.ends.append(self.tokens)
        rest, number = np.frombuffer(b"".join(ids), "<u4"), 0
        while number == 0 or len(rest):
            if number == len(self.levels):
                self.levels.append([])
            above = rest >> np.uint32(BITS)
            goes_on = above != 0
            self.levels[number].append((rest.astype(np.uint8), goes_on))
            rest, number = above[goes_on], number + 1

    def content(self) -> bytes:
        header = np.array([MAGIC, len(self.doc_ids), self.tokens, len(self.levels)], "<u8")
        numbers = np.array([0 if x is None else x for x in self.doc_ids], "<i8").tobytes()
        valid = _padded(np.array([x is not None for x in self.doc_ids], np.uint8).tobytes())
        parts = [header.tobytes(), numbers, valid, np.array(self.ends, "<u8").tobytes()]
        for pieces in self.levels:
            parts += _level(
                np.concatenate([chunks for chunks, _ in pieces]),
                np.concatenate([goes_on for _, goes_on in pieces]),
            )
        return b"".join(parts)


class TokenFile:
    """A stored file; `token(i)` fetches only the bytes that hold that token."""

    def __init__(self, path: str, content: bytes | None = None):
        self.path, self.content = path, content
        magic, self.documents, self.tokens, levels = self._numbers(0, 4)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        at = 32 + 8 * self.documents
        self.valid_at = at
        self.ends_at = at = at + -(-self.documents // 8) * 8
        at += 8 * self.documents
        self.levels = []
        for _ in range(levels):
            entries = int(self._numbers(at, 1)[0])
            bitmap = at + 8 + -(-entries // 8) * 8
            blocks = -(-(-(-entries // 8)) // BLOCK_BYTES)
            ranks = bitmap + blocks * BLOCK_BYTES
            self.levels.append(Level(entries, at + 8, bitmap, ranks))
            at = ranks + 8 * blocks

    def _bytes(self, at: int, length: int) -> bytes:
        if self.content is None:
            return read_range(self.path, at, length)
        return self.content[at : at + length]

    def _numbers(self, at: int, count: int) -> list[int]:
        return np.frombuffer(self._bytes(at, 8 * count), "<u8").tolist()

    def doc_ids(self) -> list[int | None]:
        numbers = np.frombuffer(self._bytes(32, 8 * self.documents), "<i8").tolist()
        valid = self._bytes(self.valid_at, self.documents)
        return [n if v else None for n, v in zip(numbers, valid, strict=True)]

    def ends(self) -> list[int]:
        return self._numbers(self.ends_at, self.documents)

    def token(self, i: int) -> int:
        """The id at position `i` of the file."""
        if not 0 <= i < self.tokens:
            raise IndexError(f"token {i} of {self.tokens}")
        value = 0
        for number, level in enumerate(self.levels):
            value |= self._bytes(level.chunks + i, 1)[0] << (BITS * number)
            block, bit = divmod(i, BLOCK_BYTES * 8)
            word = int.from_bytes(
                self._bytes(level.bitmap + block * BLOCK_BYTES, BLOCK_BYTES), "little"
            )
            if not word >> bit & 1:
                break
            before = (word & ((1 << bit) - 1)).bit_count()
            i = self._numbers(level.ranks + 8 * block, 1)[0] + before
        return value

    def all_tokens(self) -> np.ndarray:
        """Every id of the file, level by level."""
        values, places = np.zeros(self.tokens, np.uint32), slice(None)
        for number, level in enumerate(self.levels):
            chunks = np.frombuffer(self._bytes(level.chunks, level.entries), np.uint8)
            values[places] |= chunks.astype(np.uint32) << np.uint32(BITS * number)
            bitmap = np.frombuffer(self._bytes(level.bitmap, -(-level.entries // 8)), np.uint8)
            goes_on = np.unpackbits(bitmap, count=level.entries, bitorder="little").astype(bool)
            places = np.flatnonzero(goes_on) if number == 0 else places[goes_on]
        return values


class KnownChunks(dict):
    """Encoded chunks, `size` of them at most; one that is not known is encoded on the way.

    The size only bounds memory: a chunk that found no room is encoded again when it comes
    again. The frequent chunks come first and so stay.
    """

    def __init__(self, encode: Callable[[str], bytes], size: int = KNOWN_CHUNKS):
        super().__init__()
        self.encode, self.size = encode, size

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        if len(self) < self.size:
            self[chunk] = ids
        return ids


class TextEncoder:
    """A byte-level vocabulary of the tokenizers library, each distinct chunk encoded once.

    A chunk of letters only, with or without the space before it, is one word of the
    vocabulary's own splitting, so the library's model takes it directly. ASCII marks behind
    a word and lone line breaks between words are encoded apart; the word is known from then
    on, whatever stands behind it. All other chunks go through the whole library, with its
    defaults: the string of an added token is that token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.after_space = KnownChunks(self._after_space)
        self.first = KnownChunks(self._first)
        self.marks = KnownChunks(self._whole)

    def _after_space(self, chunk: str) -> bytes:
        if chunk.isalpha():
            if chunk.isascii():
                return self._word(self.letters[0x20] + chunk)
            return self._word((" " + chunk).encode().decode("latin-1").translate(self.letters))
        return self._parts(self.after_space, " ", chunk)

    def _first(self, chunk: str) -> bytes:
        if chunk.isalpha():
            if chunk.isascii():
                return self._word(chunk)
            return self._word(chunk.encode().decode("latin-1").translate(self.letters))
        return self._parts(self.first, "", chunk)

    def _parts(self, known: KnownChunks, before: str, chunk: str) -> bytes:
        word = chunk.rstrip(punctuation)
        if word.isalpha():
            return known[word] + self.marks[chunk[len(word) :]]
        if "\n" in chunk:
            lines = chunk.split("\n")
            if all(lines) and not any(line[0].isspace() or line[-1].isspace() for line in lines):
                begun = known[lines[0]]
                return self.marks["\n"].join([begun, *map(self.first.__getitem__, lines[1:])])
        return self._whole(before + chunk)

    def _word(self, spelled: str) -> bytes:
        return array("I", [token.id for token in self.tokenize(spelled)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        found, known = [], self.after_space.__getitem__
        for text in texts:
            begun, *chunks = word_chunks(text)
            found.append(self.first[begun] + b"".join(map(known, chunks)))
        return found


def byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary spells each byte: itself if it can be printed, or else
    one of the letters from U+0100 on, in order."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}


_encoders: dict[str, TextEncoder] = {}


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode documents in ascending order of id into files below `folder`; their catalog.

    The rows are dealt out by ranges of id, so the partitions in their order, and the
    files of each in theirs, are the order of the tokens. The catalog has a row a file:
    its path, place in the order, documents, tokens, and `start`, the tokens before it.
    A file left by a lost attempt has another name and is in no catalog.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if tokenizer_path not in _encoders:
            _encoders[tokenizer_path] = TextEncoder(tokenizer_path)
        encode, end = _encoders[tokenizer_path], np.uint32(end_id).tobytes()
        file, order = FileBuilder(), 0

        def close() -> pa.RecordBatch:
            name = new_name(f"tokens-{part:06d}-{order:06d}", ".dac")
            row = {
                "path": write_file(folder, name, file.content()),
                "part": part,
                "order": order,
                "documents": len(file.doc_ids),
                "tokens": file.tokens,
            }
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                encoded = encode(piece.column(1).to_pylist())
                file.add(piece.column(0).to_pylist(), [ids + end for ids in encoded])
                if file.tokens >= file_tokens:
                    yield close()
                    file, order = FileBuilder(), order + 1
        if file.doc_ids:
            yield close()

    written = ordered.mapInArrow(
        write, "path string, part long, order long, documents long, tokens long"
    )
    files = stored(written, "token-files")
    before = Window.orderBy("part", "order").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, catalog: DataFrame, with_ids: bool = True) -> DataFrame:
    """The documents of the files: `doc_id`, `start`, `n_tokens`, `ids_crc32` and `ids`.

    `start` counts the tokens of all documents before. Each file is read by one task; the
    catalog has one small row a file.
    """
    files = stored(catalog.select("path", "start"), "token-catalog")
    tasks = max(1, files.count())
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.list_(pa.int32())),
        ]
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                file = TokenFile(path, read_file(path))
                ids, names, ends = file.all_tokens().astype("<u4"), file.doc_ids(), file.ends()
                begins = [0, *ends[:-1]]
                for at in range(0, len(names), ROWS):
                    rows = []
                    for name, a, b in zip(
                        names[at : at + ROWS], begins[at:], ends[at:], strict=False
                    ):
                        own = ids[a:b]
                        rows.append(
                            {
                                "doc_id": name,
                                "start": base + a,
                                "n_tokens": b - a,
                                "ids_crc32": zlib.crc32(own.tobytes()),
                                "ids": own if with_ids else None,
                            }
                        )
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"
    return files.repartition(tasks).mapInArrow(read, schema)


def round_trip(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, with_ids: bool = False
) -> DataFrame:
    """Documents written as token files in the shared folder and read back from them."""
    catalog = write_tokens(docs, fresh_path(spark, "tokens"), tokenizer_path)
    return read_tokens(spark, catalog, with_ids)

"""WARC archives of single-record Zstandard frames with a dictionary of their own.

A file begins with a skippable frame that holds the dictionary, trained on the first
records of the file; each record after it is one frame, so any record can be read alone
with the dictionary and its offset. Of records with the same payload one is a response
and the others are revisits without a payload that refer to it.

Pages need the columns `page_id`, `url` and `html`; others are ignored. A null html or url
is empty, a null page_id is written as `null` and is never the smallest of its group unless
all are null. Rows with the same page_id and payload are all written, and all are
responses if theirs is the smallest id. An empty table makes no file and no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.files import new_name, read_file, read_range, write_file
from lamina.sources import fresh_path, stored

# The frame that holds a dictionary, and the profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 * 1024
TRAINING_BYTES = 2 * 1024 * 1024
FILE_BYTES = 64 * 1024 * 1024
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PIECE = 16 * 1024

INDEX_SCHEMA = "path string, offset long, length long, page_id long"
RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long, payload binary"
)


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Which page is a response and which a revisit of which.

    Only digests and ids are grouped, and the groups combine before the shuffle. Groups
    of one page are left out of the stored table, so it is small where copies are few;
    beyond the broadcast threshold the adaptive join splits the rows of a hot payload.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    digested = rows.withColumn("sha1", F.unhex(F.sha1("html")))
    groups = (
        digested.where(F.octet_length("html") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("sha1", "first_id")
    )
    repeated = stored(groups, "warc-payloads")
    revisits = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return digested.join(repeated, "sha1", "left").select(
        "page_id", "url", "html", "sha1", F.when(revisits, F.col("first_id")).alias("refers_to")
    )


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _record(page_id: int | None, url: str, html: str, sha1: bytes, refers_to: int | None) -> bytes:
    payload = html.encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http + payload if refers_to is None else http
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the records, or None where they are too few to learn from."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def _archive(records: list[tuple[int | None, bytes]], dictionary_bytes: int, training_bytes: int):
    """One file's content and each record's place in it."""
    sample, room = [], training_bytes
    for _, record in records:
        if room <= 0:
            break
        sample.append(record)
        room -= len(record)
    dictionary = train_dictionary(sample, dictionary_bytes)
    chunks, at = [], 0
    if dictionary is not None:
        raw = dictionary.as_bytes()
        chunks.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        at = len(chunks[0])
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    places = []
    for page_id, record in records:
        frame = compressor.compress(record)
        chunks.append(frame)
        places.append((at, len(frame), page_id))
        at += len(frame)
    return b"".join(chunks), places


def write_archives(
    records: DataFrame,
    folder: str,
    file_bytes: int = FILE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
    training_bytes: int = TRAINING_BYTES,
) -> DataFrame:
    """Write planned records below `folder`; the index of the written records.

    Each task writes files of about `file_bytes` before compression. The first
    `training_bytes` of a file's records train its dictionary, so a task holds one file
    in memory. The index comes from the tasks that succeeded: a file left by a lost
    attempt has another name and is in no index.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(held):
            content, places = _archive(held, dictionary_bytes, training_bytes)
            path = write_file(folder, new_name("pages", ".warc.zst"), content)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * len(places), pa.string()),
                    pa.array([x[0] for x in places], pa.int64()),
                    pa.array([x[1] for x in places], pa.int64()),
                    pa.array([x[2] for x in places], pa.int64()),
                ],
                names=["path", "offset", "length", "page_id"],
            )

        held, size = [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                row = [column[i].as_py() for column in columns]
                record = _record(*row)
                held.append((row[0], record))
                size += len(record)
                if size >= file_bytes:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    index = records.select("page_id", "url", "html", "sha1", "refers_to").mapInArrow(
        write, INDEX_SCHEMA
    )
    return stored(index, "warc-index")


def _frames(content: bytes) -> Iterator[bytes]:
    """The records of an archive in order, from its bytes alone."""
    view, at, dictionary = memoryview(content), 0, None
    if len(content) >= 8:
        magic, length = struct.unpack_from("<II", content)
        if magic == DICTIONARY_MAGIC:
            dictionary = zstandard.ZstdCompressionDict(content[8 : 8 + length])
            at = 8 + length
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(content):
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            if at >= len(content):
                raise ValueError("an archive ends inside a record")
            piece = view[at : at + PIECE]
            out.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(out)


def parse_record(record: bytes) -> dict:
    """Headers and payload of a record; a response must match its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")

    def number(urn: str | None) -> int | None:
        text = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "null"
        return None if text == "null" else int(text)

    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


def read_record(path: str, offset: int, length: int) -> dict:
    """One record by its place in the index, without reading the rest of the file."""
    magic, size = struct.unpack("<II", read_range(path, 0, 8))
    dictionary = None
    if magic == DICTIONARY_MAGIC:
        dictionary = zstandard.ZstdCompressionDict(read_range(path, 8, size))
    frame = read_range(path, offset, length)
    return parse_record(zstandard.ZstdDecompressor(dict_data=dictionary).decompress(frame))


def read_archives(
    spark: SparkSession, index: DataFrame, with_payload: bool = True, batch_bytes: int = 8 << 20
) -> DataFrame:
    """All records of the indexed archives, each file read from start to end by one task."""
    paths = index.select("path").distinct()
    files = stored(paths, "warc-files")
    tasks = max(1, files.count())
    names = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for record in _frames(read_file(path)):
                    row = parse_record(record)
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 256
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, names)

    return files.repartition(tasks).mapInArrow(read, RECORD_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Pages written to archives in the shared folder and read back from them."""
    folder = fresh_path(spark, "warc")
    index = write_archives(plan_records(pages), folder)
    return read_archives(spark, index, with_payload)

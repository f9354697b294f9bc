"""Binary files in the shared folder, read and written inside tasks by their URI."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it: local, HDFS, S3 or GCS."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def new_name(prefix: str, suffix: str) -> str:
    """A name that no other attempt of the same task uses."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def write_file(folder: str, name: str, content: bytes) -> str:
    """Write one whole file and return its URI."""
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(content)
    return f"{folder}/{name}"


def read_file(uri: str) -> bytes:
    files, path = open_folder(uri)
    with files.open_input_file(path) as source:
        return source.read()


def read_range(uri: str, start: int, length: int) -> bytes:
    """Some bytes of a file; only these are fetched."""
    files, path = open_folder(uri)
    with files.open_input_file(path) as source:
        return source.read_at(length, start)

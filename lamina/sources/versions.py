"""Tables that are replaced as a whole while others read them.

A table is a folder of versions. Each is written once, under a name that begins with its
number, and never changes. A marker, an empty file of the same name, is made when the
version is whole, and readers take the version of the highest marker. Making a file is one
step on every kind of store, also where renaming a folder copies it, so a reader sees the
old version or the new one and nothing between. A job that is stopped before its marker
leaves the old version in place.

Older versions stay for readers that have begun with them. `remove_old_versions` deletes
those that were given up longer ago than such a reader may take.

    table/_versions/0000000007-<id>/part-...    the rows of version 7
    table/_current/0000000007-<id>              its marker
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

VERSIONS, CURRENT = "_versions", "_current"
#: How long a version stays after another has taken its place.
RETAIN_SECONDS = 24 * 3600
_DIGITS = 10


@dataclass(frozen=True)
class Version:
    """A whole version of a table, and when it was finished, in seconds since 1970."""

    number: int
    path: str
    finished: float


def files_of(spark: SparkSession, path: str) -> tuple:
    """The store of a path, and the path, as Spark's own readers see them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _listed(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder and when they were last changed; none if there is no such folder."""
    files, folder = files_of(spark, path)
    if not files.exists(folder):
        return []
    return [
        (status.getPath().getName(), status.getModificationTime() / 1000)
        for status in files.listStatus(folder)
    ]


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The whole versions of a table, oldest first; none for a folder of plain files."""
    place = path.rstrip("/")
    found = [
        Version(int(name[:_DIGITS]), f"{place}/{VERSIONS}/{name}", finished)
        for name, finished in _listed(spark, f"{place}/{CURRENT}")
        if name[:_DIGITS].isdigit()
    ]
    return sorted(found, key=lambda version: version.path)


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: its last version, or the path itself if it has none."""
    found = versions(spark, path)
    return found[-1].path if found else path


def new_version(spark: SparkSession, path: str) -> str:
    """The path of a version to be written, after all whole ones."""
    found = versions(spark, path)
    number = found[-1].number + 1 if found else 1
    return f"{path.rstrip('/')}/{VERSIONS}/{number:0{_DIGITS}}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, version: str) -> None:
    """Make a whole version the table's current one."""
    place, name = version.rsplit(f"/{VERSIONS}/", 1)
    files, marker = files_of(spark, f"{place}/{CURRENT}/{name}")
    files.mkdirs(marker.getParent())
    files.create(marker, False).close()


def discard(spark: SparkSession, version: str) -> None:
    """Delete what was written of a version."""
    files, folder = files_of(spark, version)
    files.delete(folder, True)


def remove_old_versions(
    spark: SparkSession, path: str, retain_seconds: float = RETAIN_SECONDS
) -> int:
    """Delete versions that were replaced longer ago than that; returns how many.

    The marker goes first, so a version without rows is never listed. Unfinished versions
    below the current number, left by jobs that were stopped, go by the same rule.
    """
    found = versions(spark, path)
    if not found:
        return 0
    limit = time.time() - retain_seconds
    files, _ = files_of(spark, path)
    removed = 0
    for version, follower in zip(found, found[1:], strict=False):
        if follower.finished <= limit:
            _, marker = files_of(spark, version.path.replace(f"/{VERSIONS}/", f"/{CURRENT}/"))
            files.delete(marker, False)
            discard(spark, version.path)
            removed += 1
    place = path.rstrip("/")
    whole = {version.path for version in found}
    for name, changed in _listed(spark, f"{place}/{VERSIONS}"):
        left = f"{place}/{VERSIONS}/{name}"
        if left not in whole and changed <= limit and int(name[:_DIGITS]) <= found[-1].number:
            discard(spark, left)
            removed += 1
    return removed

"""Columns that differ from file to file, from the files' heads alone.

A Parquet footer names the columns and types of its file, a CSV header its columns. Spark
reads a footer or the first line for each file; no row is read. The files are compared with
the declared columns, so a source system that renames, drops, adds or retypes a column is
found before its batch is loaded.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lamina.plans.report import report_frame
from lamina.sources.versions import files_of

#: Heads that are read at the same time.
READERS = 16
_REPORT = "file string, column_name string, finding string, declared_type string, found_type string"


def data_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """The files below a folder, in the order of their paths; Spark's own marks are left out."""
    files, folder = files_of(spark, path)
    found, listing = [], files.listFiles(folder, True)
    while listing.hasNext():
        name = listing.next().getPath()
        if name.getName().endswith(suffix) and not name.getName().startswith(("_", ".")):
            found.append(name.toString())
    return sorted(found)


def file_columns(spark: SparkSession, file: str, file_format: str) -> dict[str, str | None]:
    """The columns of one file and their types; a CSV header has no types."""
    if file_format == "parquet":
        schema = spark.read.parquet(file).schema
        return {field.name: field.dataType.simpleString() for field in schema}
    return dict.fromkeys(spark.read.option("header", True).csv(file).columns)


def schema_drift(
    spark: SparkSession, path: str, declared: str, file_format: str = "parquet"
) -> DataFrame:
    """A row for each column of a `file`, named from `path` on, that is `missing`, `extra` or `retyped`, or out of place.

    `declared` is a schema. A CSV header whose columns are all there in another order has
    its first wrong column as `moved`; types are those of Parquet only.
    """
    wanted = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(declared)}
    files = data_files(spark, path, f".{file_format}")
    store, folder = files_of(spark, path)
    base = store.makeQualified(folder).toString()
    with ThreadPoolExecutor(READERS) as pool:
        heads = list(pool.map(lambda file: file_columns(spark, file, file_format), files))
    rows = []
    for file, found in zip(files, heads, strict=True):
        name = file[len(base) :].lstrip("/")
        rows += [(name, c, "missing", wanted[c], None) for c in wanted if c not in found]
        rows += [(name, c, "extra", None, found[c]) for c in found if c not in wanted]
        both = [c for c in found if c in wanted]
        rows += [
            (name, c, "retyped", wanted[c], found[c])
            for c in both
            if found[c] is not None and found[c] != wanted[c]
        ]
        if file_format == "csv" and set(found) == set(wanted) and list(found) != list(wanted):
            first = next(c for c, d in zip(found, wanted, strict=True) if c != d)
            rows.append((name, first, "moved", wanted[first], None))
    return report_frame(spark, rows, _REPORT)

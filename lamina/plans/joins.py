"""Broadcast by hint, behind a check of the size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
FIELD_BYTES = 16
ROW_BYTES = 16

FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)
VARIABLE_WIDTH = (StringType, BinaryType)


def broadcast_within(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """`df` with the broadcast hint if it measures at most `limit` bytes.

    Beyond the limit the frame comes back without a hint, and Spark joins it by
    sort and merge, splitting skewed partitions at run time; the result is the same.
    Select the needed columns first: only those are measured.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def measured_bytes(df: DataFrame) -> int:
    """The size of the rows from one aggregate; nested values count as their JSON text."""

    def size(name: str, kind) -> Column:
        value = F.col(f"`{name}`")
        if not isinstance(kind, VARIABLE_WIDTH):
            value = F.to_json(F.struct(value))
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint")

    lengths = [
        size(field.name, field.dataType)
        for field in df.schema
        if not isinstance(field.dataType, FIXED_WIDTH)
    ]
    per_row = sum(lengths, F.lit(ROW_BYTES + FIELD_BYTES * len(df.columns)).cast("bigint"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]

"""Row predicates of the cleaning step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a number.

    Type inference leaves a column with one bad value as text, and comparing text
    with a number fails in ANSI mode. Such values become null instead, and null
    fails every check. Numeric columns pass untouched, so their filters still
    reach the scan.
    """
    column = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return column.try_cast("decimal(38,10)")
    return column


def present(*names: str) -> Column:
    return _all_of([F.col(name).isNotNull() for name in names])


def positive(df: DataFrame, *names: str) -> Column:
    return _all_of([as_number(df, name) > 0 for name in names])


def _all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions, F.lit(True))

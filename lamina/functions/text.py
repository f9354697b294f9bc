"""String standardisation. `trim` strips spaces only, so tabs stay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def lowered(name: str) -> Column:
    return F.lower(trimmed(name))


def titled(name: str) -> Column:
    """First letter of each space-separated word upper case, the rest lower case."""
    return F.initcap(trimmed(name))

"""Salts that split a hot key into several smaller ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_salt(salt_on: Column, salts: int) -> Column:
    """A salt that depends on the row alone.

    It comes from the hash of `salt_on`, of any type, so values with a pattern are spread
    as well. A task that runs again gives each row the same salt, so a lost executor
    cannot move rows between groups. Rows with a null `salt_on` share one salt.
    """
    return F.pmod(F.xxhash64(salt_on), F.lit(salts)).cast("int")


def random_salt(salts: int, seed: int | None = None) -> Column:
    """A salt drawn per row; use `steady_salt` where the result must repeat."""
    return F.floor(F.rand(seed) * salts).cast("int")


def salted_key(key: Column, hot_value: str, salt: Column) -> Column:
    """`hot_0`, `hot_1`, ... for the hot value; other values, nulls too, as they are."""
    return F.when(key == hot_value, F.concat(key, F.lit("_"), salt)).otherwise(key)

"""Money is computed in decimals: sums do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.model import AMOUNT, PRICE


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price, rounded half up to whole cents.

    A price or total that is no finite amount of money is null, so a single bad
    row is dropped by the checks and does not stop the job.
    """
    return F.round(quantity * unit_price.try_cast(PRICE), 2).try_cast(AMOUNT)

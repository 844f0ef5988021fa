"""Exact amounts and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"


def divide(left: Column, right: Column, strict: bool = False) -> Column:
    """Decimal quotient. A zero divisor gives NULL, or an error when ``strict``."""
    return left / right if strict else F.try_divide(left, right)


def parse_number(value: Column, kind: str = "double") -> Column:
    """Number in a text cell; anything that is not one becomes NULL."""
    return F.trim(value.cast("string")).try_cast(kind)

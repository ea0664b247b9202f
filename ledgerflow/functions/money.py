"""Exact-money helpers: decimals from the edge, never doubles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.config import MONEY_TYPE, RATE_TYPE


def money(c: Column | str) -> Column:
    """Cast to the money type. Under ANSI mode an overflow raises."""
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY_TYPE)


def zero() -> Column:
    return F.lit(Decimal("0.00")).cast(MONEY_TYPE)


def rate_lit(rate: str) -> Column:
    """A rate literal built from text, so no binary float rounding enters."""
    return F.lit(Decimal(rate)).cast(RATE_TYPE)


def decimal_lit(value: str) -> Column:
    return F.lit(Decimal(value))

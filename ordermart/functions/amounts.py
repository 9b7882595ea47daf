"""Order amount expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import PRICE_TYPE, SUM_TYPE, TOTAL_TYPE
from .clean import _col


def total_refresh(quantity, unit_price) -> Column:
    """Quantity * price, the price already DECIMAL(12,2).

    ``try_cast`` gives null on DECIMAL(14,2) overflow (a plain cast would
    abort the job); the quality rules report that null.
    """
    return (_col(quantity) * _col(unit_price)).try_cast(TOTAL_TYPE.simpleString())


def total_incremental(quantity, raw_price) -> Column:
    """Product on the unrounded price, then half-even to cents."""
    return F.bround(_col(quantity) * _col(raw_price), 2).try_cast(TOTAL_TYPE.simpleString())


def to_price(raw_price) -> Column:
    """Stored unit price: DECIMAL(12,2), half-up like a cast; null on overflow."""
    return _col(raw_price).try_cast(PRICE_TYPE.simpleString())


def sum_amount(c) -> Column:
    """A5: SUM of a decimal, widened to DECIMAL(38,2)."""
    return F.sum(_col(c)).cast(SUM_TYPE)

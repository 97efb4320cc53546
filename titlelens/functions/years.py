"""Year arithmetic on integer year columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decade_of(year) -> Column:
    """``int(year / 10) * 10`` (truncation toward zero), as an int."""
    return ((_col(year) / 10).cast("int") * 10).cast("int")


def decade_floor_of(year) -> Column:
    """``floor(year / 10) * 10`` as an int (differs from ``decade_of`` only
    for negative years)."""
    return (F.floor(_col(year) / 10) * 10).cast("int")


def is_four_digit_year(year) -> Column:
    """True for integer years written with exactly four digits: the same
    set as matching ``^[0-9]{4}$`` against the decimal text of an int
    (negative numbers and leading zeros never match), without the cast."""
    y = _col(year)
    return y.isNotNull() & y.between(1000, 9999)

"""Band join: rows of one key whose values lie at most a given distance apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_join(left: DataFrame, right: DataFrame, keys: list[str], value: str, band: int,
              suffix: str = "_other", strict: bool = False) -> DataFrame:
    """Pairs of a row of ``left`` and one of ``right`` with equal ``keys`` and
    ``0 <= right.value - left.value <= band`` (``strict``: not 0).

    The axis is cut into bins as wide as the band, so a partner lies in the
    row's own bin or the next one: an equi-join on (keys, bin), which shuffles
    and splits like any other and never compares values further apart than two bins.
    Right-hand columns but for the keys get ``suffix``. Rows with a null key
    or value have no partner. Reduce copies of a value to a count before
    joining: pairs of equal rows then are a product, not rows.
    """
    width = max(1, band)
    bin_of = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    near = left.withColumn("__bin", F.explode(F.array(bin_of(value), bin_of(value) + 1)))
    other = right.select(*keys, *(F.col(c).alias(c + suffix) for c in right.columns if c not in keys), bin_of(value).alias("__bin"))
    gap: Column = F.col(value + suffix) - F.col(value)
    least = gap > 0 if strict else gap >= 0
    return near.join(other, [*keys, "__bin"]).where(least & (gap <= band)).drop("__bin")

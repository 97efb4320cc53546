"""Summaries at several levels, in wide form, and over a trailing range of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subtotals(df: DataFrame, keys: list[str], many: str, sets: Sequence[Sequence[str]], sums: dict[str, Column]) -> DataFrame:
    """The ``sums`` of ``df`` by each of the grouping ``sets`` of ``keys`` and ``many``, a
    column of arrays: a row counts once for each distinct value in it, and once
    in the sets without it. An empty or null array is the value null.

    ``grouping_id`` (a bit for each of ``keys`` and ``many``, set where it is summed over) tells a
    subtotal from a null key. Rows are summed up by the finest key before they are copied
    for each set, so what is copied grows with the groups, not with the rows; each sum is
    kept twice, over all values and over the first value of a row, and the sets
    without ``many`` read the second.
    """
    flat = df.select(*keys, F.posexplode_outer(F.array_distinct(many)).alias("__at", many),
                     *(c.alias(f"__{n}") for n, c in sums.items()))
    finest = flat.groupBy(*keys, many).agg(*(F.sum(f"__{n}").alias(f"__all_{n}") for n in sums),
                                           *(F.sum(F.when(F.coalesce("__at", F.lit(0)) == 0, F.col(f"__{n}"))).alias(f"__once_{n}") for n in sums))
    columns = [*keys, many]
    unknown = {c for s in sets for c in s} - set(columns)
    if unknown:
        raise ValueError(f"grouping sets name {sorted(unknown)}, which are none of {columns}")
    total = lambda n: F.when(F.grouping(many) == 1, F.sum(f"__once_{n}")).otherwise(F.sum(f"__all_{n}"))
    return finest.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().cast("int").alias("grouping_id"), *(F.coalesce(total(n), F.lit(0)).alias(n) for n in sums))


def to_wide(df: DataFrame, key: str, column: str, values: Sequence, prefix: str, other: str = "other", missing: str = "missing") -> DataFrame:
    """Rows of ``df`` counted by ``key`` (a row each) and value of ``column`` (a column
    each, ``prefix`` and value). ``values`` is the declared list, so the schema does not depend on the
    data; other values are counted in ``other`` and nulls in ``missing``: every
    row is counted once. Counted by (key, value) first, so a hot key costs one row a value."""
    if len(set(values)) != len(values):
        raise ValueError("a value is declared twice")
    names = [f"{prefix}{v}" for v in values] + [prefix + other, prefix + missing]
    if len(set(names)) != len(names):
        raise ValueError(f"a declared value has the name of {other!r} or {missing!r}")
    counts = df.groupBy(key, column).agg(F.count(F.lit(1)).alias("__n"))
    at = F.when(F.col(column).isNull(), names[-1]).when(F.col(column).isin(*values), F.concat(F.lit(prefix), F.col(column).cast("string"))).otherwise(names[-2])
    wide = counts.select(key, at.alias("__at"), "__n").groupBy(key).pivot("__at", names).agg(F.sum("__n"))
    return wide.select(key, *(F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(n) for n in names))


def trailing_sums(df: DataFrame, keys: list[str], at: str, span: int, sums: list[str], prefix: str = "trailing_") -> DataFrame:
    """``df``, one row for each ``keys`` and ``at``, with the sums of ``sums`` over the rows of
    the same keys with a value from ``at - span + 1`` to ``at``, and how many these are
    (``prefix + "points"``). The range is of values, not of rows: absent
    values count as nothing and do not move it. Rows with a null ``at`` are a range of their own.
    Rows of one value are peers: they share a result."""
    if span < 1:
        raise ValueError(f"span must be at least 1, not {span}")
    window = Window.partitionBy(*keys).orderBy(F.col(at)).rangeBetween(1 - span, 0)
    return df.withColumns({prefix + "points": F.count(F.lit(1)).over(window), **{prefix + c: F.sum(c).over(window) for c in sums}})

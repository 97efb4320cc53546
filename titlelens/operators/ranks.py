"""Ranks over a whole table without a window over all of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_ranks(df: DataFrame, order: list[str], buckets: list[Column], tiles: int = 4, descending: bool = True) -> DataFrame:
    """``df`` with ``rank``, ``dense_rank``, ``percent_rank``, ``cume_dist`` and ``tile``
    by the columns ``order`` over all rows.

    Rows are counted by value first, so a value that a third of all rows share
    is one row. ``buckets`` cut the values into ranges that follow the order
    (each a monotone function of a leading part of it; their number must be
    bounded): one count a bucket, summed up over the buckets, is the offset of each, and a
    window over one bucket's values adds the rest. Ties are groups of equal
    values: they share a rank and a tile, the one in which the group starts.
    Nulls are values, the last ones. Results are joined back by value.
    """
    by = lambda cols: [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in cols]
    at = [f"__bucket_{k}" for k in range(len(buckets))]
    values = df.groupBy(*order).agg(F.count(F.lit(1)).alias("__n")).withColumns(dict(zip(at, buckets, strict=True)))
    before = Window.orderBy(*by(at)).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = values.groupBy(*at).agg(F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__values"))
    sums = sums.select(*(F.col(c).alias(f"__of{c}") for c in at), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rows_before"),
                       F.coalesce(F.sum("__values").over(before), F.lit(0)).alias("__values_before"), F.sum("__n").over(everything).alias("__total"))
    inside = Window.partitionBy(*at).orderBy(*by(order))
    values = values.withColumns({"__at": F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "__no": F.row_number().over(inside)})
    placed = values.join(sums, [values[c].eqNullSafe(sums[f"__of{c}"]) for c in at])
    last = F.col("__rows_before") + F.col("__at")
    first = last - F.col("__n")
    placed = placed.select(
        *(F.col(c).alias(f"__v_{c}") for c in order), (first + 1).alias("rank"), (F.col("__values_before") + F.col("__no")).alias("dense_rank"),
        F.when(F.col("__total") > 1, first / (F.col("__total") - 1)).otherwise(0.0).alias("percent_rank"), (last / F.col("__total")).alias("cume_dist"),
        (F.floor(first * tiles / F.col("__total")) + 1).cast("int").alias("tile"))
    return df.join(placed, [df[c].eqNullSafe(placed[f"__v_{c}"]) for c in order]).drop(*(f"__v_{c}" for c in order))

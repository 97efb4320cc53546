"""As-of join: each row with the last earlier row of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], time: str, tie: str, values: list[str],
              prefix: str = "prev_", bin_width: int = 10) -> DataFrame:
    """``left`` with the columns ``values`` of the last row of ``right`` that has equal
    ``keys`` and a strictly smaller ``time``; null if there is none. Of rows
    of one time the one with the largest ``tie`` counts.

    No pairs are made. Both sides are put in one list, sorted within (keys, bin of
    the time), and the last right-hand row is carried forward; the last of each
    earlier bin comes from a partial aggregate and a window over one row
    a bin. So a key with very many rows is split by time. Rows of ``left`` with a null key or
    time keep null values.
    """
    bin_ = F.floor(F.col(time) / F.lit(bin_width)).cast("long").alias("__bin")
    found = F.struct(F.col(time), F.col(tie), *(F.col(v).alias(f"v_{v}") for v in values)).alias("__found")
    latest = (right.where(" and ".join(f"`{k}` is not null" for k in [*keys, time])).select(*keys, time, bin_, found)
              .groupBy(*keys, "__bin", time).agg(F.max("__found").alias("__found")))
    row = F.struct(*(F.col(c) for c in left.columns)).alias("__row")
    none = F.lit(None).cast(latest.schema["__found"].dataType).alias("__found")
    both = left.select(*keys, F.col(time), bin_, F.lit(0).alias("__side"), row, none).unionByName(
        latest.select(*keys, time, "__bin", F.lit(1).alias("__side"), F.lit(None).cast(left.select(row).schema[0].dataType).alias("__row"), "__found"))
    # Rows of the left come first within a time: what happens at the same time is not earlier.
    inside = Window.partitionBy(*keys, "__bin").orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("__here", F.last("__found", ignorenulls=True).over(inside)).where("__side = 0")
    before = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = both.groupBy(*keys, "__bin").agg(F.max("__found").alias("__last"))
    bins = bins.select(*(F.col(k).alias(f"__k_{k}") for k in keys), F.col("__bin").alias("__of"), F.last("__last", ignorenulls=True).over(before).alias("__earlier"))
    same = [carried[k].eqNullSafe(bins[f"__k_{k}"]) for k in keys] + [carried["__bin"].eqNullSafe(bins["__of"])]
    joined = carried.join(bins, same, "left")
    known = F.col(time).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    last = F.when(known, F.coalesce("__here", "__earlier"))
    return joined.select("__row", last.alias("__l")).select("__row.*", *(F.col(f"__l.v_{v}").alias(prefix + v) for v in values))

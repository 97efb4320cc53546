"""Previous-value comparisons along an ordered key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_change(df: DataFrame, value: str, order: str, partition=None,
               prev_alias: str | None = None, change_alias: str | None = None) -> DataFrame:
    """Add ``prev`` (the value of the previous *present* row along ``order``,
    within ``partition``) and ``change = value - prev``.

    Meant for already-aggregated inputs (one row per partition key and
    order value). Without ``partition`` the window is global and runs in a
    single task, which is only acceptable over a bounded domain such as
    decades or years.
    """
    parts = [] if partition is None else ([partition] if isinstance(partition, str) else list(partition))
    window = Window.partitionBy(*parts).orderBy(order) if parts else Window.orderBy(order)
    prev_alias = prev_alias or f"prev_{value}"
    out = df.withColumn(prev_alias, F.lag(value).over(window))
    if change_alias:
        out = out.withColumn(change_alias, F.col(value) - F.col(prev_alias))
    return out

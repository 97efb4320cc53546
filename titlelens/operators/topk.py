"""Top-k operators with deterministic tie-breaks.

``top_n`` is ``ORDER BY ... LIMIT n``, which Spark plans as
TakeOrderedAndProject: every task keeps its own n best rows and only those
reach the final merge, so the work is distributed and the driver sees at
most ``n x tasks`` rows. Order keys should end in a unique column so that
the cut is reproducible. The merge is one partition: meant for report-sized
n (up to some 100,000 rows); sort and write instead to keep more.

``top_per_group`` is ``rank/dense_rank/row_number <= k`` directly above the
window; Spark inserts a partial WindowGroupLimit before the shuffle, so a
hot group (one genre holding a third of the rows) is cut to its top rows on
the map side before it reaches a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, partition, order: list[Column], k: int,
                  method: str = "rank", alias: str = "rank") -> DataFrame:
    """Rows whose ``method`` position within ``partition`` is at most ``k``.

    ``rank``/``dense_rank`` keep every tie at the cut; ``row_number`` needs
    an ``order`` that is unique within the group to be deterministic.
    """
    if method not in _RANKERS:
        raise ValueError(f"method must be one of {sorted(_RANKERS)}, not {method!r}")
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    parts = [partition] if isinstance(partition, (str, Column)) else list(partition)
    window = Window.partitionBy(*parts).orderBy(*order)
    ranked = df.withColumn(alias, _RANKERS[method]().over(window))
    return ranked.where(F.col(alias) <= k)

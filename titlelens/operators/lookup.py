"""Dimension lookups for a side with a proven row bound.

After a top-k the fact side has at most ``n`` rows, but a LEFT join keeps it
as the preserved side, and a broadcast hash join can only build the
non-preserved (dimension) side. Spark would therefore shuffle the whole
dimension table to join twenty rows. ``lookup_bounded`` instead

1. semi-joins the dimension against the keys of the bounded side: Spark sizes
   a LIMIT by its row count, so for a few rows it broadcasts them and scans the
   dimension once with no shuffle, and for a huge limit it shuffles, then
2. joins the bounded side with the matching dimension rows.

The bounded side's plan appears twice. Its shuffle exchange is identical in
both branches and is reused (``spark.sql.exchange.reuse``, on by default), so
the scans, joins and map-side aggregation below it run once; only the
post-shuffle final aggregation and the top-k read that shuffle output twice.
This needs the key branch to keep every column of the other one: a caller whose
bounded side carries aggregates beyond its order columns must add them to
the order (after a unique column they cannot change it), or column pruning makes the
two shuffles differ and the input runs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_bounded(bounded: DataFrame, dim: DataFrame, left_key: str, right_key: str,
                   how: str = "left") -> DataFrame:
    keys = bounded.select(F.col(left_key).alias("__key")).where(F.col("__key").isNotNull())
    hits = dim.join(keys, dim[right_key] == keys["__key"], "left_semi")
    if left_key == right_key:
        return bounded.join(hits, left_key, how)
    return bounded.join(hits, bounded[left_key] == hits[right_key], how)

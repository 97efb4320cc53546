"""Quantile sketches as stored columns: made per group of new rows, kept as
binary values, merged later without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (8, 65535)


def rank_error(k: int) -> float:
    """The published error of a KLL sketch of size ``k``: the share of the values by which the
    rank of an answer is off, kept with 99 % confidence, however many sketches were merged."""
    return 2.296 / k ** 0.9723


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = 200) -> DataFrame:
    """A row for each of ``keys``: ``n`` (values, nulls left out) and ``sketch``, of a
    size bounded by ``k`` and not by ``n``. Whole numbers only. Partial in each
    task, so a hot key sends one sketch a task. Null keys are a group."""
    if not SIZES[0] <= k <= SIZES[1]:
        raise ValueError(f"k must be {SIZES[0]} to {SIZES[1]}, not {k}")
    of = F.col(value).cast("long")
    return df.groupBy(*keys).agg(F.count(of).alias("n"), F.kll_sketch_agg_bigint(of, F.lit(k)).alias("sketch"))


def merge_sketches(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Stored sketches merged by ``keys`` (fewer than they were made by): ``n`` summed,
    ``sketches`` (how many), ``sketch``. The result is stored and merged like its parts."""
    return stored.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("sketch").alias("sketches"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_quantiles(merged: DataFrame, probabilities: Sequence[float], alias: str = "estimates") -> DataFrame:
    """``merged`` without ``sketch``, with an array of the values at ``probabilities``; null if nothing was counted."""
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities must be 0 to 1: {list(probabilities)}")
    at = F.array(*(F.lit(float(p)) for p in probabilities))
    return merged.withColumn(alias, F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", at))).drop("sketch")

"""Trend questions over years and decades: D6 metric_trend_by_decade,
O5 adult_split_by_year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import decade_of
from titlelens.operators import lag_change
from titlelens.plans.common import MOVIE, count_rows, is_type


def metric_trend_by_decade(cat: Catalog, metric: str = "runtimeMinutes", label: str = "runtime",
                           from_year: int = 1900, title_type: str = MOVIE) -> DataFrame:
    """Average of a positive metric per decade (years after ``from_year``),
    with the change from the previous present decade, absolute and in
    percent. The lag runs over one row per decade (a bounded domain)."""
    titles = cat.title_basics.where(
        is_type(title_type) & F.col(metric).isNotNull() & (F.col(metric) > 0)
        & F.col("startYear").isNotNull() & (F.col("startYear") > from_year))
    per = titles.groupBy(decade_of("startYear").alias("decade")).agg(
        F.avg(metric).alias(f"avg_{label}"), count_rows("movie_count")).where(F.col("decade").isNotNull())
    prev, change = f"prev_decade_{label}", f"{label}_change"
    lagged = lag_change(per, f"avg_{label}", "decade", prev_alias=prev, change_alias=change)
    return lagged.withColumn(
        f"{label}_change_percent",
        F.when(F.col(prev).isNotNull(), F.col(change) / F.col(prev) * 100)).orderBy("decade")


def adult_split_by_year(cat: Catalog, max_year: int = 2025, merge_unknown_year: bool = False) -> DataFrame:
    """Adult and non-adult title counts per start year (all types), newest
    first, years up to ``max_year``.

    Defined as the full outer join of two per-year counts with nulls then
    filled with 0. Years are counted in one aggregation pass instead; the
    outer-join result is reproduced exactly, including its treatment of
    titles without a year: null keys never match in a join, so they give up
    to two rows with year 0, (0, adult, 0) and (0, 0, non-adult).
    ``merge_unknown_year=True`` gives one (0, adult, non-adult) row instead.
    """
    per = cat.title_basics.groupBy("startYear").agg(
        F.count_if(F.col("isAdult") == 1).alias("adult_count"),
        F.count_if(F.col("isAdult") == 0).alias("non_adult_count"))
    year, adult, other = F.col("startYear"), F.col("adult_count"), F.col("non_adult_count")
    zero = F.lit(0).cast("long")

    def row(y, a, b):
        return F.struct(y.cast("int").alias("startYear"), a.alias("adult_count"), b.alias("non_adult_count"))

    unknown = (F.array(row(F.lit(0), adult, other)) if merge_unknown_year
               else F.array(row(F.lit(0), adult, zero), row(F.lit(0), zero, other)))
    rows = F.when(year.isNull(), unknown).otherwise(F.array(row(year, adult, other)))
    out = per.select(F.inline(rows)).where((adult > 0) | (other > 0))
    return out.where(F.col("startYear") <= max_year).orderBy(F.desc("startYear"))

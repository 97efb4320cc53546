"""Questions about series and episodes: P2 avg_children_per_season,
P5 duplicate_titles, P6 series_by_episode_count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.operators import top_n
from titlelens.plans.common import TV_SERIES


def avg_children_per_season(cat: Catalog, from_year: int = 1990) -> DataFrame:
    """Mean episodes per (series, season), by the series' start year, for
    series starting in or after ``from_year``.

    Episodes are counted per (series, season) before the join: a series
    start year depends only on the series, so this is the same grouping,
    and the join then carries one row per season instead of per episode.
    """
    seasons = cat.title_episode.where(F.col("seasonNumber").isNotNull()).groupBy(
        "parentTconst", "seasonNumber").agg(F.count("tconst").alias("episode_count"))
    series = cat.title_basics.where(F.col("startYear") >= from_year).select(
        F.col("tconst").alias("parentTconst"), "startYear")
    return (seasons.join(series, "parentTconst").groupBy("startYear")
            .agg(F.avg("episode_count").alias("avg_episodes")).orderBy("startYear"))


def duplicate_titles(cat: Catalog, n: int = 20) -> DataFrame:
    """Primary titles shared by more than one non-episode title.
    Ties: primaryTitle."""
    non_episodes = cat.title_basics.select("tconst", "primaryTitle").join(
        cat.title_episode.select("tconst"), "tconst", "left_anti")
    counts = non_episodes.groupBy("primaryTitle").agg(F.count("primaryTitle").alias("numVersions"))
    return top_n(counts.where(F.col("numVersions") > 1), n, F.desc("numVersions"), F.asc("primaryTitle"))


def series_by_episode_count(cat: Catalog, n: int = 20, series_type: str = TV_SERIES) -> DataFrame:
    """Series of ``series_type`` with the most episodes. Episodes are
    counted per parent before the join. Ties: series id."""
    counts = cat.title_episode.groupBy("parentTconst").agg(F.count("tconst").alias("numEpisodes"))
    series = cat.title_basics.where(F.col("titleType") == series_type).select(
        F.col("tconst").alias("parentTconst"), "primaryTitle")
    return top_n(counts.join(series, "parentTconst"), n, F.desc("numEpisodes"),
                 F.asc("parentTconst")).select("primaryTitle", "numEpisodes")

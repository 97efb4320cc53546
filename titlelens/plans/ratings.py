"""Questions about ratings: D1 top_rated_titles, D3 rating_by_facet,
M2 rating_by_decade, M3 top_titles_per_region,
P4 votes_by_year_with_running_avg."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import decade_of, explode_list, is_four_digit_year
from titlelens.operators import top_n, top_per_group
from titlelens.plans.common import MOVIE, count_rows, is_type


def top_rated_titles(cat: Catalog, min_votes: int = 10000, n: int = 20,
                     title_type: str = MOVIE) -> DataFrame:
    """Highest-rated titles of a type with at least ``min_votes`` votes.
    Ties: more votes first, then tconst."""
    titles = cat.title_basics.where(is_type(title_type)).select(
        "tconst", "primaryTitle", "originalTitle", "startYear", "genres")
    rated = cat.title_ratings.where(F.col("numVotes") >= min_votes)
    joined = titles.join(rated, "tconst").select(
        "tconst", "primaryTitle", "originalTitle", "startYear", "genres", "averageRating", "numVotes")
    return top_n(joined, n, F.desc("averageRating"), F.desc("numVotes"), F.asc("tconst"))


def rating_by_facet(cat: Catalog, facet: str = "genres", label: str = "genre",
                    after_year: int = 2010, min_count: int = 10,
                    title_type: str = MOVIE) -> DataFrame:
    """Average rating and title count per element of a multi-value column,
    for titles released after ``after_year``; groups under ``min_count``
    titles are dropped."""
    titles = cat.title_basics.where(
        is_type(title_type) & (F.col("startYear") > after_year) & F.col(facet).isNotNull()
    ).select("tconst", facet)
    # Join first, explode afterwards: the join shuffles one row per title.
    rated = titles.join(cat.title_ratings.select("tconst", "averageRating"), "tconst")
    per = explode_list(rated, facet, label, keep=["averageRating"]).groupBy(label).agg(
        F.avg("averageRating").alias("avg_rating"), count_rows("movie_count"))
    return per.where(F.col("movie_count") >= min_count).orderBy(F.desc("avg_rating"), F.asc(label))


def rating_by_decade(cat: Catalog) -> DataFrame:
    """Average rating and count per decade of release, all title types,
    four-digit years only."""
    titles = cat.title_basics.where(is_four_digit_year("startYear")).select("tconst", "startYear")
    joined = titles.join(cat.title_ratings.select("tconst", "averageRating"), "tconst")
    return (joined.groupBy(decade_of("startYear").alias("decade"))
            .agg(F.avg("averageRating").alias("avg_rating"), count_rows("movie_count"))
            .orderBy("decade"))


def top_titles_per_region(cat: Catalog, k: int = 3, min_votes: int = 1000,
                          title_type: str = MOVIE) -> DataFrame:
    """Best-rated titles per release region (a title counts once per region).
    Order within a region: rating, votes, then tconst.

    A title has many alternative-title rows per region. They are reduced to
    one per (title, region) before the join: copies are combined map-side, so
    neither a title with a third of all rows floods its join task nor its
    copies, which tie, the region's window. The partial per-region limit then
    sends at most k titles per task and region.
    """
    rated = cat.title_basics.where(is_type(title_type)).select(
        "tconst", "primaryTitle", "startYear").join(
        cat.title_ratings.where(F.col("numVotes") >= min_votes), "tconst")
    regions = cat.title_akas.where(F.col("region").isNotNull()).select(
        F.col("titleId").alias("tconst"), "region").distinct()
    ranked = top_per_group(regions.join(rated, "tconst"), "region",
                           [F.desc("averageRating"), F.desc("numVotes"), F.asc("tconst")],
                           k, "row_number", alias="rank")
    return ranked.select("primaryTitle", "startYear", "region", "averageRating", "numVotes", "rank").orderBy(
        "region", "rank")


def votes_by_year_with_running_avg(cat: Catalog, min_rating: float = 7.5) -> DataFrame:
    """Average votes per release year of titles rated above ``min_rating``
    (all types), with the running mean of those yearly averages."""
    rated = cat.title_ratings.where(F.col("averageRating") > min_rating).select("tconst", "numVotes")
    years = cat.title_basics.where(F.col("startYear").isNotNull()).select("tconst", "startYear")
    per_year = rated.join(years, "tconst").groupBy("startYear").agg(F.avg("numVotes").alias("avgVotes"))
    # Global window over one row per year: a bounded domain.
    running = Window.orderBy("startYear").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_year.withColumn("cumulativeAvgVotes", F.avg("avgVotes").over(running)).orderBy("startYear")

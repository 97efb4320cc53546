"""Questions about genres, languages and job categories:
D5 localized_language_counts, O3 top_titles_per_facet,
O4 facet_runtime_ranking, O6 titles_per_category,
M6 facet_growth_by_decade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import decade_floor_of, explode_list
from titlelens.operators import lag_change, top_n, top_per_group
from titlelens.plans.common import ENGLISH, MOVIE, count_rows, is_type


def localized_language_counts(cat: Catalog, exclude=ENGLISH, n: int = 20,
                              title_type: str = MOVIE) -> DataFrame:
    """Alternative-title rows per language (other than ``exclude``) on
    titles of ``title_type``. Counts aka rows, not distinct titles.
    Ties: language."""
    titles = cat.title_basics.where(is_type(title_type)).select("tconst")
    akas = cat.title_akas.where(F.col("language").isNotNull() & ~F.col("language").isin(*exclude)) \
        .select(F.col("titleId").alias("tconst"), "language")
    counts = akas.join(titles, "tconst").groupBy("language").agg(count_rows("movie_count"))
    return top_n(counts, n, F.desc("movie_count"), F.asc("language"))


def top_titles_per_facet(cat: Catalog, facet: str = "genres", label: str = "genre",
                         order_by: str = "numVotes", k: int = 5, method: str = "rank",
                         min_votes: int = 1000, title_type: str = MOVIE) -> DataFrame:
    """Top ``k`` rated titles per facet value by ``order_by`` (descending);
    with ``rank`` every tie at the cut is kept."""
    rated = cat.title_basics.where(is_type(title_type) & F.col(facet).isNotNull()).select(
        "tconst", "primaryTitle", "startYear", facet).join(
        cat.title_ratings.where(F.col("numVotes") >= min_votes), "tconst")
    exploded = explode_list(rated, facet, label,
                            keep=["primaryTitle", "startYear", "averageRating", "numVotes"])
    ranked = top_per_group(exploded, label, [F.desc(order_by)], k, method, alias=f"{label}_rank")
    return ranked.select("primaryTitle", "startYear", label, "averageRating", "numVotes",
                         f"{label}_rank").orderBy(label, f"{label}_rank")


def facet_runtime_ranking(cat: Catalog, max_runtime: int = 1000, facet: str = "genres",
                          label: str = "genre", title_type: str = MOVIE) -> DataFrame:
    """Per genre: average runtime (truncated to int) and title count, the
    global average (the unweighted mean of the truncated genre averages,
    truncated), dense ranks by runtime and by count, and the difference to
    the global average in minutes and in whole percent (truncated).

    The global average is a window over the aggregated genres (one row per
    genre), so the whole answer stays one lazy plan with no driver
    round-trip.
    """
    titles = cat.title_basics.where(
        is_type(title_type) & F.col("runtimeMinutes").isNotNull() & F.col(facet).isNotNull()
        & (F.col("runtimeMinutes") > 0) & (F.col("runtimeMinutes") < max_runtime)
    ).select("runtimeMinutes", facet)
    per = explode_list(titles, facet, label, keep=["runtimeMinutes"]).groupBy(label).agg(
        F.avg("runtimeMinutes").cast("int").alias("avg_runtime"), count_rows("movie_count"))
    everything = Window.partitionBy()
    g = F.col("global_avg_runtime")
    return (per
            .withColumn("global_avg_runtime", F.avg("avg_runtime").over(everything).cast("int"))
            .withColumn("runtime_rank", F.dense_rank().over(Window.orderBy(F.desc("avg_runtime"))))
            .withColumn("popularity_rank", F.dense_rank().over(Window.orderBy(F.desc("movie_count"))))
            .withColumn("diff_from_global_avg", F.col("avg_runtime") - g)
            .withColumn("percentage_diff", ((F.col("avg_runtime") - g) * 100 / g).cast("int"))
            .orderBy(F.desc("avg_runtime"), F.asc(label)))


def titles_per_category(cat: Catalog, exact: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct titles per credit category. By default an approximate
    distinct count (HyperLogLog++, relative error ``rsd``) that merges
    map-side sketches; ``exact=True`` counts exactly (two-stage distinct
    aggregation shuffled on (category, tconst), so a hot category is
    spread over all tasks)."""
    credits = cat.title_principals.where(F.col("category").isNotNull())
    distinct = (F.count_distinct("tconst") if exact else F.approx_count_distinct("tconst", rsd))
    return credits.groupBy("category").agg(distinct.alias("distinct_movies")).orderBy(
        F.desc("distinct_movies"), F.asc("category"))


def titles_per_category_bound(cat: Catalog, rsd: float = 0.05) -> DataFrame:
    """Exact distinct titles per credit category, and whether the approximate
    count lies within its documented bound, three relative errors ``rsd``."""
    both = titles_per_category(cat, True).join(
        titles_per_category(cat, False, rsd).withColumnRenamed("distinct_movies", "estimate"), "category")
    error = F.abs(F.col("estimate") - F.col("distinct_movies"))
    return both.select("category", "distinct_movies",
                       (error <= 3 * rsd * F.col("distinct_movies")).alias("within_bound"))


def facet_growth_by_decade(cat: Catalog, from_year: int = 1990, n: int = 20, facet: str = "genres",
                           label: str = "genre", title_type: str = MOVIE) -> DataFrame:
    """Titles per (decade, genre) from ``from_year`` on, compared with the
    genre's previous present decade; largest growth first (first decades,
    without a predecessor, sort last). Ties: genre, decade."""
    titles = cat.title_basics.where(
        is_type(title_type) & F.col(facet).isNotNull() & F.col("startYear").isNotNull()
        & (F.col("startYear") >= from_year)
    ).select(decade_floor_of("startYear").alias("decade"), facet)
    counts = explode_list(titles, facet, label, keep=["decade"]).groupBy("decade", label).agg(
        count_rows("movie_count"))
    lagged = lag_change(counts, "movie_count", "decade", partition=label,
                        prev_alias="prev_decade_count", change_alias="growth")
    return top_n(lagged.select("decade", label, "movie_count", "prev_decade_count", "growth"), n,
                 F.desc_nulls_last("growth"), F.asc(label), F.asc("decade"))

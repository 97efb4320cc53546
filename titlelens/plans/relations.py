"""Questions that relate a title to others along an axis: releases close to each
other (band join), the last acclaimed title before one (as-of join), and a
title's place among all (global ranks)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import explode_list
from titlelens.operators import asof_join, band_join, global_ranks, lookup_bounded, top_n
from titlelens.plans.common import MOVIE, is_type


def _credits(cat: Catalog, role: str, title_type: str) -> DataFrame:
    titles = cat.title_basics.where(is_type(title_type) & F.col("startYear").isNotNull()).select("tconst", "startYear")
    crew = cat.title_crew.where(F.col(role).isNotNull()).select("tconst", role)
    return explode_list(titles.join(crew, "tconst"), role, "creator", keep=["tconst", "startYear"])


def close_releases(cat: Catalog, band: int = 2, n: int = 20, role: str = "directors", title_type: str = MOVIE) -> DataFrame:
    """The ``n`` creators with most pairs of releases at most ``band`` years
    apart. Releases are counted by (creator, year) first; years meet by a band join and
    their pairs are products, so a creator with millions of credits
    costs no more than the years they span. Ties: creator id."""
    years = _credits(cat, role, title_type).groupBy("creator", "startYear").agg(F.count(F.lit(1)).alias("titles"))
    apart = band_join(years, years, ["creator"], "startYear", band, strict=True).select(
        "creator", F.lit(0).cast("long").alias("titles"), (F.col("titles") * F.col("titles_other")).alias("pairs"))
    alike = years.select("creator", "titles", F.floor(F.col("titles") * (F.col("titles") - 1) / 2).alias("pairs"))
    stats = alike.unionByName(apart).groupBy("creator").agg(F.sum("titles").alias("title_count"), F.sum("pairs").alias("close_pairs"))
    order = [F.desc("close_pairs"), F.asc_nulls_first("creator"), F.asc("title_count")]
    top = top_n(stats.where("close_pairs > 0"), n, *order)
    named = lookup_bounded(top, cat.name_basics.select("nconst", "primaryName"), "creator", "nconst")
    return named.select("creator", "primaryName", "title_count", "close_pairs").orderBy(*order)


def last_acclaimed_title(cat: Catalog, min_votes: int = 1000, role: str = "directors", title_type: str = MOVIE) -> DataFrame:
    """For every credited title the creator's last title of an earlier year with
    at least ``min_votes`` votes, and the years since. Of titles of one year
    the one with the largest id counts; null if there is none."""
    credits = _credits(cat, role, title_type)
    voted = credits.join(cat.title_ratings.where(F.col("numVotes") >= min_votes).select("tconst"), "tconst")
    joined = asof_join(credits, voted, ["creator"], "startYear", "tconst", ["tconst", "startYear"])
    return joined.select("creator", "tconst", "startYear", "prev_tconst", "prev_startYear",
                         (F.col("startYear") - F.col("prev_startYear")).alias("years_since"))


def title_rank_positions(cat: Catalog, tiles: int = 4) -> DataFrame:
    """Every rated title's place among all by rating, then votes: rank, dense
    rank, percent rank, cumulative share and quartile. Buckets are the ratings
    (tenths, a bounded scale) and the binary length of the votes."""
    rated = cat.title_ratings.select("tconst", "averageRating", "numVotes")
    length = F.char_length(F.bin(F.col("numVotes")))
    ranked = global_ranks(rated, ["averageRating", "numVotes"], [F.col("averageRating"), length], tiles)
    return ranked.select("tconst", "averageRating", "numVotes", "rank", "dense_rank", "percent_rank", "cume_dist", "tile")

"""Questions answered at several levels or against another source: subtotals of
titles and votes, a genre by decade matrix, trailing votes and vote quantiles per genre, and the
directors that two tables name for a title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import decade_of, explode_list, split_list
from titlelens.operators import (compare_by_key, merge_sketches, quantile_sketches, rank_error, sketch_quantiles, subtotals, to_wide,
                                 trailing_sums)
from titlelens.plans.common import MOVIE, count_rows, is_type

LEVELS = (("titleType", "decade", "genre"), ("titleType", "genre"), ("decade", "genre"), ("genre",),
          ("titleType", "decade"), ("titleType",), ("decade",), ())
# The declared columns of the matrix.
DECADES = tuple(range(1950, 2030, 10))


def title_subtotals(cat: Catalog, levels=LEVELS) -> DataFrame:
    """Titles, rated titles and votes by type, decade and genre with all subtotals.
    A title counts once for each of its genres, and once wherever genres are summed over; titles
    without genre or year are a null group, told from a subtotal by ``grouping_id``."""
    titles = cat.title_basics.select("tconst", "titleType", decade_of("startYear").alias("decade"), split_list("genres").alias("genre"))
    rated = titles.join(cat.title_ratings.select("tconst", "numVotes", F.lit(1).cast("long").alias("rated")), "tconst", "left")
    sums = {"title_count": F.lit(1).cast("long"), "rated_count": F.coalesce("rated", F.lit(0)), "total_votes": F.col("numVotes").cast("long")}
    found = subtotals(rated, ["titleType", "decade"], "genre", levels, sums)
    return found.select("titleType", "decade", "genre", "grouping_id", "title_count", "rated_count", "total_votes")


def genre_decade_matrix(cat: Catalog, decades=DECADES, title_type: str = MOVIE) -> DataFrame:
    """Titles per genre in a column for each of ``decades``; those of other
    decades and without a year in a column each."""
    titles = cat.title_basics.where(is_type(title_type) & F.col("genres").isNotNull()).select(decade_of("startYear").alias("decade"), "genres")
    return to_wide(explode_list(titles, "genres", "genre", keep=["decade"]), "genre", "decade", decades, "movies_")


def genre_trailing_votes(cat: Catalog, years: int = 5, title_type: str = MOVIE) -> DataFrame:
    """Per genre and year with rated titles: titles and votes of that year and
    of the ``years`` calendar years up to it, however many of these have titles."""
    titles = cat.title_basics.where(is_type(title_type) & F.col("genres").isNotNull() & F.col("startYear").isNotNull()).select("tconst", "startYear", "genres")
    rated = titles.join(cat.title_ratings.select("tconst", "numVotes"), "tconst")
    per = explode_list(rated, "genres", "genre", keep=["startYear", "numVotes"]).groupBy("genre", "startYear").agg(
        count_rows("title_count"), F.sum("numVotes").alias("votes"))
    found = trailing_sums(per, ["genre"], "startYear", years, ["title_count", "votes"])
    return found.select("genre", "startYear", "title_count", "votes", F.col("trailing_points").alias("trailing_years"),
                        F.col("trailing_title_count").alias("trailing_titles"), "trailing_votes",
                        (F.col("trailing_votes") / F.col("trailing_title_count")).alias("trailing_avg_votes"))


def _genre_votes(cat: Catalog, title_type: str) -> DataFrame:
    titles = cat.title_basics.where(is_type(title_type) & F.col("genres").isNotNull()).select("tconst", "startYear", "genres")
    return explode_list(titles.join(cat.title_ratings.select("tconst", "numVotes"), "tconst"), "genres", "genre", keep=["startYear", "numVotes"])


def genre_vote_sketches(cat: Catalog, k: int = 1000, title_type: str = MOVIE) -> DataFrame:
    """The state to store, ``partitionBy("startYear")``: per genre and year the number of rated titles and
    a sketch of their votes. A new year is a new folder; old ones are not read again."""
    return quantile_sketches(_genre_votes(cat, title_type), ["genre", "startYear"], "numVotes", k)


def genre_vote_quantiles(cat: Catalog, probabilities=(0.1, 0.25, 0.5, 0.75, 0.9, 0.99), k: int = 1000, title_type: str = MOVIE,
                         stored: DataFrame | None = None) -> DataFrame:
    """Per genre and probability, from the yearly sketches merged (``stored``, or those of ``genre_vote_sketches``):
    whether the exact rank of the sketch's value keeps twice the stated error, which a sound sketch misses once in millions.
    The value itself is left out, as sketches draw at random; ``sketch_quantiles`` gives it."""
    sketches = genre_vote_sketches(cat, k, title_type) if stored is None else stored
    found = sketch_quantiles(merge_sketches(sketches, ["genre"]), probabilities).withColumnRenamed("n", "title_count")
    votes = _genre_votes(cat, title_type).where(F.col("numVotes").isNotNull()).groupBy("genre", "numVotes").agg(count_rows("n"))
    value = lambda i: F.get("estimates", F.lit(i))
    ranks = [F.sum(F.when(c, F.col("n")).otherwise(0)) for i in range(len(probabilities))
             for c in (F.col("numVotes") < value(i), F.col("numVotes") <= value(i))]
    at = F.array(*(F.struct(F.lit(float(p)).alias("probability"), below.alias("below"), upto.alias("upto"))
                   for p, below, upto in zip(probabilities, ranks[::2], ranks[1::2])))
    per = votes.join(found, "genre").groupBy("genre", "title_count", "sketches").agg(at.alias("at"))
    share = lambda c: F.col(f"at.{c}") / F.col("title_count")
    within = (share("below") <= F.col("at.probability") + 2 * rank_error(k)) & (share("upto") >= F.col("at.probability") - 2 * rank_error(k))
    return per.select("genre", "title_count", "sketches", F.explode("at").alias("at")).select(
        "genre", "at.probability", "title_count", "sketches", within.alias("within_bound"))


def director_source_differences(cat: Catalog, category: str = "director") -> DataFrame:
    """For every title with a director in the crew table (old) or the credits (new): how many
    each names, how many they have in common, and whether they agree. Credits may repeat a person; copies count."""
    crew = explode_list(cat.title_crew.where(F.col("directors").isNotNull()), "directors", "nconst", keep=["tconst"])
    return compare_by_key(crew, cat.title_principals.where(F.col("category") == category).select("tconst", "nconst"), ["tconst"])

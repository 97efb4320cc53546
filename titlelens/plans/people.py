"""Questions about people: D2 most_credited_people, D4 improving_creators,
M1 leaders_per_facet, M4 most_diverse_people, M5 creators_of_high_rated,
P1 most_referenced_titles, P3 release_gap_by_creator,
O1 lead_director_genre_counts, O2 collaboration_pairs.

People are joined to names as late as possible: facts are aggregated per
person id first (map-side combine), so a person with a huge number of
credits collapses to a handful of rows before any shuffle on the person
key, and the name lookup touches one row per person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlelens.catalog import Catalog
from titlelens.functions import explode_list, first_listed
from titlelens.operators import lookup_bounded, top_n, top_per_group
from titlelens.plans.common import ACTING, MOVIE, TV_EPISODE, count_rows, is_type


def _names(cat: Catalog, key: str = "nconst", name: str = "primaryName") -> DataFrame:
    return cat.name_basics.select(F.col("nconst").alias(key), F.col("primaryName").alias(name))


def _acting_credits(cat: Catalog, categories) -> DataFrame:
    return cat.title_principals.where(F.col("category").isin(*categories)).select("tconst", "nconst")


def most_credited_people(cat: Catalog, categories=ACTING, title_type: str = TV_EPISODE,
                         pool: int | None = 50, n: int = 20) -> DataFrame:
    """People with the most credit rows on titles of ``title_type``.

    Two cuts, as specified: the ``pool`` best counts are taken first, then
    people without a name row are dropped, then the best ``n`` remain. A
    nameless person inside the pool is not replaced from outside it. With
    ``pool=None`` names are joined first and ``n`` is the only cut.
    Ties: nconst.
    """
    titles = cat.title_basics.where(is_type(title_type)).select("tconst")
    counts = _acting_credits(cat, categories).join(titles, "tconst").groupBy("nconst").agg(
        count_rows("episode_count"))
    if pool is not None:
        # Spark sizes a LIMIT by its row count: a short list is broadcast, and the
        # name table is streamed past it without a shuffle.
        counts = top_n(counts, pool, F.desc("episode_count"), F.asc_nulls_first("nconst"))
    named = _names(cat).join(counts, "nconst").select(
        "nconst", "primaryName", "episode_count")
    return top_n(named, n, F.desc("episode_count"), F.asc("nconst"))


def improving_creators(cat: Catalog, role: str = "directors", min_votes: int = 1000,
                       min_steps: int = 3, n: int = 20, title_type: str = MOVIE) -> DataFrame:
    """Creators whose yearly average rating rises on average.

    Per creator and release year the average rating is taken; along the
    years (an unknown year sorts first) each year is compared with the
    previous one. ``years_with_movies`` counts comparisons with a known
    previous average (so ``min_steps`` = 3 needs four distinct years), and
    ``avg_rating_trend`` is the mean difference, kept when positive.

    The sum of consecutive differences telescopes: over a run of known
    averages it is (last - first). It is computed as such (each row adds
    +avg if it ends a run, -avg if it starts one), which is mathematically
    the sum of the differences. When every yearly average is known the only
    non-zero terms are +last and -first, so the floating-point result is the
    same for any summation order and the ranking does not depend on
    partitioning. The window sorts one row per (creator, year), never the
    raw credits.
    """
    titles = cat.title_basics.where(is_type(title_type)).select("tconst", "startYear")
    rated = cat.title_ratings.where(F.col("numVotes") >= min_votes).select("tconst", "averageRating")
    crew = cat.title_crew.where(F.col(role).isNotNull()).select("tconst", role)
    credits = explode_list(crew.join(titles, "tconst").join(rated, "tconst"), role, "director_id",
                           keep=["startYear", "averageRating"])
    yearly = credits.groupBy("director_id", "startYear").agg(F.avg("averageRating").alias("avg_rating"))

    along = Window.partitionBy("director_id").orderBy(F.asc_nulls_first("startYear"))
    cur, prev, nxt = F.col("avg_rating"), F.lag("avg_rating").over(along), F.lead("avg_rating").over(along)
    steps = yearly.select(
        "director_id",
        prev.alias("prev_avg"),
        (cur - prev).alias("step"),
        (F.when(cur.isNotNull() & nxt.isNull(), cur).otherwise(F.lit(0.0))
         - F.when(cur.isNotNull() & prev.isNull(), cur).otherwise(F.lit(0.0))).alias("run_edge"),
    )
    # HashPartitioning(director_id) from the window satisfies this grouping:
    # no further shuffle.
    per = steps.groupBy("director_id").agg(
        F.sum("run_edge").alias("edge_sum"),
        F.count("step").alias("n_steps"),
        F.count("prev_avg").alias("years_with_movies"),
    ).select(
        "director_id",
        F.when(F.col("n_steps") > 0, F.col("edge_sum") / F.col("n_steps")).alias("avg_rating_trend"),
        "years_with_movies",
    ).where((F.col("avg_rating_trend") > 0) & (F.col("years_with_movies") >= min_steps))
    named = per.join(_names(cat, "director_id", "director_name"), "director_id")
    return top_n(named.select("director_id", "director_name", "avg_rating_trend", "years_with_movies"),
                 n, F.desc("avg_rating_trend"), F.asc("director_id"))


def _movie_genre_credits(cat: Catalog, categories, title_type: str) -> DataFrame:
    """(nconst, genre) per acting credit on a titled movie with genres."""
    movies = cat.title_basics.where(is_type(title_type) & F.col("genres").isNotNull()).select(
        "tconst", "genres")
    return explode_list(_acting_credits(cat, categories).join(movies, "tconst"), "genres", "genre",
                        keep=["nconst"])


def leaders_per_facet(cat: Catalog, k: int = 1, by: str = "name", categories=ACTING,
                      title_type: str = MOVIE) -> DataFrame:
    """Most frequent performers per genre; every tie at dense rank <= k is
    kept. ``by="name"`` (default) groups credits by *name*, so homonyms
    merge; ``by="id"`` keeps people apart and adds their ``nconst``.

    Credits are first counted per (person id, genre) so that a prolific
    person is one row per genre before the join with names.
    """
    if by not in ("name", "id"):
        raise ValueError("by must be 'name' or 'id'")
    per_person = _movie_genre_credits(cat, categories, title_type).groupBy("nconst", "genre").agg(
        count_rows("n"))
    keys = ["genre", "primaryName"] if by == "name" else ["genre", "nconst", "primaryName"]
    per_name = per_person.join(_names(cat), "nconst").groupBy(*keys).agg(
        F.sum("n").alias("appearance_count"))
    ranked = top_per_group(per_name, "genre", [F.desc("appearance_count")], k, "dense_rank")
    return ranked.select(*keys, "appearance_count", "rank")


def most_diverse_people(cat: Catalog, n: int = 20, categories=ACTING,
                        title_type: str = MOVIE) -> DataFrame:
    """Performers (with a name row) credited in the most distinct genres.
    Ties: nconst."""
    per = _movie_genre_credits(cat, categories, title_type).groupBy("nconst").agg(
        F.count_distinct("genre").cast("int").alias("genre_count"))
    named = per.join(_names(cat), "nconst")
    return top_n(named, n, F.desc("genre_count"), F.asc("nconst")).select("primaryName", "genre_count")


def creators_of_high_rated(cat: Catalog, role: str = "directors", min_rating: float = 8.5,
                           n: int = 20, title_type: str = MOVIE) -> DataFrame:
    """Creators with the most titles rated at least ``min_rating``; the name
    is looked up with a left join (unknown people keep a null name).
    Ties: creator id."""
    high = cat.title_ratings.where(F.col("averageRating") >= min_rating).select("tconst")
    titles = cat.title_basics.where(is_type(title_type)).select("tconst")
    crew = cat.title_crew.where(F.col(role).isNotNull()).select("tconst", role)
    credits = explode_list(titles.join(high, "tconst").join(crew, "tconst"), role, "director",
                           keep=[])
    counts = credits.groupBy("director").agg(count_rows("top_movie_count"))
    top = top_n(counts, n, F.desc("top_movie_count"), F.asc_nulls_first("director"))
    named = lookup_bounded(top, cat.name_basics.select("nconst", "primaryName"), "director", "nconst")
    return named.orderBy(F.desc("top_movie_count"), F.asc_nulls_first("director")).select(
        "primaryName", "top_movie_count")


def most_referenced_titles(cat: Catalog, professions=ACTING, n: int = 20) -> DataFrame:
    """Titles most often listed in ``knownForTitles`` of people whose
    profession text contains any of ``professions`` (substring match).
    Unknown title ids are kept with null title columns. Ties: tconst."""
    prof = F.col("primaryProfession")
    cond = F.lit(False)
    for p in professions:
        cond = cond | prof.contains(p)
    people = cat.name_basics.where(cond & F.col("knownForTitles").isNotNull())
    mentions = explode_list(people, "knownForTitles", "tconst", keep=[]).groupBy("tconst").agg(
        count_rows("mention_count"))
    top = top_n(mentions, n, F.desc("mention_count"), F.asc_nulls_first("tconst"))
    titled = lookup_bounded(top, cat.title_basics.select("tconst", "primaryTitle", "startYear"),
                            "tconst", "tconst")
    return titled.select("tconst", "primaryTitle", "startYear", "mention_count").orderBy(
        F.desc("mention_count"), F.asc_nulls_first("tconst"))


def release_gap_by_creator(cat: Catalog, n: int = 20, role: str = "directors",
                           title_type: str = MOVIE) -> DataFrame:
    """For the ``n`` creators with most titles (at least two), the mean gap
    in years between consecutive releases.

    Consecutive gaps of a sorted integer sequence sum to (max - min), so the
    mean gap is (max - min) / (count - 1) exactly; it is computed in one
    partially-aggregated pass, so a creator with millions of credits never
    has to be sorted inside one task. Ties at the cut: creator id.
    """
    titles = cat.title_basics.where(is_type(title_type) & F.col("startYear").isNotNull()).select(
        "tconst", "startYear")
    crew = cat.title_crew.where(F.col(role).isNotNull()).select("tconst", role)
    credits = explode_list(titles.join(crew, "tconst"), role, "director", keep=["tconst", "startYear"])
    stats = credits.groupBy("director").agg(
        F.count("tconst").alias("movieCount"),
        F.min("startYear").alias("first_year"),
        F.max("startYear").alias("last_year"),
    ).where(F.col("movieCount") > 1).select(
        "director", "movieCount",
        ((F.col("last_year") - F.col("first_year")) / (F.col("movieCount") - 1)).alias("averageGap"))
    # averageGap after the unique director: it cannot change the order, but keeps
    # both branches of the lookup alike, so that their input runs once.
    top = top_n(stats, n, F.desc("movieCount"), F.asc_nulls_first("director"), F.asc("averageGap"))
    named = lookup_bounded(top, cat.name_basics.select("nconst", "primaryName"), "director", "nconst")
    return named.select("director", "primaryName", "movieCount", "averageGap").orderBy(
        F.desc("movieCount"), F.asc("averageGap"), F.asc_nulls_first("director"))


def lead_director_genre_counts(cat: Catalog, n: int = 20, title_type: str = MOVIE) -> DataFrame:
    """Counts per (whole genre list, first-listed director); shows the first
    genre of the list and the director's name (left join, may be null).
    The group key is wider than the shown columns, so a shown
    (lead_genre, director) pair may repeat. Ties: genre list, director id.
    """
    movies = cat.title_basics.where(is_type(title_type) & F.col("genres").isNotNull()).select(
        "tconst", "genres")
    crew = cat.title_crew.where(F.col("directors").isNotNull()).select(
        "tconst", first_listed("directors").alias("director"))
    # Grouping by the delimited string is grouping by its split array
    # (splitting is injective) without materialising arrays.
    counts = movies.join(crew, "tconst").groupBy("genres", "director").agg(count_rows("movie_count"))
    top = top_n(counts, n, F.desc("movie_count"), F.asc("genres"), F.asc_nulls_first("director"))
    named = lookup_bounded(top, cat.name_basics.select("nconst", "primaryName"), "director", "nconst")
    return named.orderBy(F.desc("movie_count"), F.asc("genres"), F.asc_nulls_first("director")).select(
        first_listed("genres").alias("lead_genre"), F.col("primaryName").alias("director"),
        "movie_count")


def collaboration_pairs(cat: Catalog, n: int = 20, title_type: str = MOVIE) -> DataFrame:
    """Most frequent (director name, writer name) pairs on titles with a
    known year, grouped by *names* and excluding pairs with equal names.

    As specified, the crew columns are matched to person ids unsplit, so
    only titles whose director and writer lists each hold exactly one id
    can match. Identical (directors, writers) strings are pre-aggregated
    before the two name joins, so a prolific pair costs one row there.
    Ties: director name, writer name.
    """
    titles = cat.title_basics.where(is_type(title_type) & F.col("startYear").isNotNull()).select("tconst")
    crew = cat.title_crew.where(F.col("directors").isNotNull() & F.col("writers").isNotNull()).select(
        "tconst", "directors", "writers")
    pairs = titles.join(crew, "tconst").groupBy("directors", "writers").agg(count_rows("n"))
    directors = _names(cat, "directors", "director_name").where(F.col("director_name").isNotNull())
    writers = _names(cat, "writers", "writer_name").where(F.col("writer_name").isNotNull())
    named = pairs.join(directors, "directors").join(writers, "writers").where(
        F.col("director_name") != F.col("writer_name"))
    counts = named.groupBy("director_name", "writer_name").agg(F.sum("n").alias("collaboration_count"))
    return top_n(counts, n, F.desc("collaboration_count"), F.asc("director_name"), F.asc("writer_name"))

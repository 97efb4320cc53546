"""Small shared pieces of the question plans."""

from __future__ import annotations

from pyspark.sql import functions as F

# The literal catalogue values the specified questions select on.
MOVIE = "movie"
TV_SERIES = "tvSeries"
TV_EPISODE = "tvEpisode"
ACTING = ("actor", "actress")
ENGLISH = ("en",)


def count_rows(alias: str):
    return F.count(F.lit(1)).alias(alias)


def is_type(title_type: str):
    return F.col("titleType") == title_type

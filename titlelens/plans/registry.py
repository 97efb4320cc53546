"""Registry of every question and profile, shared by the batch runner, the
CLI, the benchmark and the driver contract.

Each entry maps a stable name to ``(function, params)``; the function takes
a ``Catalog`` and returns a lazy DataFrame. Defaults reproduce the
specified behaviour; ``params`` only pins options that differ from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame

from titlelens.catalog import Catalog
from titlelens.plans import characters, facets, people, profile, ratings, relations, series, summaries, trends


@dataclass(frozen=True)
class Question:
    name: str
    fn: Callable[..., DataFrame]
    section: str
    params: dict = field(default_factory=dict)

    def __call__(self, cat: Catalog, **overrides) -> DataFrame:
        return self.fn(cat, **{**self.params, **overrides})


_QUESTIONS = [
    Question("top_rated_titles", ratings.top_rated_titles, "ratings"),
    Question("most_credited_people", people.most_credited_people, "people"),
    Question("most_credited_named_people", people.most_credited_people, "people", {"pool": None}),
    Question("rating_by_genre", ratings.rating_by_facet, "ratings"),
    Question("improving_directors", people.improving_creators, "people"),
    Question("non_english_languages", facets.localized_language_counts, "facets"),
    Question("runtime_by_decade", trends.metric_trend_by_decade, "trends"),
    Question("lead_director_genre_counts", people.lead_director_genre_counts, "people"),
    Question("director_writer_pairs", people.collaboration_pairs, "people"),
    Question("top_titles_per_genre", facets.top_titles_per_facet, "facets"),
    Question("genre_runtime_ranking", facets.facet_runtime_ranking, "facets"),
    Question("adult_split_by_year", trends.adult_split_by_year, "trends"),
    Question("titles_per_category", facets.titles_per_category, "facets", {"exact": True}),
    Question("titles_per_category_approx", facets.titles_per_category_bound, "facets"),
    Question("most_referenced_titles", people.most_referenced_titles, "people"),
    Question("episodes_per_season_by_year", series.avg_children_per_season, "series"),
    Question("release_gap_by_director", people.release_gap_by_creator, "people"),
    Question("votes_by_year_running_avg", ratings.votes_by_year_with_running_avg, "ratings"),
    Question("duplicate_titles", series.duplicate_titles, "series"),
    Question("series_by_episode_count", series.series_by_episode_count, "series"),
    Question("top_actors_per_genre", people.leaders_per_facet, "people"),
    Question("rating_by_decade", ratings.rating_by_decade, "ratings"),
    Question("top_titles_per_region", ratings.top_titles_per_region, "ratings"),
    Question("most_genre_diverse_people", people.most_diverse_people, "people"),
    Question("directors_of_high_rated", people.creators_of_high_rated, "people"),
    Question("genre_growth_by_decade", facets.facet_growth_by_decade, "facets"),
    Question("close_releases_by_director", relations.close_releases, "relations"),
    Question("last_acclaimed_title", relations.last_acclaimed_title, "relations"),
    Question("title_rank_positions", relations.title_rank_positions, "relations"),
    Question("title_subtotals", summaries.title_subtotals, "summaries"),
    Question("genre_decade_matrix", summaries.genre_decade_matrix, "summaries"),
    Question("genre_trailing_votes", summaries.genre_trailing_votes, "summaries"),
    Question("genre_vote_quantiles", summaries.genre_vote_quantiles, "summaries"),
    Question("character_list_quality", characters.character_list_quality, "characters"),
    Question("people_by_characters", characters.people_by_characters, "characters"),
    Question("director_source_differences", summaries.director_source_differences, "summaries"),
    Question("catalog_tables", profile.describe_catalog, "profile"),
    Question("catalog_profile", profile.profile_catalog, "profile"),
    Question("catalog_numeric_stats", profile.numeric_stats_catalog, "profile"),
    Question("catalog_column_stats", profile.column_stats_catalog, "profile"),
    Question("titles_by_type", profile.titles_by_type, "profile"),
    Question("catalog_key_violations", profile.key_violations, "profile"),
]

QUESTIONS: dict[str, Question] = {q.name: q for q in _QUESTIONS}


def question(name: str) -> Question:
    try:
        return QUESTIONS[name]
    except KeyError:
        raise KeyError(f"unknown question {name!r}; known: {sorted(QUESTIONS)}") from None

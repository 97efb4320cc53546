"""The catalogue questions, profiles and the batch runner."""

from titlelens.plans.characters import character_list_quality, malformed_character_lists, people_by_characters
from titlelens.plans.facets import (facet_growth_by_decade, facet_runtime_ranking,
                                    localized_language_counts, titles_per_category,
                                    top_titles_per_facet)
from titlelens.plans.people import (collaboration_pairs, creators_of_high_rated, improving_creators,
                                    lead_director_genre_counts, leaders_per_facet,
                                    most_credited_people, most_diverse_people,
                                    most_referenced_titles, release_gap_by_creator)
from titlelens.plans.profile import (describe_catalog, describe_table, key_violations, numeric_columns, numeric_stats,
                                     numeric_stats_catalog, preview, profile_catalog, table_profile)
from titlelens.plans.ratings import (rating_by_decade, rating_by_facet, top_rated_titles,
                                     top_titles_per_region, votes_by_year_with_running_avg)
from titlelens.plans.relations import close_releases, last_acclaimed_title, title_rank_positions
from titlelens.plans.series import avg_children_per_season, duplicate_titles, series_by_episode_count
from titlelens.plans.summaries import director_source_differences, genre_decade_matrix, genre_trailing_votes, genre_vote_quantiles, genre_vote_sketches, title_subtotals
from titlelens.plans.trends import adult_split_by_year, metric_trend_by_decade

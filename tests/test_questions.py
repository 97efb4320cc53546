"""One test per semantic trap of the questions, on tiny literal catalogues."""

import pytest

from titlelens.plans import (adult_split_by_year, avg_children_per_season, collaboration_pairs,
                             creators_of_high_rated, duplicate_titles, facet_growth_by_decade,
                             facet_runtime_ranking, improving_creators, lead_director_genre_counts,
                             leaders_per_facet, localized_language_counts, metric_trend_by_decade,
                             most_credited_people, most_diverse_people, most_referenced_titles,
                             rating_by_decade, rating_by_facet, release_gap_by_creator,
                             series_by_episode_count, titles_per_category, top_rated_titles,
                             top_titles_per_facet, top_titles_per_region,
                             votes_by_year_with_running_avg)

from conftest import rows


def movie(t, year=2000, genres="Drama", **kw):
    return {"tconst": t, "titleType": "movie", "primaryTitle": f"P{t}", "originalTitle": f"O{t}",
            "isAdult": 0, "startYear": year, "runtimeMinutes": 100, "genres": genres, **kw}


def person(n, name=None, prof="actor"):
    return {"nconst": n, "primaryName": name or f"N{n}", "primaryProfession": prof}


def test_top_rated_ties_and_vote_floor(make_catalog):
    cat = make_catalog(
        title_basics=[movie("t1"), movie("t2"), movie("t3"), {**movie("t4"), "titleType": "short"}],
        title_ratings=[{"tconst": "t1", "averageRating": 8.0, "numVotes": 20000},
                       {"tconst": "t2", "averageRating": 8.0, "numVotes": 30000},
                       {"tconst": "t3", "averageRating": 9.0, "numVotes": 9999},
                       {"tconst": "t4", "averageRating": 9.5, "numVotes": 50000}])
    assert rows(top_rated_titles(cat), "tconst") == [("t2",), ("t1",)]
    assert rows(top_rated_titles(cat, n=1), "tconst") == [("t2",)]


def test_most_credited_two_cuts_do_not_backfill(make_catalog):
    eps = [{"tconst": f"e{i}", "titleType": "tvEpisode"} for i in range(6)]
    credits = ([{"tconst": f"e{i}", "ordering": 1, "nconst": "nA", "category": "actor"} for i in range(3)]
               + [{"tconst": f"e{i}", "ordering": 2, "nconst": "nB", "category": "actress"} for i in range(2)]
               + [{"tconst": "e5", "ordering": 3, "nconst": "nC", "category": "actor"},
                  {"tconst": "e4", "ordering": 4, "nconst": "nD", "category": "director"}])
    cat = make_catalog(title_basics=eps, title_principals=credits,
                       name_basics=[person("nB"), person("nC")])  # nA has no name row
    # pool of 2 = {nA, nB}; nA is nameless and dropped; nC (3rd) is not pulled in
    out = most_credited_people(cat, pool=2, n=2)
    assert rows(out) == [("nB", "NnB", 2)]
    assert rows(most_credited_people(cat, pool=3, n=2)) == [("nB", "NnB", 2), ("nC", "NnC", 1)]


def test_rating_by_genre_counts_after_year_and_min_count(make_catalog):
    cat = make_catalog(
        title_basics=[movie("t1", 2011, "Drama,Comedy"), movie("t2", 2012, "Drama"),
                      movie("t3", 2010, "Drama"), movie("t4", 2015, None)],
        title_ratings=[{"tconst": t, "averageRating": r, "numVotes": 1}
                       for t, r in [("t1", 6.0), ("t2", 8.0), ("t3", 1.0), ("t4", 1.0)]])
    out = rows(rating_by_facet(cat, min_count=1))
    assert out == [("Drama", 7.0, 2), ("Comedy", 6.0, 1)]
    assert rows(rating_by_facet(cat, min_count=2)) == [("Drama", 7.0, 2)]


def _director_catalog(make_catalog, year_ratings, name=True, director="nm1"):
    basics, ratings, crew = [], [], []
    for i, (year, rating) in enumerate(year_ratings):
        t = f"t{i}"
        basics.append(movie(t, year))
        ratings.append({"tconst": t, "averageRating": rating, "numVotes": 5000})
        crew.append({"tconst": t, "directors": director})
    names = [person("nm1", "Dir One")] if name else []
    return make_catalog(title_basics=basics, title_ratings=ratings, title_crew=crew, name_basics=names)


def test_improving_needs_three_transitions(make_catalog):
    three = _director_catalog(make_catalog, [(2000, 5.0), (2001, 6.0), (2002, 7.0)])
    assert improving_creators(three).count() == 0  # only 2 transitions
    four = _director_catalog(make_catalog, [(2000, 5.0), (2001, 6.0), (2002, 5.5), (2003, 8.0)])
    (r,) = rows(improving_creators(four))
    assert r[0] == "nm1" and r[1] == "Dir One" and r[3] == 3
    assert r[2] == pytest.approx((8.0 - 5.0) / 3)


def test_improving_null_year_first_and_same_year_averaged(make_catalog):
    cat = _director_catalog(make_catalog, [(None, 2.0), (2000, 5.0), (2000, 7.0), (2001, 6.0), (2002, 7.0)])
    (r,) = rows(improving_creators(cat))
    # years: null(2.0), 2000(avg 6.0), 2001(6.0), 2002(7.0) -> mean step (7-2)/3
    assert r[3] == 3 and r[2] == pytest.approx(5.0 / 3)


def test_improving_excludes_declining_and_nameless(make_catalog):
    down = _director_catalog(make_catalog, [(2000, 8.0), (2001, 7.0), (2002, 6.0), (2003, 5.0)])
    assert improving_creators(down).count() == 0
    nameless = _director_catalog(make_catalog, [(2000, 5.0), (2001, 6.0), (2002, 7.0), (2003, 8.0)], name=False)
    assert improving_creators(nameless).count() == 0


def test_improving_null_average_matches_window_semantics(make_catalog):
    # a year whose only rating is null breaks the chain: steps are counted
    # when the previous average is known, differences only when both are
    cat = _director_catalog(make_catalog, [(2000, 5.0), (2001, None), (2002, 6.0), (2003, 7.0),
                                           (2004, 9.0)])
    (r,) = rows(improving_creators(cat))
    # window: prev known for 2001(5.0), 2003(6.0), 2004(7.0) -> 3 rows;
    # non-null steps 2003: +1, 2004: +2 -> mean 1.5
    assert r[3] == 3 and r[2] == pytest.approx(1.5)


def test_language_counts_aka_rows_not_titles(make_catalog):
    cat = make_catalog(
        title_basics=[movie("t1"), {**movie("t2"), "titleType": "short"}],
        title_akas=[{"titleId": "t1", "ordering": i, "language": lang}
                    for i, lang in enumerate(["fr", "fr", "en", None, "de"])]
        + [{"titleId": "t2", "ordering": 1, "language": "ja"}])
    assert rows(localized_language_counts(cat)) == [("fr", 2), ("de", 1)]


def test_runtime_by_decade_truncation_and_lag(make_catalog):
    cat = make_catalog(title_basics=[
        movie("a", 1900, runtimeMinutes=500), movie("b", 1901, runtimeMinutes=100),
        movie("c", 1909, runtimeMinutes=50), movie("d", 1925, runtimeMinutes=150),
        movie("e", 1926, runtimeMinutes=0), movie("f", 1950, runtimeMinutes=None)])
    out = rows(metric_trend_by_decade(cat))
    assert out == [(1900, 75.0, 2, None, None, None), (1920, 150.0, 1, 75.0, 75.0, 100.0)]


def test_lead_director_groups_by_whole_list(make_catalog):
    cat = make_catalog(
        title_basics=[movie("t1", genres="Drama,Comedy"), movie("t2", genres="Drama"),
                      movie("t3", genres="Drama,Comedy"), movie("t4", genres=None)],
        title_crew=[{"tconst": "t1", "directors": "nm1,nm2"}, {"tconst": "t2", "directors": "nm1"},
                    {"tconst": "t3", "directors": "nm1"}, {"tconst": "t4", "directors": "nm1"}],
        name_basics=[person("nm1", "Ann")])
    out = rows(lead_director_genre_counts(cat))
    # (Drama,Comedy | nm1) = 2, (Drama | nm1) = 1: same shown pair twice
    assert out == [("Drama", "Ann", 2), ("Drama", "Ann", 1)]


def test_collaboration_only_single_ids_match_and_names_group(make_catalog):
    cat = make_catalog(
        title_basics=[movie(f"t{i}") for i in range(5)] + [movie("t9", None)],
        title_crew=[{"tconst": "t0", "directors": "nm1", "writers": "nm2"},
                    {"tconst": "t1", "directors": "nm1", "writers": "nm3"},   # nm3 homonym of nm2
                    {"tconst": "t2", "directors": "nm1,nm4", "writers": "nm2"},  # multi: no match
                    {"tconst": "t3", "directors": "nm1", "writers": "nm5"},   # same name as director
                    {"tconst": "t4", "directors": "nm1", "writers": "nm6"},   # writer nameless
                    {"tconst": "t9", "directors": "nm1", "writers": "nm2"}],  # no year
        name_basics=[person("nm1", "D"), person("nm2", "W"), person("nm3", "W"), person("nm5", "D")])
    assert rows(collaboration_pairs(cat)) == [("D", "W", 2)]


def test_top_titles_per_genre_keeps_rank_ties(make_catalog):
    basics = [movie(f"t{i}", genres="Drama") for i in range(4)]
    votes = [5000, 4000, 4000, 3000]
    cat = make_catalog(title_basics=basics, title_ratings=[
        {"tconst": f"t{i}", "averageRating": 5.0, "numVotes": v} for i, v in enumerate(votes)])
    out = rows(top_titles_per_facet(cat, k=2), "primaryTitle", "genre_rank")
    assert out == [("Pt0", 1), ("Pt1", 2), ("Pt2", 2)]


def test_genre_runtime_truncates(make_catalog):
    cat = make_catalog(title_basics=[
        movie("a", genres="X", runtimeMinutes=19), movie("b", genres="X", runtimeMinutes=20),
        movie("c", genres="Y", runtimeMinutes=10), movie("d", genres="Y", runtimeMinutes=999),
        movie("e", genres="Y", runtimeMinutes=1000), movie("f", genres="Z", runtimeMinutes=11)])
    out = {r.genre: r for r in facet_runtime_ranking(cat).collect()}
    # X: avg 19.5 -> 19; Y: (10+999)/2 = 504.5 -> 504; Z: 11; global (19+504+11)/3 = 178
    assert out["X"].avg_runtime == 19 and out["Y"].avg_runtime == 504 and out["Z"].avg_runtime == 11
    assert {r.global_avg_runtime for r in out.values()} == {178}
    assert out["X"].percentage_diff == int((19 - 178) * 100 / 178)  # toward zero: -89
    assert out["X"].percentage_diff == -89 and out["Y"].runtime_rank == 1
    assert out["X"].popularity_rank == 1 and out["Y"].popularity_rank == 1 and out["Z"].popularity_rank == 2


def test_adult_split_unknown_year_rows(make_catalog):
    cat = make_catalog(title_basics=[
        {"tconst": "a", "isAdult": 1, "startYear": None}, {"tconst": "b", "isAdult": 0, "startYear": None},
        {"tconst": "c", "isAdult": 0, "startYear": 2000}, {"tconst": "d", "isAdult": 1, "startYear": 2030},
        {"tconst": "e", "isAdult": None, "startYear": 1999}])
    out = sorted(rows(adult_split_by_year(cat)))
    assert out == [(0, 0, 1), (0, 1, 0), (2000, 0, 1)]
    merged = sorted(rows(adult_split_by_year(cat, merge_unknown_year=True)))
    assert merged == [(0, 1, 1), (2000, 0, 1)]


def test_titles_per_category_exact_and_approx(make_catalog):
    credits = [{"tconst": f"t{i % 7}", "ordering": i, "nconst": "n", "category": "actor"} for i in range(30)]
    credits += [{"tconst": "t1", "ordering": 99, "nconst": "n", "category": None}]
    cat = make_catalog(title_principals=credits)
    assert rows(titles_per_category(cat, exact=True)) == [("actor", 7)]
    assert rows(titles_per_category(cat)) == [("actor", 7)]


def test_most_referenced_substring_and_dangling(make_catalog):
    cat = make_catalog(
        title_basics=[movie("tt1")],
        name_basics=[{"nconst": "a", "primaryProfession": "actor,producer", "knownForTitles": "tt1,tt9"},
                     {"nconst": "b", "primaryProfession": "actress", "knownForTitles": "tt1"},
                     {"nconst": "c", "primaryProfession": "director", "knownForTitles": "tt1"},
                     {"nconst": "d", "primaryProfession": "actor", "knownForTitles": None}])
    assert rows(most_referenced_titles(cat)) == [("tt1", "Ptt1", 2000, 2), ("tt9", None, None, 1)]


def test_episodes_per_season_by_series_year(make_catalog):
    cat = make_catalog(
        title_basics=[{"tconst": "s1", "titleType": "tvSeries", "startYear": 1995},
                      {"tconst": "s2", "titleType": "tvSeries", "startYear": 1995},
                      {"tconst": "s3", "titleType": "tvSeries", "startYear": 1980}],
        title_episode=[{"tconst": f"e{i}", "parentTconst": p, "seasonNumber": s}
                       for i, (p, s) in enumerate([("s1", 1), ("s1", 1), ("s1", 2), ("s2", 1),
                                                   ("s2", None), ("s3", 1), ("zz", 1)])])
    # s1: seasons 1 (2 eps), 2 (1 ep); s2: season 1 (1 ep) -> mean (2+1+1)/3
    assert rows(avg_children_per_season(cat)) == [(1995, pytest.approx(4 / 3))]


def test_release_gap_closed_form(make_catalog):
    basics = [movie(f"t{i}", y) for i, y in enumerate([2000, 2003, 2003, 2010, 1990])]
    crew = [{"tconst": f"t{i}", "directors": d} for i, d in
            enumerate(["nm1", "nm1", "nm1,nm2", "nm1", "nm3"])]
    cat = make_catalog(title_basics=basics, title_crew=crew, name_basics=[person("nm1", "Ann")])
    # nm1: 2000, 2003, 2003, 2010 -> (2010-2000)/3; nm2, nm3: single title -> dropped
    assert rows(release_gap_by_creator(cat)) == [("nm1", "Ann", 4, pytest.approx(10 / 3))]


def test_votes_running_average_of_yearly_means(make_catalog):
    cat = make_catalog(
        title_basics=[{"tconst": t, "titleType": "short", "startYear": y} for t, y in
                      [("a", 2000), ("b", 2000), ("c", 2001), ("d", 2002), ("e", None)]],
        title_ratings=[{"tconst": t, "averageRating": r, "numVotes": v} for t, r, v in
                       [("a", 8.0, 100), ("b", 9.0, 300), ("c", 7.6, 50), ("d", 7.5, 999), ("e", 9.0, 1)]])
    assert rows(votes_by_year_with_running_avg(cat)) == [(2000, 200.0, 200.0), (2001, 50.0, 125.0)]


def test_duplicate_titles_excludes_episodes_and_nulls(make_catalog):
    cat = make_catalog(
        title_basics=[{"tconst": t, "primaryTitle": p} for t, p in
                      [("a", "X"), ("b", "X"), ("c", "X"), ("d", "Y"), ("e", "Y"), ("f", None), ("g", None)]],
        title_episode=[{"tconst": "e", "parentTconst": "s"}])
    assert rows(duplicate_titles(cat)) == [("X", 3)]


def test_series_by_episode_count_series_only(make_catalog):
    cat = make_catalog(
        title_basics=[{"tconst": "s1", "titleType": "tvSeries", "primaryTitle": "S1"},
                      {"tconst": "m1", "titleType": "tvMiniSeries", "primaryTitle": "M1"}],
        title_episode=[{"tconst": f"e{i}", "parentTconst": p} for i, p in enumerate(["s1", "s1", "m1", "m1", "m1"])])
    assert rows(series_by_episode_count(cat)) == [("S1", 2)]


def _acting(make_catalog):
    basics = [movie("t1", genres="Drama,Comedy"), movie("t2", genres="Drama"), movie("t3", genres="Horror")]
    credits = [{"tconst": t, "ordering": i, "nconst": n, "category": c} for i, (t, n, c) in enumerate([
        ("t1", "a", "actor"), ("t2", "a", "actor"), ("t1", "b", "actress"), ("t2", "b", "actress"),
        ("t3", "c", "actor"), ("t3", "d", "actor"), ("t3", "e", "director")])]
    names = [person("a", "Same"), person("b", "Other"), person("c", "Same"), person("d", "Dee")]
    return make_catalog(title_basics=basics, title_principals=credits, name_basics=names)


def test_leaders_per_genre_dense_rank_ties_and_homonyms(make_catalog):
    out = sorted(rows(leaders_per_facet(_acting(make_catalog))))
    assert out == [("Comedy", "Other", 1, 1), ("Comedy", "Same", 1, 1), ("Drama", "Other", 2, 1),
                   ("Drama", "Same", 2, 1), ("Horror", "Dee", 1, 1), ("Horror", "Same", 1, 1)]


def test_most_diverse_people(make_catalog):
    assert rows(most_diverse_people(_acting(make_catalog))) == [
        ("Same", 2), ("Other", 2), ("Same", 1), ("Dee", 1)]


def test_creators_of_high_rated_threshold_and_left_join(make_catalog):
    cat = make_catalog(
        title_basics=[movie("t1"), movie("t2"), movie("t3")],
        title_ratings=[{"tconst": "t1", "averageRating": 8.5, "numVotes": 1},
                       {"tconst": "t2", "averageRating": 9.0, "numVotes": 1},
                       {"tconst": "t3", "averageRating": 8.4, "numVotes": 1}],
        title_crew=[{"tconst": "t1", "directors": "nm1,nm2"}, {"tconst": "t2", "directors": "nm1"},
                    {"tconst": "t3", "directors": "nm2"}],
        name_basics=[person("nm1", "Ann")])
    assert rows(creators_of_high_rated(cat)) == [("Ann", 2), (None, 1)]


def test_rating_by_decade_four_digit_years(make_catalog):
    cat = make_catalog(
        title_basics=[{"tconst": t, "startYear": y} for t, y in [("a", 1995), ("b", 1999), ("c", 999), ("d", 2001)]],
        title_ratings=[{"tconst": t, "averageRating": 6.0, "numVotes": 1} for t in "abcd"])
    assert rows(rating_by_decade(cat)) == [(1990, 6.0, 2), (2000, 6.0, 1)]


def test_top_per_region_dedupes_and_breaks_ties(make_catalog):
    basics = [movie(f"t{i}") for i in range(5)]
    ratings = [{"tconst": f"t{i}", "averageRating": r, "numVotes": v}
               for i, (r, v) in enumerate([(9.0, 2000), (8.0, 3000), (8.0, 3000), (7.0, 1000), (9.9, 999)])]
    akas = [{"titleId": t, "ordering": i, "region": reg} for i, (t, reg) in enumerate([
        ("t0", "US"), ("t0", "US"), ("t1", "US"), ("t2", "US"), ("t3", "US"), ("t4", "US"), ("t3", None)])]
    cat = make_catalog(title_basics=basics, title_ratings=ratings, title_akas=akas)
    out = rows(top_titles_per_region(cat), "primaryTitle", "region", "rank")
    assert out == [("Pt0", "US", 1), ("Pt1", "US", 2), ("Pt2", "US", 3)]


def test_genre_growth_lag_over_present_decades(make_catalog):
    cat = make_catalog(title_basics=[movie(f"t{i}", y, g) for i, (y, g) in enumerate([
        (1991, "Drama"), (2005, "Drama"), (2006, "Drama"), (2021, "Drama"), (1985, "Drama"), (2001, "Horror")])])
    out = rows(facet_growth_by_decade(cat))
    assert out == [(2000, "Drama", 2, 1, 1), (2020, "Drama", 1, 2, -1), (1990, "Drama", 1, None, None),
                   (2000, "Horror", 1, None, None)]


def test_leaders_by_id_keeps_homonyms_apart(make_catalog):
    out = sorted(rows(leaders_per_facet(_acting(make_catalog), by="id")))
    assert ("Horror", "c", "Same", 1, 1) in out and ("Horror", "d", "Dee", 1, 1) in out
    assert ("Drama", "a", "Same", 2, 1) in out and ("Drama", "b", "Other", 2, 1) in out
    with pytest.raises(ValueError):
        leaders_per_facet(_acting(make_catalog), by="title")

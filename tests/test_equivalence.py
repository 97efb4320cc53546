"""The plans' rewrites agree with their definitions on random inputs: the
expected side is plain Python over the generated rows."""

from collections import defaultdict
from statistics import mean

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titlelens.functions import decade_of, is_four_digit_year
from titlelens.plans import adult_split_by_year, improving_creators, release_gap_by_creator
from titlelens.plans.common import ACTING

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

directors = st.sampled_from(["nm1", "nm2", "nm3", "nm1,nm2", "nm2,nm3"])
years = st.one_of(st.none(), st.integers(1990, 1996))
ratings = st.sampled_from([1.0, 2.5, 5.1, 6.7, 7.2, 9.9])
titles = st.lists(st.tuples(directors, years, ratings), min_size=1, max_size=40)


def _catalog(make_catalog, rows):
    basics, crew, rats = [], [], []
    for i, (d, y, r) in enumerate(rows):
        t = f"t{i}"
        basics.append({"tconst": t, "titleType": "movie", "startYear": y})
        crew.append({"tconst": t, "directors": d})
        rats.append({"tconst": t, "averageRating": r, "numVotes": 5000})
    names = [{"nconst": n, "primaryName": n.upper()} for n in ("nm1", "nm2", "nm3")]
    return make_catalog(title_basics=basics, title_crew=crew, title_ratings=rats, name_basics=names)


def _steps(by_year):
    """Yearly means in order of year, the unknown one first, paired with the next."""
    order = sorted(by_year, key=lambda y: (y is not None, y))
    values = [mean(by_year[y]) for y in order]
    return [b - a for a, b in zip(values, values[1:])]


def _improving(rows):
    seen = defaultdict(lambda: defaultdict(list))
    for people, year, rating in rows:
        for person in people.split(","):
            seen[person][year].append(rating)
    steps = {person: _steps(by_year) for person, by_year in seen.items()}
    return {p: (round(mean(x), 9), len(x)) for p, x in steps.items() if len(x) >= 3 and mean(x) > 1e-9}


@SETTINGS
@given(titles)
def test_improving_telescoped_equals_window(make_catalog, rows):
    cat = _catalog(make_catalog, rows)
    got = {r.director_id: (round(r.avg_rating_trend, 9), r.years_with_movies)
           for r in improving_creators(cat).collect() if r.avg_rating_trend > 1e-9}
    want = _improving(rows)
    assert got.keys() == want.keys()
    for person, (trend, years) in want.items():
        assert abs(got[person][0] - trend) < 1e-6 and got[person][1] == years


@SETTINGS
@given(st.lists(st.tuples(directors, st.integers(1950, 2020)), min_size=1, max_size=40))
def test_release_gap_closed_form_equals_lag(make_catalog, rows):
    cat = _catalog(make_catalog, [(d, y, 5.0) for d, y in rows])
    seen = defaultdict(list)
    for people, year in rows:
        for person in people.split(","):
            seen[person].append(year)
    want = {}
    for person, found in seen.items():
        found.sort()
        if len(found) > 1:
            want[person] = (len(found), sum(b - a for a, b in zip(found, found[1:])) / (len(found) - 1))
    got = {r.director: (r.movieCount, r.averageGap) for r in release_gap_by_creator(cat).collect()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 1)), st.one_of(st.none(), st.integers(2020, 2027))),
                min_size=1, max_size=30))
def test_adult_split_one_pass_equals_outer_join(make_catalog, spark, rows):
    cat = make_catalog(title_basics=[{"tconst": f"t{i}", "isAdult": a, "startYear": y}
                                     for i, (a, y) in enumerate(rows)])
    count = {flag: defaultdict(int) for flag in (0, 1)}
    unknown = []
    for flag, year in rows:
        if flag is not None and year is not None and year <= 2025:
            count[flag][year] += 1
        elif flag is not None and year is None:
            unknown.append(flag)
    want = [(y, count[1][y], count[0][y]) for y in set(count[0]) | set(count[1])]
    # titles without a year: one row of year 0 for each kind, as nulls never meet in the outer join
    want += [(0, unknown.count(1), 0)] * (1 in unknown) + [(0, 0, unknown.count(0))] * (0 in unknown)
    key = lambda r: (r.startYear, r.adult_count, r.non_adult_count)
    assert sorted(map(key, adult_split_by_year(cat).collect())) == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2", "t3", "t4"]), st.sampled_from(["n1", "n2", "n3"])),
                min_size=1, max_size=30))
def test_count_distinct_equals_size_of_collect_set(make_catalog, rows):
    genres = {"t1": "Drama,Comedy", "t2": "Drama", "t3": "Horror,Drama,Western", "t4": "Comedy"}
    cat = make_catalog(
        title_basics=[{"tconst": t, "titleType": "movie", "genres": g} for t, g in genres.items()],
        title_principals=[{"tconst": t, "ordering": i, "nconst": n, "category": "actor"}
                          for i, (t, n) in enumerate(rows)])
    x = cat.title_basics.withColumn("genre", F.explode(F.split("genres", ","))).join(
        cat.title_principals.where(F.col("category").isin(*ACTING)), "tconst")
    a = {r.nconst: r.c for r in x.groupBy("nconst").agg(F.size(F.collect_set("genre")).alias("c")).collect()}
    b = {r.nconst: r.c for r in x.groupBy("nconst").agg(F.count_distinct("genre").alias("c")).collect()}
    assert a == b


def test_four_digit_year_equals_regex(spark):
    df = spark.createDataFrame([(y,) for y in [None, -1234, 0, 7, 999, 1000, 1999, 9999, 10000, 123456]], "y int")
    out = df.select(is_four_digit_year("y").alias("a"),
                    (F.col("y").isNotNull() & F.col("y").cast("string").rlike("^[0-9]{4}$")).alias("b"),
                    decade_of("y").alias("d")).collect()
    assert all(bool(r.a) == bool(r.b) for r in out)
    assert [r.d for r in out][:5] == [None, -1230, 0, 0, 990]

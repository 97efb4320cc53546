"""Subtotals, wide counts, trailing ranges and multiset comparisons on small frames, against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from titlelens.operators import compare_by_key, multiset_counts, subtotals, to_wide, trailing_sums
from titlelens.plans import genre_decade_matrix, title_subtotals

from conftest import rows


def test_subtotals(spark):
    rng = random.Random(1)
    data = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([None, [], ["g"], ["g", "h"], ["h", "h"], ["g", None, "g"]]), rng.randrange(5)) for _ in range(200)]
    df = spark.createDataFrame(data, "a string, b int, m array<string>, v long")
    sets = [("a", "b", "m"), ("a", "m"), ("a",), ()]
    want = defaultdict(lambda: [0, 0])
    for a, b, m, v in data:
        for s in sets:
            for one in (dict.fromkeys(m) if m else [None]) if "m" in s else [None]:
                key = (a if "a" in s else None, b if "b" in s else None, one, sum(w for c, w in (("a", 4), ("b", 2), ("m", 1)) if c not in s))
                want[key][0] += 1
                want[key][1] += v
    got = subtotals(df, ["a", "b"], "m", sets, {"n": F.lit(1).cast("long"), "s": F.col("v")})
    assert {r[:4]: list(r[4:]) for r in rows(got, "a", "b", "m", "grouping_id", "n", "s")} == want and got.count() == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.index("posexplode")  # printed from the top: copies are made of groups, not of rows
    assert rows(subtotals(df.limit(0), ["a", "b"], "m", [("a",)], {"n": F.lit(1)})) == []
    with pytest.raises(ValueError):
        subtotals(df, ["a"], "m", [("z",)], {"n": F.lit(1)})


def test_null_keys_are_no_subtotals(make_catalog):
    cat = make_catalog(title_basics=[{"tconst": "a", "titleType": "movie", "startYear": 1999, "genres": "Drama,War"}, {"tconst": "b", "titleType": "movie"}],
                       title_ratings=[{"tconst": "a", "averageRating": 5.0, "numVotes": 7}])
    got = {r[:4]: r[4:] for r in rows(title_subtotals(cat))}
    assert got[("movie", None, None, 3)] == (2, 1, 7)  # all years and genres
    assert got[("movie", None, None, 0)] == (1, 0, 0)  # no year, no genre
    assert got[(None, None, "Drama", 6)] == got[(None, None, "War", 6)] == (1, 1, 7) and got[(None, None, None, 7)] == (2, 1, 7)


def test_wide_counts_every_row(spark, make_catalog):
    data = [("a", 1), ("a", 1), ("a", 9), ("a", None), (None, 2), ("b", None)]
    df = spark.createDataFrame(data, "k string, v int")
    got = to_wide(df, "k", "v", [1, 2], "n_")
    assert got.columns == ["k", "n_1", "n_2", "n_other", "n_missing"]
    assert sorted(rows(got), key=repr) == sorted([("a", 2, 0, 1, 1), ("b", 0, 0, 0, 1), (None, 0, 1, 0, 0)], key=repr)
    assert to_wide(df.limit(0), "k", "v", [1, 2], "n_").count() == 0
    for bad in ([1, 1], ["other"]):
        with pytest.raises(ValueError):
            to_wide(df, "k", "v", bad, "n_")
    cat = make_catalog(title_basics=[{"tconst": str(k), "titleType": "movie", "startYear": y, "genres": "War"} for k, y in enumerate([1949, 1950, 2029, 2030, None])])
    assert rows(genre_decade_matrix(cat)) == [("War", 1, 0, 0, 0, 0, 0, 0, 1, 2, 1)]


@pytest.mark.parametrize("span", [1, 5])
def test_trailing_range_is_of_values(spark, span):
    data = [(k, y, k_ * y % 7) for k_, k in enumerate(["a", "b", None]) for y in (1990, 1991, 1995, 1996, 1999, 2010)] + [("b", 1996, 50), ("a", None, 3)]
    got = trailing_sums(spark.createDataFrame(data, "k string, y int, v int"), ["k"], "y", span, ["v"])

    def near(k, y):
        return [w for o, z, w in data if o == k and (z is None if y is None else z is not None and y - span < z <= y)]

    assert sorted(rows(got, "k", "y", "v", "trailing_points", "trailing_v"), key=repr) == sorted(((k, y, v, len(near(k, y)), sum(near(k, y))) for k, y, v in data), key=repr)


def test_multisets(spark):
    rng = random.Random(3)
    pick = lambda n: [(rng.choice([*"abcdefgh", None]), rng.choice([1, 2, None])) for _ in range(n)]
    a, b = pick(25) + [("x", 1), ("y", 1), ("y", 1), ("z", 3)], pick(20) + [("x", 1), ("y", 1), ("w", 2)]
    old, new = (spark.createDataFrame(x, "k string, v int") for x in (a, b))
    ca, cb = Counter(a), Counter(b)
    assert {r[:2]: r[2:] for r in rows(multiset_counts(old, new.select("v", "k")))} == {r: (ca[r], cb[r]) for r in ca.keys() | cb.keys()}
    got = {r.k: r for r in compare_by_key(old, new, ["k"]).collect()}
    assert set(got) == {k for k, _ in a + b}
    for k, r in got.items():
        x, y = (Counter({r: n for r, n in c.items() if r[0] == k}) for c in (ca, cb))
        assert (r.old_rows, r.new_rows, r.common_rows, r.only_old, r.only_new) == tuple(c.total() for c in (x, y, x & y, x - y, y - x))
        assert r.status == ("added" if not x else "removed" if not y else "same" if x == y else "recounted" if set(x) == set(y) else "changed")
    assert (got["x"].status, got["y"].status, got["z"].status, got["w"].status) == ("same", "recounted", "removed", "added")
    assert compare_by_key(old, new.limit(0), ["k"]).where("status != 'removed'").count() == 0
    with pytest.raises(ValueError):
        multiset_counts(old, new.drop("v"))

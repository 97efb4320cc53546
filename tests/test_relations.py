"""Band join, as-of join and global ranks on small frames, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from titlelens.operators import asof_join, band_join, global_ranks
from titlelens.plans import close_releases, last_acclaimed_title

from conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("band", [0, 1, 2, 5])
def test_band_join(spark, band):
    rng = random.Random(band)
    a = [(rng.choice("abc"), rng.randrange(-20, 20), k) for k in range(80)] + [(None, 3, 100), ("a", None, 101)]
    b = [(rng.choice("abc"), rng.randrange(-20, 20), k) for k in range(80)] + [(None, 3, 200), ("a", None, 201)]
    left, right = (spark.createDataFrame(x, "k string, v int, no int") for x in (a, b))
    got = band_join(left, right, ["k"], "v", band)
    want = sorted((k, v, i, w, j) for k, v, i in a for o, w, j in b if k is not None and k == o and v is not None and w is not None and 0 <= w - v <= band)
    assert sorted(rows(got, "k", "v", "no", "v_other", "no_other")) == want
    strict = band_join(left, right, ["k"], "v", band, strict=True)
    assert sorted(rows(strict, "k", "v", "no", "v_other", "no_other")) == [x for x in want if x[1] != x[3]]
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_asof_join(spark):
    rng = random.Random(4)
    a = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(1990, 2030)]), f"t{k}") for k in range(150)]
    b = [(rng.choice(["a", "b", None]), rng.choice([None, *range(1985, 2025)]), f"r{k}") for k in range(60)]
    left, right = (spark.createDataFrame(x, "k string, year int, id string") for x in (a, b))

    def last(k, y):
        return max(((w, j) for o, w, j in b if k is not None and y is not None and o == k and w is not None and w < y), default=(None, None))

    want = sorted(((k, y, i, *last(k, y)[::-1]) for k, y, i in a), key=repr)
    for width in (1, 7, 1000):
        got = asof_join(left, right, ["k"], "year", "id", ["id", "year"], bin_width=width)
        assert sorted(rows(got, "k", "year", "id", "prev_id", "prev_year"), key=repr) == want
    assert asof_join(left, right.limit(0), ["k"], "year", "id", ["id"]).where("prev_id is not null").count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_global_ranks(spark, descending):
    rng = random.Random(6)
    data = [(k, rng.choice([None, 1.5, 2.0, 2.5, 9.0]), rng.choice([None, 1, 2, 3, 100, 1000])) for k in range(200)] + [(k, 2.0, 3) for k in range(200, 300)]
    df = spark.createDataFrame(data, "id int, r float, v int")
    got = global_ranks(df, ["r", "v"], [F.col("r"), F.floor(F.col("v") / 10)], 7, descending).collect()
    key = lambda x: tuple((c is None, 0 if c is None else -c if descending else c) for c in x)
    keys = sorted(key(x[1:]) for x in data)
    distinct = sorted(set(keys))
    assert len(got) == len(data)
    for r in got:
        k = key((r.r, r.v))
        before, upto = sum(o < k for o in keys), sum(o <= k for o in keys)
        assert (r.rank, r.dense_rank, r.tile) == (before + 1, distinct.index(k) + 1, before * 7 // len(keys) + 1)
        assert r.percent_rank == before / (len(keys) - 1) and r.cume_dist == upto / len(keys)
    one = global_ranks(df.limit(1), ["r", "v"], [F.col("r")]).first()
    assert (one["rank"], one.percent_rank, one.cume_dist, one.tile) == (1, 0.0, 1.0, 1)


def _movies(make_catalog, credits, votes=()):
    return make_catalog(title_basics=[{"tconst": t, "titleType": "movie", "startYear": y} for t, y, _ in credits],
                        title_crew=[{"tconst": t, "directors": d} for t, _, d in credits],
                        title_ratings=[{"tconst": t, "averageRating": 5.0, "numVotes": v} for t, v in votes])


def test_close_releases_of_a_hot_creator(make_catalog):
    """20,000 titles of one creator meet as counts of their years, not as pairs."""
    credits = [(f"t{k}", 1950 + k % 50, "hot") for k in range(20_000)] + [("a", 2000, "x"), ("b", 2002, "x"), ("c", 2005, "x,y")]
    got = rows(close_releases(_movies(make_catalog, credits)), "creator", "title_count", "close_pairs")
    assert got == [("hot", 20_000, 50 * 400 * 399 // 2 + (49 + 48) * 400 * 400), ("x", 3, 1)]


def test_last_acclaimed_title(make_catalog):
    credits = [("a", 2000, "d"), ("b", 2000, "d"), ("c", 2001, "d"), ("e", 2015, "d,f"), ("g", 2016, "f")]
    cat = _movies(make_catalog, credits, [("a", 5000), ("b", 1000), ("c", 999), ("e", 1000)])
    got = rows(last_acclaimed_title(cat), "creator", "tconst", "prev_tconst", "years_since")
    assert sorted(got, key=repr) == sorted([("d", "a", None, None), ("d", "b", None, None), ("d", "c", "b", 1), ("d", "e", "b", 15), ("f", "e", None, None), ("f", "g", "e", 1)], key=repr)

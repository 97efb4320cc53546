import pytest

from titlelens.plans.batch import run_reports
from titlelens.plans.profile import (key_violations, numeric_columns, numeric_stats,
                                     profile_catalog, table_profile)

from conftest import rows


def test_table_profile_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, None, 3.0), (3, "x", None)], "a int, b string, c double")
    out = rows(table_profile(df, "t"))
    assert out == [("t", "a", 1, "int", True, 3, 1), ("t", "b", 2, "string", True, 3, 2),
                   ("t", "c", 3, "double", True, 3, 1)]


def test_numeric_stats_typed_and_picker(spark):
    df = spark.createDataFrame([(1, 10, 2.0, "a"), (3, 20, 4.0, "b")], "a int, big bigint, c double, s string")
    assert numeric_columns(df) == ["a", "c"]
    assert numeric_columns(df, types=("int", "double", "bigint")) == ["a", "big", "c"]
    out = {r.column_name: r for r in numeric_stats(df, table="t").collect()}
    assert out["a"]["count"] == 2 and out["a"].mean == 2.0 and out["a"].min == 1.0 and out["a"].max == 3.0
    assert out["c"].stddev == pytest.approx(2 ** 0.5)
    with pytest.raises(ValueError):
        numeric_stats(df.select("s"))


def test_profile_catalog_and_key_violations(make_catalog):
    cat = make_catalog(title_basics=[{"tconst": "a"}, {"tconst": "a"}, {"tconst": None}, {"tconst": "b"}])
    prof = profile_catalog(cat)
    assert prof.where("table_name = 'title.basics' AND column_name = 'tconst'").collect()[0].null_count == 1
    kv = {r.table_name: r for r in key_violations(cat).collect()}
    assert (kv["title.basics"].null_keys, kv["title.basics"].duplicated_keys,
            kv["title.basics"].rows_with_duplicated_keys) == (1, 1, 2)
    assert kv["title.ratings"].null_keys == 0


def test_run_reports_isolates_failures(spark, make_catalog, tmp_path):
    cat = make_catalog(title_basics=[{"tconst": "t", "titleType": "movie", "primaryTitle": "X", "startYear": 2000}])
    status = {r.question: r for r in run_reports(
        spark, cat, str(tmp_path), ["duplicate_titles", "top_rated_titles", "no_such_question"]).collect()}
    assert status["duplicate_titles"].status == "ok" and status["top_rated_titles"].status == "ok"
    assert status["no_such_question"].status == "failed" and "no_such_question" in status["no_such_question"].error
    assert (tmp_path / "top_rated_titles").exists()


def test_run_reports_params(spark, make_catalog, tmp_path):
    cat = make_catalog(title_basics=[{"tconst": f"t{i}", "primaryTitle": "X"} for i in range(3)])
    run_reports(spark, cat, str(tmp_path), ["duplicate_titles"], fmt="parquet",
                params={"duplicate_titles": {"n": 1}})
    assert rows(spark.read.parquet(str(tmp_path / "duplicate_titles"))) == [("X", 3)]


def test_describe_table_and_preview(spark):
    from titlelens.plans import describe_table, preview
    df = spark.createDataFrame([(i, str(i)) for i in range(12)], "a int, b string")
    (r,) = describe_table(df, "t").collect()
    assert (r.table_name, r.column_count, r.row_count) == ("t", 2, 12)
    assert r.schema_ddl == "a INT,b STRING"
    assert preview(df).count() == 5


def test_check_session_flags_disabled_skew_handling(spark):
    from titlelens.session import check_session
    assert check_session(spark) == []
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert any("skewJoin" in w for w in check_session(spark))
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_profiles_of_an_incomplete_catalogue_raise(spark, tmp_path, make_catalog, capsys):
    from titlelens.__main__ import main
    from titlelens.catalog import MissingTableError
    from titlelens.plans.profile import column_stats_catalog, describe_catalog, numeric_stats_catalog
    from titlelens.sources import read_catalog
    make_catalog(title_ratings=[{"tconst": "t", "averageRating": 5.0, "numVotes": 3}]).title_ratings.write.parquet(
        str(tmp_path / "c" / "title.ratings.parquet"))
    cat = read_catalog(spark, str(tmp_path / "c"), fmt="parquet")
    assert len(cat.missing) == 6
    for profile in (profile_catalog, describe_catalog, numeric_stats_catalog, column_stats_catalog, key_violations):
        with pytest.raises(MissingTableError):
            profile(cat)
        assert profile(cat, tables=["title.ratings"]).count() > 0
    for command in (["profile"], ["run", "--only", "votes_by_year_running_avg"]):
        assert main([*command, "--catalog", str(tmp_path / "c"), "--out", str(tmp_path / "o")]) == 1
        assert "missing table: title.basics" in capsys.readouterr().err


def test_unreadable_table_is_an_error_not_a_missing_one(spark, tmp_path):
    from titlelens.sources import read_catalog
    (tmp_path / "title.ratings.parquet").mkdir()
    (tmp_path / "title.ratings.parquet" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_catalog(spark, str(tmp_path), fmt="parquet", infer=True, tables=["title.ratings"])


def test_column_stats_of_every_type(spark):
    from titlelens.plans.profile import column_stats
    df = spark.createDataFrame([(1, "b", 2.5, True), (3, "a", None, False), (None, None, 4.5, None)],
                               "a int, s string, d double, f boolean")
    out = {r.column_name: r for r in column_stats(df, table="t").collect()}
    assert list(out) == ["a", "s", "d", "f"] and out["s"]["count"] == 2
    assert (out["s"].mean, out["s"].min, out["s"].min_text, out["s"].max_text) == (None, None, "a", "b")
    assert (out["a"].mean, out["a"].min, out["a"].max, out["a"].min_text) == (2.0, 1.0, 3.0, None)
    assert out["d"].stddev == pytest.approx(2 ** 0.5) and out["f"].max_text == "true"
    assert [r.column_name for r in column_stats(df, ["s"]).collect()] == ["s"]


def test_extra_tables_have_views_and_profiles(spark, make_catalog):
    from titlelens.catalog import Catalog
    extra = spark.createDataFrame([(1, "x")], "id int, note string")
    cat = Catalog({**dict(make_catalog().items()), "my_notes": extra})
    assert cat.my_notes.collect() == extra.collect() and "my_notes" in cat.register_views()
    assert spark.sql("SELECT note FROM my_notes").first().note == "x"
    assert profile_catalog(cat).where("table_name = 'my_notes'").count() == 2
    with pytest.raises(KeyError):
        cat["no_such"]


def test_uncapped_pool_replaces_nameless_people(make_catalog):
    from titlelens.plans import most_credited_people
    credits = [{"tconst": "t", "ordering": 100 * p + k, "nconst": f"n{p:02d}", "category": "actor"}
               for p in range(70) for k in range(90 - p)]
    cat = make_catalog(title_basics=[{"tconst": "t", "titleType": "tvEpisode"}], title_principals=credits,
                       name_basics=[{"nconst": f"n{p:02d}", "primaryName": f"P{p}"} for p in range(40, 70)])
    assert most_credited_people(cat).count() == 10  # n40 to n49 of the pool of 50
    got = most_credited_people(cat, pool=None).collect()
    assert [r.nconst for r in got] == [f"n{p:02d}" for p in range(40, 60)]

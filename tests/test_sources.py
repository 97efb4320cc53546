import os

import pytest

from titlelens.catalog import MissingTableError
from titlelens.sources import derive_catalog, read_catalog, read_table, write_catalog, write_report
from titlelens.sources.schemas import SCHEMAS

from conftest import SF_SMALL, rows


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def tsv_dir(tmp_path):
    d = tmp_path / "dump"
    d.mkdir()
    _write(d / "title.basics.tsv",
           "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
           "tt1\tmovie\tA\tA\t0\t1999\t\\N\t90\tDrama,Comedy\n"
           "tt2\tmovie\t\"open\tnext\t1\t2001\t\\N\tabcd\t\\N\n")
    _write(d / "title.ratings.tsv", "tconst\taverageRating\tnumVotes\ntt1\t7.1\t1200\ntt2\t\\N\t5\n")
    return str(d)


def test_tsv_nulls_types_and_no_quoting(spark, tsv_dir):
    df = read_table(spark, tsv_dir, "title.basics")
    assert df.schema == SCHEMAS["title.basics"]
    got = {r.tconst: r for r in df.collect()}
    assert got["tt1"].endYear is None and got["tt1"].runtimeMinutes == 90
    assert got["tt1"].genres == "Drama,Comedy"
    # a cell starting with a quote does not swallow the following tabs
    assert got["tt2"].primaryTitle == '"open' and got["tt2"].originalTitle == "next"
    assert got["tt2"].isAdult == 1 and got["tt2"].startYear == 2001
    # unparsable numbers become null (permissive reads)
    assert got["tt2"].runtimeMinutes is None


def test_tsv_quote_option_restores_quoted_cells(spark, tsv_dir):
    df = read_table(spark, tsv_dir, "title.basics", quote='"')
    r = df.where("tconst = 'tt2'").collect()[0]
    assert r.primaryTitle.startswith("open\tnext")


def test_read_catalog_reports_missing_tables(spark, tsv_dir):
    cat = read_catalog(spark, tsv_dir)
    assert set(cat) == {"title.basics", "title.ratings"}
    assert "name.basics" in cat.missing
    with pytest.raises(MissingTableError, match="name.basics"):
        cat.name_basics
    with pytest.raises(Exception):
        read_catalog(spark, tsv_dir, strict=True)


def test_views_make_sql_usable(spark, tsv_dir):
    cat = read_catalog(spark, tsv_dir)
    assert sorted(cat.register_views()) == ["title_basics", "title_ratings"]
    out = spark.sql("SELECT b.tconst, r.numVotes FROM title_basics b JOIN title_ratings r USING (tconst) "
                    "ORDER BY b.tconst").collect()
    assert [(r.tconst, r.numVotes) for r in out] == [("tt1", 1200), ("tt2", 5)]


def test_catalog_names_and_replace(spark, tsv_dir):
    cat = read_catalog(spark, tsv_dir)
    assert cat["title_basics"] is cat.title_basics is cat["title.basics"]
    with pytest.raises(KeyError):
        cat["title.unknown"]
    sub = cat.replace(title_basics=cat.title_basics.limit(1))
    assert sub.title_basics.count() == 1 and cat.title_basics.count() == 2


def test_parquet_round_trip(spark, tsv_dir, tmp_path):
    cat = read_catalog(spark, tsv_dir)
    write_catalog(cat, str(tmp_path / "pq"))
    back = read_catalog(spark, str(tmp_path / "pq"), fmt="parquet")
    assert sorted(rows(back.title_ratings)) == sorted(rows(cat.title_ratings))
    assert back.title_basics.schema == SCHEMAS["title.basics"]


def test_report_sink_csv_parquet_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, k string")
    write_report(df, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
    assert back.columns == ["n", "k"] and back.count() == 3
    write_report(df, str(tmp_path / "pq"), fmt="parquet", partition_by="k")
    assert sorted(p for p in os.listdir(tmp_path / "pq") if p.startswith("k=")) == ["k=a", "k=b"]
    # overwrite by default; failures raise instead of being printed
    write_report(df.limit(1), str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 1
    with pytest.raises(Exception):
        write_report(df, str(tmp_path / "csv"), mode="error")
    with pytest.raises(ValueError):
        write_report(df, str(tmp_path / "x"), fmt="xml")


def test_derived_catalogue_row_counts(spark):
    cat = derive_catalog(spark, SF_SMALL, reuse=False)
    counts = {t: df.count() for t, df in cat.items()}
    assert counts == {"title.basics": 1500, "title.ratings": 1350, "title.crew": 1500,
                      "title.episode": 300, "title.principals": 6000, "title.akas": 6000,
                      "name.basics": 150}
    for t, df in cat.items():
        assert df.schema == SCHEMAS[t], t


def test_derived_catalogue_values(spark):
    cat = derive_catalog(spark, SF_SMALL)
    b = {r.tconst: r for r in cat.title_basics.where("tconst in ('tt0','tt1','tt2','tt3','tt29','tt41')").collect()}
    assert b["tt0"].titleType == "movie" and b["tt0"].genres is None and b["tt0"].isAdult is None
    assert b["tt3"].titleType == "tvEpisode" and b["tt3"].genres == "Horror" and b["tt3"].startYear == 1903
    assert b["tt1"].genres == "Comedy,Romance" and b["tt1"].primaryTitle == "Title 1"
    assert b["tt2"].titleType == "tvSeries" and b["tt2"].genres == "Action,Thriller,Western"
    assert b["tt29"].genres is None and b["tt41"].startYear is None
    r = cat.title_ratings.where("tconst = 'tt3'").collect()[0]
    assert abs(r.averageRating - 3.1) < 1e-6
    assert cat.title_ratings.where("tconst = 'tt9'").count() == 0
    e = cat.title_episode.where("tconst = 'tt28'").collect()[0]
    assert (e.parentTconst, e.seasonNumber, e.episodeNumber) == ("tt2", 2, 3)


def test_persisted_catalog_is_opt_in(spark, tsv_dir):
    cat = read_catalog(spark, tsv_dir)
    assert not cat.title_basics.is_cached
    kept = cat.persisted(tables=["title.ratings"])
    assert kept.title_ratings.is_cached and not kept.title_basics.is_cached
    assert kept.title_ratings.count() == 2
    kept.unpersist()
    assert not kept.title_ratings.is_cached


def test_read_catalog_schema_overrides_and_inference(spark, tsv_dir):
    from pyspark.sql.types import StringType, StructField, StructType
    as_text = StructType([StructField(c, StringType()) for c in ("tconst", "averageRating", "numVotes")])
    cat = read_catalog(spark, tsv_dir, schemas={"title.ratings": as_text})
    assert cat.title_ratings.schema == as_text
    assert cat.title_basics.schema == SCHEMAS["title.basics"]
    inferred = read_catalog(spark, tsv_dir, infer=True)
    types = {f.name: f.dataType.simpleString() for f in inferred.title_ratings.schema.fields}
    assert types == {"tconst": "string", "averageRating": "double", "numVotes": "int"}


def test_conform_catalog_try_casts_to_declared_types(spark):
    from titlelens.catalog import Catalog
    from titlelens.plans import rating_by_decade
    from titlelens.sources import conform_catalog
    basics = spark.createDataFrame([("t1", "1995", "x"), ("t2", "19x5", "y")], "tconst string, startYear string, extra string")
    ratings = spark.createDataFrame([("t1", "7.5", "10"), ("t2", "8.0", "n/a")], "tconst string, averageRating string, numVotes string")
    cat = conform_catalog(Catalog({"title.basics": basics, "title.ratings": ratings}))
    assert cat.title_basics.schema == SCHEMAS["title.basics"]
    assert rows(cat.title_ratings) == [("t1", 7.5, 10), ("t2", 8.0, None)]
    assert rows(rating_by_decade(cat)) == [(1990, 7.5, 1)]


def test_catalog_repr_lists_loaded_and_missing(spark, tsv_dir):
    text = repr(read_catalog(spark, tsv_dir))
    assert text.startswith("Catalog(tables: title.basics, title.ratings; missing: name.basics")

import csv
import glob

from titlelens.__main__ import main

from conftest import SF_SMALL


def test_cli_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "improving_directors\tpeople\timproving_creators" in out


def test_cli_derive_run_profile(spark, tmp_path, capsys):
    cat_dir, out = str(tmp_path / "catalog"), str(tmp_path / "reports")
    assert main(["derive", "--sf-dir", SF_SMALL, "--out", cat_dir]) == 0
    assert main(["run", "--catalog", cat_dir, "--out", out,
                 "--only", "top_rated_titles,duplicate_titles",
                 "--params", '{"top_rated_titles": {"n": 3}}']) == 0
    files = glob.glob(f"{out}/top_rated_titles/part-*.csv")
    body = [r for f in files for r in csv.DictReader(open(f))]
    assert len(body) == 3 and set(body[0]) >= {"tconst", "averageRating", "numVotes"}
    assert main(["run", "--catalog", cat_dir, "--out", out, "--only", "nope"]) == 1
    assert main(["profile", "--catalog", cat_dir, "--out", str(tmp_path / "profile")]) == 0
    assert glob.glob(str(tmp_path / "profile" / "numeric_stats" / "part-*.csv"))


def test_cli_convert_gzipped_dumps(spark, tmp_path):
    import gzip
    from titlelens.catalog import TABLES
    from titlelens.sources import read_catalog
    from titlelens.sources.schemas import SCHEMAS
    dumps = tmp_path / "dumps"
    dumps.mkdir()
    for t in TABLES:
        header = "\t".join(f.name for f in SCHEMAS[t].fields)
        row = "\t".join("x1" if f.dataType.simpleString() == "string" else "\\N" for f in SCHEMAS[t].fields)
        with gzip.open(dumps / f"{t}.tsv.gz", "wt") as f:
            f.write(f"{header}\n{row}\n")
    out = str(tmp_path / "catalog")
    assert main(["convert", "--catalog", str(dumps), "--out", out, "--suffix", ".tsv.gz", "--partitions", "2"]) == 0
    cat = read_catalog(spark, out, fmt="parquet", strict=True)
    assert {t: df.count() for t, df in cat.items()} == {t: 1 for t in TABLES}

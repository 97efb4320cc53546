"""Operators 2 and 10 against plain versions."""

import pyarrow.parquet as pq
import pytest

import brute
from titlelens.llm import queries
from titlelens.llm.decontaminate import decontaminate, drop_contaminated
from titlelens.llm.quality import host_verdicts, measure, quality_filter, quality_report

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, source string"
LONG = " ".join(f"w{k}" for k in range(300))


def read(name, *cols):
    return list(zip(*(c.to_pylist() for c in pq.read_table(f"{SF}/{name}.parquet", columns=list(cols)).columns), strict=True))


def rows(df, n=None):
    return sorted((tuple(r)[:n] for r in df.collect()), key=repr)


ODD = [(1, None, "a"), (2, "", None), (None, "x y z x y z", "a"), (4, "a b c a b c d a b c", "b"), (4, "a b c a b c d a b c", "b"),
       (5, "one line\n\none line\n \n \nOne line", "b"), (6, LONG + "\n" + LONG, "c"), (7, "é ß\x0b#*$%&|<>  x", "c"), (8, "word " * 30000, "c")]


def test_quality_measures(spark):
    docs = read("documents", "doc_id", "text")
    got = queries.op2_quality_rules(spark, SF)
    assert rows(got, 7) == sorted(brute.quality(docs), key=repr)
    assert all(not (r.base_failed and r.kept) for r in got.collect())


def test_quality_odd_rows(spark):
    df = spark.createDataFrame(ODD, DOC)
    assert rows(quality_report(df), 7) == sorted(brute.quality([r[:2] for r in ODD]), key=repr)
    assert quality_report(df.limit(0)).count() == 0
    kept = quality_filter(df.selectExpr("*", "1 as n_words", "2 as kept", "3 as __row"))
    assert kept.columns == ["doc_id", "text", "source", "n_words", "kept", "__row"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality_report(df).where("kept").collect())


def test_host_verdict_reaches_failing_documents_only(spark):
    clean = " ".join(f"clean{k}" for k in range(60))
    noisy = clean + " #" * 20
    data = [(i, noisy, "bad") for i in range(40)] + [(100, clean, "bad")] + [(200 + i, clean, f"good{i % 5}") for i in range(50)] + [(300, noisy, "good0")]
    df = spark.createDataFrame(data, DOC)
    kept = {r.doc_id for r in quality_report(df).where("kept").collect()}
    assert kept == {100, 300} | set(range(200, 250))
    flags = {r.source: r.symbols_flag for r in host_verdicts(measure(df, "text", [df["source"]]), "source").collect()}
    assert flags == {"bad": True} | {f"good{i}": False for i in range(5)}


def test_hosts_that_fail_as_a_whole(spark):
    """All rates are 0 or 1: the fitted weight is none, and must not turn into a strong prior."""
    clean = " ".join(f"clean{k}" for k in range(60))
    data = [(i, clean + " #" * 20, "bad") for i in range(60)] + [(100 + i, clean, f"good{i % 19}") for i in range(190)]
    df = spark.createDataFrame(data, DOC)
    assert {r.doc_id for r in quality_report(df).where("kept").collect()} == set(range(100, 290))
    assert {r.doc_id for r in quality_filter(df).collect()} == set(range(100, 290))
    assert {r.doc_id for r in quality_report(df.where("source = 'bad'")).where("kept").collect()} == set()


def test_decontaminate(spark):
    docs, items = read("documents", "doc_id", "text"), read("benchmark", "item_id", "text")
    got = rows(queries.op10_decontaminate(spark, SF))
    assert got == sorted(brute.contaminated(docs, items), key=repr)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("short", [False, True])
def test_decontaminate_odd_rows(spark, short):
    item = " ".join(f"w{k}" for k in range(100, 140))
    items = [(1, item), (2, None), (3, "..."), (None, " ".join(f"w{k}" for k in range(20, 35))), (1, item)]
    if short:
        items += [(10, "X y Z"), (11, "b")]
    docs = [r[:2] for r in ODD] + [(9, item.upper()), (10, "W100 " + item), (11, "w100-w101 " * 40)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontaminate(d, b).drop("text_key")) == sorted(brute.contaminated(docs, items), key=repr)
    clean = drop_contaminated(d.selectExpr("*", "1 as n_hit", "2 as words"), b)
    assert clean.columns == ["doc_id", "text", "n_hit", "words"]
    assert len(clean.collect()) == sum(not r[5] for r in brute.contaminated(docs, items))
    assert rows(decontaminate(d, b.limit(0)).drop("text_key")) == sorted(brute.contaminated(docs, []), key=repr)
    assert decontaminate(d.limit(0), b).count() == 0

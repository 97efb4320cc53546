"""Source mixing against plain versions of the targets and of the sampling's rules."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from titlelens.llm.mixing import mix, source_targets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Excess is reshared until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped, out = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        out = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in capped and out[s] > 3 * sizes[s]}
        if not above:
            return out
        capped |= above


def corpus():
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(["word"] * int(rng.integers(1, 60))), "en", "a big one", 1) for i in range(600)]
    docs += [(1000 + i, "w  x\ty\n" * int(rng.integers(0, 40)), "en", f"s{i % 9}", 1) for i in range(300)]
    docs += [(2000, "lone words here", "en", "z small", 1), (2001, None, None, None, None), (2002, "no source at all", None, None, 1),
             (None, "no id " * 30, "en", "s1", 1), (3, docs[3][1], "en", "a big one", 1), (3, docs[3][1], "en", "a big one", 1), (2003, "", "en", "only empty", 0),
             (2004, "very long " * 50_000, "en", "s2", 1)]
    return docs


def test_targets_and_taken(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as size", "2 as key", "3 as target", "4 as before_size").repartition(7)
    rows = mix(df).collect()
    assert len(rows) == len(docs)
    size = {}
    for d in docs:
        size[d[3]] = size.get(d[3], 0) + len(WORD.findall(d[1] or ""))
    want, taken = targets(size), {}
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        epochs = int(r.target // r.source_size) if r.source_size else 0
        assert epochs * r.size <= r.taken <= min(3, epochs + 1) * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted((d[0] is None, d[0] or 0, len(WORD.findall(d[1] or ""))) for d in docs)
    again = mix(df.repartition(2)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_budget_ends_once_a_source(spark):
    """Beyond whole epochs, documents are taken as a whole in key order, up to the one at the budget's end."""
    rows = mix(spark.createDataFrame(corpus(), SCHEMA)).collect()
    partial = {}
    for r in rows:
        if r.size and r.taken % r.size:
            partial[r.source] = partial.get(r.source, 0) + 1
    assert partial and max(partial.values()) == 1
    whole = mix(spark.createDataFrame(corpus(), SCHEMA), whole=True).collect()
    assert all(not r.size or r.taken % r.size == 0 for r in whole)
    for s in {r.source for r in whole}:
        mine = [r for r in whole if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2 + 1


def test_better_documents_come_first(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"), F.lit(None).cast("string").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    taken = mix(df, share=0.2, quality=F.when(F.col("doc_id") % 2 == 0, 4.0).when(F.col("doc_id") % 4 == 1, 1.0).otherwise(0.0)).where("taken > 0").collect()
    good = sum(r.doc_id % 2 == 0 for r in taken)
    assert len(taken) == 800 and 600 < good < 740 and not any(r.doc_id % 4 == 3 for r in taken)


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 0}, {"a": 0, "b": 0, None: 0}, {"a": 1, "b": 1000, "c": 5}, {"a": 100, "b": 100, "c": 100},
                                   {f"s{k:02}": k * k for k in range(25)} | {None: 7}, {"ä": 3, "z": 50, "A": 1, "": 9}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(targets(sizes))


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mix(df).collect()
    size = {}
    for r in rows:
        size[r.source] = size.get(r.source, 0) + r.size
    want = targets(size)
    assert all(r.source_size == size[r.source] for r in rows)
    for s in want:
        assert sum(r.taken for r in rows if r.source == s) == pytest.approx(want[s], abs=1)

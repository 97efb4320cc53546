"""Operator 7 against all windows."""

import random

import pyarrow.parquet as pq

import brute
import titlelens.llm.substring as sub

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def corpus():
    rng = random.Random(3)
    passages = [[f"p{k}-{rng.randrange(30)}" for _ in range(n)] for k, n in enumerate((49, 50, 51, 75, 120, 400))]
    texts = []
    for i in range(80):
        w = []
        for _ in range(rng.randrange(4)):
            w += [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(40))]
            p = rng.choice(passages)
            a = rng.randrange(max(1, len(p) - 40))
            w += p[a:a + rng.randrange(30, 200)] if rng.random() < 0.6 else p
        texts.append("  ".join(w))
    texts += [texts[3], texts[3], texts[5] + " tail", "", None, "same " * 300, "same " * 120, "é\x1cü " * 60, "é\x1cü\n" * 60]
    return [(i * 3 % 97, t) for i, t in enumerate(texts)]


def test_against_all_windows(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as phrase")
    got = rows(sub.remove_repeats(df))
    assert got == sorted(brute.repeated_windows(docs), key=repr)
    assert sum(r[2] > 0 for r in got) > 20
    assert rows(sub.remove_repeats(df, size=20)) == sorted(brute.repeated_windows(docs, 20), key=repr)
    assert rows(sub.remove_repeats(df.limit(0))) == []


def test_spread_shards(spark, monkeypatch):
    monkeypatch.setattr(sub, "SHARD_PHRASES", 7)
    monkeypatch.setattr(sub, "TASK_CHARS", 2000)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(sub.remove_repeats(df)) == sorted(brute.repeated_windows(docs), key=repr)


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{k}" for k in range(70))
    data = [(4, text), (4, text), (4, "x " + text), (None, text), (None, "y " + text), (9, text + " z")]
    got = {(r.doc_id, r.n_words, r.n_removed) for r in sub.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {(4, 70, 0), (4, 71, 0), (None, 70, 70), (None, 71, 70), (9, 71, 70)}


def test_null_texts_beside_repeats(spark):
    text = " ".join(f"w{k}" for k in range(70))
    data = [(4, text), (4, None), (None, text), (None, None), (None, None), (9, text + " z")]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in sub.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(4, 70, 0), (4, 0, 0), (None, 70, 70), (None, 0, 0), (None, 0, 0), (9, 71, 70)], key=repr)


def test_given_documents(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    docs = list(zip(*(c.to_pylist() for c in t.columns), strict=True))
    assert rows(sub.remove_repeats(spark.read.parquet(f"{SF}/documents.parquet"))) == sorted(brute.repeated_windows(docs), key=repr)


def test_owners_that_fit_a_task_open_no_windows(spark, monkeypatch):
    """Only what one task cannot take is spread, whatever else its shard could hold."""
    kept, cut = {}, sub.cut
    monkeypatch.setattr(sub, "cut", lambda df, name: kept.setdefault(name, cut(df, name)))
    monkeypatch.setattr(sub, "TASK_CHARS", 20_000)
    rng = random.Random(5)

    def group(first, n):  # one passage in n texts, each with words of its own around it: about 800 n characters
        passage = [f"p{first}-{k}" for k in range(60)]
        return [(first + k, " ".join([f"a{first + k}-{rng.randrange(99)}" for _ in range(25)] + passage + [f"b{first + k}-{rng.randrange(99)}" for _ in range(25)])) for k in range(n)]

    docs = [d for first in range(0, 600, 100) for d in group(first, 12)]
    assert sum(len(t) for _, t in docs) > 2 * sub.TASK_CHARS
    got = rows(sub.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted(brute.repeated_windows(docs), key=repr)
    assert kept["occurrences"].where("window is not null").count() == 0
    assert kept["occurrences"].count() == 6 * 11  # a span for each text but the first of its passage

    kept.clear()
    docs += group(1000, 80)  # more than one task takes
    got = rows(sub.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted(brute.repeated_windows(docs), key=repr)
    open_ = kept["occurrences"].where("window is not null")
    assert open_.count() and not open_.where("doc < 1000").count()
    assert kept["shards"].where("tasks > 1").count() == 1

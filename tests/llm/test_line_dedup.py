"""Operator 6 against a plain scan of all runs."""

import random
from itertools import accumulate

import pyarrow.parquet as pq

from titlelens.llm.line_dedup import line_report, remove_line_runs

SF = "/root/testdata/sf0.001"


def every_width(docs, min_words):
    """Text left by document: runs of any number of lines that started before go if they have the
    words.  Runs are numbered width by width, up to the first width at which none repeats."""
    split = sorted((i, (t or "").split("\n")) for i, t in docs)
    total = [[0, *accumulate(len(x.encode().split()) for x in lines)] for _, lines in split]
    edge = {i: [0] * (len(lines) + 1) for i, lines in split}
    runs, width, repeats = [[0] * (len(lines) + 1) for _, lines in split], 0, True
    while repeats:
        width, number, repeats = width + 1, {}, False
        for (i, lines), words, run in zip(split, total, runs):
            run[:] = [number.setdefault((run[k], lines[k + width - 1]), (len(number), i, k)) for k in range(len(lines) - width + 1)]
            for k, first in enumerate(run):
                if first[1:] != (i, k):
                    repeats = True
                    if words[k + width] - words[k] >= min_words:
                        edge[i][k] += 1
                        edge[i][k + width] -= 1
    gone = {i: list(accumulate(x)) for i, x in edge.items()}
    return {i: None if t is None else "\n".join(y for k, y in enumerate(t.split("\n")) if not gone[i][k]) for i, t in docs}


def corpus():
    rng = random.Random(2)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(8))) for _ in range(30)]
    blocks = [[f"block {b} line {k} " + "x " * (k % 4) for k in range(rng.randrange(2, 20))] for b in range(5)]
    docs = []
    for i in range(70):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            lines += rng.choice(blocks)[rng.randrange(3):rng.randrange(3, 25)] if rng.random() < 0.5 else [rng.choice(pool) for _ in range(rng.randrange(6))]
        docs.append((i, "\n".join(lines)))
    return docs + [(70, docs[3][1]), (71, None), (72, ""), (73, "\n\n\n"), (74, "one long line " * 5000), (75, "one long line " * 5000 + "\nend"), (76, "aa bb cc\n" * 400)]


def test_against_every_width(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as place", "'k' as __row", "2 as gone")
    for min_words in (1, 4, 40):
        got = remove_line_runs(df, min_words)
        assert got.columns == df.columns
        assert {r.doc_id: r.text for r in got.collect()} == every_width(docs, min_words)
    assert remove_line_runs(df.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    text = "a b c d e f g h i j k l"
    data = [(5, text), (5, text), (None, text), (9, text + "\nrest"), (2, "no"), (2, "no")]
    got = remove_line_runs(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(5, text), (5, text), (None, ""), (9, "rest"), (2, "no"), (2, "no")], key=repr)


def test_given_documents(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    docs = list(zip(*(c.to_pylist() for c in t.columns), strict=True))
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = every_width(docs, 10)
    assert {r.doc_id: r.text for r in remove_line_runs(df).collect()} == want
    assert {(r.doc_id, r.n_chars_left) for r in line_report(df).collect()} == {(i, len(x or "")) for i, x in want.items()}


def test_runs_of_any_number_of_lines(spark):
    three, fifteen, tail = "a b c d\ne f g h\ni j k l", "\n".join(f"one{k}" for k in range(15)), "x " * 60 + "\nshort tail\nlast words"
    docs = [(0, three), (1, "p\n" + three + "\nq"), (2, fifteen), (3, fifteen + "\nend"), (4, tail), (5, tail),
            (6, "\n" * 40 + "r " * 9), (7, "\n" * 40 + "r " * 9 + "\ns"), (8, "t " * 5 + "\n" * 30 + "u " * 5), (9, "t " * 5 + "\n" * 30 + "u " * 5)]
    got = {r.doc_id: r.text for r in remove_line_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == every_width(docs, 10)
    assert got[1] == "p\nq" and got[3] == "end" and got[5] == "" and got[9] == ""


def test_document_of_millions_of_lines(spark):
    docs = spark.createDataFrame([(1, 2_200_000), (2, 10)], "doc_id long, n int").selectExpr(
        "doc_id", "concat_ws('\n', transform(sequence(1, n), k -> concat('line ', k, ' of a long document that has many more words'))) AS text")
    got = {r.doc_id: (r.n_lines, r.n_lines_left) for r in line_report(docs).collect()}
    assert got == {1: (2_200_000, 2_200_000), 2: (10, 1)}


def test_a_line_of_very_many_documents(spark, monkeypatch):
    import titlelens.llm.line_dedup as op

    monkeypatch.setattr(op, "HOT_RUN", 20)
    docs = [(i, f"the same line of all the documents that there are here\nand one more such line that everybody has got by now\nown {i}") for i in range(300)]
    got = {r.doc_id: r.text for r in remove_line_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == every_width(docs, 10) and got[7] == "own 7"

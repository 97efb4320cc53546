"""Operator 5: what it learns from, odd texts, held-out accuracy, exact counts."""

import zlib

import numpy as np
import pyarrow.parquet as pq

from titlelens.llm import queries
from titlelens.llm.language import Filters, _positions, fit, language_id, trigrams

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op5_language_id(spark, SF).collect()}
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "lang"])
    lang = dict(zip(t["doc_id"].to_pylist(), t["lang"].to_pylist(), strict=True))
    assert set(got) == set(lang)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out and lang[i] is not None]
    right = sum(got[i].lang_pred == lang[i] for i in held)
    assert len(held) > 150 and right / len(held) >= 0.97, right / len(held)


def test_odd_rows(spark):
    en, de = "the house and the garden are here " * 8, "das haus und der garten sind hier " * 8
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2)
    data = [(i, (en, de)[k % 2], ("en", "de")[k % 2]) for k, i in enumerate(ids)]
    odd = [(held, en, "xx"), (2000, None, "en"), (2001, "", None), (2002, "123 ²! \n", "de"), (None, de, "yy"), (2003, "жук", None), (2003, "жук", None), (2004, de * 3000, None)]
    df = spark.createDataFrame(data + odd, "doc_id long, text string, lang string").selectExpr("*", "'z' as score")
    got = [tuple(r) for r in language_id(df).collect()]
    of = {r[0]: r for r in got}
    assert len(got) == len(data) + len(odd) and of[held][:3] == (held, True, "en")
    assert [of[i][2] for i in (2000, 2001, 2002)] == ["und"] * 3 and of[None][1:3] == (False, "de") and of[2004][2] == "de"
    assert of[2003][2] in ("en", "de") and of[2003][3] <= 1
    assert all(of[i][2] == x for i, _, x in data)
    assert {r.lang_pred for r in language_id(df.withColumn("lang", df["lang"].substr(9, 1).isNull().cast("string")).limit(0)).collect()} == set()
    untaught = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id(untaught).collect()} == {"und"}


def test_filters_name_all_languages_of_a_gram(spark):
    rows = [(f"l{k:02d}", " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}common" for _ in range(3))) for k in range(70)]
    f = fit(spark.createDataFrame(rows, "lang string, text string"))
    assert f.table.shape[1] == 2 and f.languages == [r[0] for r in rows]
    own = {x: set(trigrams(t.split())[0].tolist()) for x, t in rows}
    grams = np.array(sorted(set().union(*own.values())))
    bits = np.unpackbits(f.masks(grams).view(np.uint8), axis=1, bitorder="little")[:, :70]
    for g, row in zip(grams.tolist(), bits, strict=True):
        assert {x for x, s in own.items() if g in s} <= {f.languages[k] for k in np.flatnonzero(row)}


def test_counts_are_corrected_for_false_positives():
    table = np.full((1 << 10, 1), 2, np.uint64)  # the second filter says yes to everything
    table[:, 0] |= (np.arange(1 << 10) % 2).astype(np.uint64)
    f = Filters(["a", "b"], 0, table, np.array([0.125, 0.999]))
    assert f.decide(np.array([60, 100, 100]))[0] == "b" or f.decide(np.array([60, 99, 100]))[0] == "a"
    assert f.decide(np.array([60, 99, 100])) == ("a", 1.0)
    assert len(list(_positions(np.array([1, 2]), 1 << 10))) == 3

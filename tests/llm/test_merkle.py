"""Merkle manifest against a plain tree, built anew for every fold."""

import hashlib
import zlib

import pytest

from titlelens.llm.merkle import HEX, StateTree, build_manifest, changed_documents, merkle_check

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[a:a + 16]) for a in range(0, len(row), 16)])
    return levels


def proof(levels, i):
    out = []
    for row in levels[:-1]:
        a = i // 16 * 16
        out += row[a:i] + row[i + 1:a + 16]
        i //= 16
    return out


def fold(levels, i, digest):
    for row in levels[:-1]:
        a = i // 16 * 16
        digest, i = h(*row[a:i], digest, *row[i + 1:a + 16]), i // 16
    return digest


def plain(docs):
    """docs: (doc_id, source, lang, n_chars, text)"""
    by_source = {}
    for d in docs:
        by_source.setdefault(d[1], []).append((d[0] is not None, d[0] or 0, leaf(d), d))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    above = climb([trees[s][-1][0] for s in order])
    root, out = above[-1][0], []
    for k, s in enumerate(order):
        for i, (_, _, own, d) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            now = own
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0 and d[4] is not None:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d[4])
                now = leaf((*d[:4], low))
            folded = fold(above, k, fold(trees[s], i, now))
            out.append((d[0], own, trees[s][-1][0], root, h(*proof(trees[s], i), *proof(above, k)), folded, folded == root))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def corpus():
    docs = [(i, "hot", "en", 10, f"Text {i} ÄB") for i in range(700)]
    docs += [(1000 + i, f"host{i % 40}", None if i % 7 == 0 else "de", None if i % 3 == 0 else i, "" if i % 11 == 0 else None if i % 13 == 0 else f"LONG {i} " * (i % 5)) for i in range(160)]
    docs += [(5000 + i, "seventeen", "fr", 1, "same TEXT") for i in range(17)] + [(6000 + i, "sixteen", "fr", 1, "x") for i in range(16)]
    docs += [(7000, "alone", "fr", 3, "ABC"), (7001, None, None, None, None), (None, None, "en", 1, "NO ID"), (None, "hot", None, None, None)]
    docs += [(3, "hot", "en", 10, "another text of id 3")] * 2 + [(8000, "", "en", 0, ""), (8001, "Z", "en", 0, ""), (8002, "é", "en", 0, "x" * 300_000)]
    return docs


def test_against_plain_tree(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as grp", "2 as leaf", "'x' as digest", "3 as root").repartition(5)
    assert got(merkle_check(df)) == plain(docs)


@pytest.mark.parametrize("docs", [[(1, "a", "en", 1, "A")], [(5, None, None, None, None)], [(i, "a", None, None, None) for i in range(17)]])
def test_few_documents(spark, docs):
    assert got(merkle_check(spark.createDataFrame(docs, SCHEMA))) == plain(docs)


def test_empty_table(spark):
    assert merkle_check(spark.createDataFrame([], SCHEMA)).count() == 0


def test_several_rounds_of_blocks(spark, monkeypatch):
    """With small blocks a source of 700 leaves climbs through three rounds."""
    import titlelens.llm.merkle as m

    monkeypatch.setattr(m, "LEAF_LEVELS", 1)
    monkeypatch.setattr(m, "UPPER_LEVELS", 1)
    docs = corpus()
    assert got(merkle_check(spark.createDataFrame(docs, SCHEMA))) == plain(docs)


def test_fold_resumes_the_state_of_the_slot():
    nodes = [h(str(i)) for i in range(300)]
    tree, levels = StateTree("".join(nodes).encode(), 3), climb(nodes)
    assert tree.top.decode() == levels[-1][0] and [len(s) * HEX for s in tree.states] == [len(r) for r in tree.rows[:-1]]
    for i in (0, 15, 16, 255, 256, 299):
        assert tree.fold(i, h("other").encode()).decode() == fold(levels, i, h("other"))
        assert tree.fold(i, nodes[i].encode()) == tree.top
        assert b"".join(x + y for x, y in tree.siblings(i)).decode() == "".join(proof(levels, i))


def test_changed_documents(spark):
    docs = corpus()
    other = [d for d in docs if d[0] != 7000]
    other = [(*d[:4], "changed") if d[0] == 150 else d for d in other]
    a, b = (build_manifest(spark.createDataFrame(x, SCHEMA)) for x in (docs, other))
    assert sorted(map(tuple, changed_documents(a, b).collect())) == [("alone", 7000, -1), ("hot", 150, -1), ("hot", 150, 1)]
    assert changed_documents(a, a).count() == 0


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got(merkle_check(df)) == plain(docs)

"""Operator 3 against all pairs."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

import brute
import titlelens.llm.ngram_join as nj
from titlelens.llm.common import connected_components

SF = "/root/testdata/sf0.001"


def groups(df, **kw):
    got = nj.similarity_groups(df, **kw).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, got), key=repr)


def near_copies(rng, base, k, edits):
    out = []
    for _ in range(k):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(5)
    common = [f"c{k}" for k in range(40)]
    texts = []
    for size in (30, 90, 300):
        base = [f"b{size}-{rng.randrange(400)}" for _ in range(size)]
        texts += near_copies(rng, base, 60, size // 12)
    texts += [" ".join(common + [f"u{i}-{k}" for k in range(20)]) for i in range(40)]  # one passage, unrelated rests
    texts += ["a b", "A B", "a", "", None, " \t\n", "a b c", "a b c d", "word " * 5000, "word " * 4000]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_against_all_pairs(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as cls")
    assert groups(df) == sorted(brute.components(docs), key=repr)
    assert groups(df, n=5, percent=80) == sorted(brute.components(docs, 5, 80), key=repr)
    assert groups(df.limit(0)) == []


def test_blocks_and_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 3000)
    monkeypatch.setattr(nj, "HOT", 10)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert groups(df, percent=80) == sorted(brute.components(docs, 3, 80), key=repr)


@pytest.mark.parametrize("block", [4_000_000, 3000])
def test_all_links_of_a_group(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    docs = corpus()
    sets = {}
    for i, t in docs:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    link = lambda x, y: bool(x) and 100 * len(x & y) >= 90 * len(x | y)
    want = {i: sum(link(sets[i], sets[j]) for j in sets if j != i) for i in sets}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = nj.similarity_groups(df).collect()
    assert {r.doc_id: r.n_links for r in got} == want
    assert max(want.values()) > 5
    assert {r.doc_id: r.class_least for r in got} == {i: min((j for j in sets if sets[j] == sets[i]), default=None) if sets[i] else None for i in sets}
    cls = {r.doc_id: r.class_id for r in got}
    pairs = {(min(cls[i], cls[j]), max(cls[i], cls[j])) for i in sets for j in sets if cls[i] != cls[j] and link(sets[i], sets[j])}
    found = [tuple(r) for r in nj.class_links(df).collect()]
    assert len(found) == len(set(found)) and set(found) == pairs


def test_given_documents(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    docs = list(zip(*(c.to_pylist() for c in t.columns), strict=True))
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert groups(df) == sorted(brute.components(docs), key=repr)
    want = brute.components(docs, 5, 80)
    kept = nj.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, n, c in want if i == c)


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{k}" for k in range(40))
    data = [(7, text), (7, text), (None, text + " more"), (3, "other words here now"), (None, None), (5, ""), (5, "")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "9 as __key", "doc_id as component_id")
    got = nj.similarity_groups(df).collect()
    assert {(r.doc_id, r.n_shingles > 0, r.component_id) for r in got} == {(7, True, 7), (None, True, 7), (3, True, 3), (None, False, None), (5, False, 5)}
    kept = nj.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(7, text), (3, "other words here now"), (None, None), (5, ""), (5, "")], key=repr)


@pytest.mark.parametrize("percent", [50, 90])
def test_trie_finds_what_scanning_finds(percent):
    rng = random.Random(percent)
    for _ in range(60):
        base = rng.sample(range(200), 30)
        sets = {tuple(sorted((set(base) | set(rng.sample(range(200), rng.randrange(6)))) - set(rng.sample(base, rng.randrange(8))))) for _ in range(25)}
        sets |= {tuple(sorted(rng.sample(range(200), rng.randrange(1, 40)))) for _ in range(10)}
        sets = [np.array(s) for s in sorted(sets, key=repr)]
        trie = nj.Trie(sets)
        for x in sets:
            mask = np.zeros(200, np.int64)
            mask[x] = 1
            want = {k for k, y in enumerate(sets) if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))}
            assert set(trie.similar(x, mask, percent).tolist()) == want


def unrelated_sets(rng, k, size, shared):
    """Sets of random shingles, all with the same ``shared`` ones."""
    common = rng.integers(0, 1 << 64, shared, dtype=np.uint64)
    return [np.unique(np.r_[common, rng.integers(0, 1 << 64, size - shared, dtype=np.uint64)]) for _ in range(k)]


def may_link(sets, percent):
    size = np.array([len(s) for s in sets])
    return nj._may_link(size, np.zeros(len(sets), np.int64), [nj._profile(s) for s in sets], [nj._sketch(s) for s in sets], percent)


def test_long_unrelated_documents_are_no_candidates():
    # the profiles of long sets are alike, so that one chance shingle made all of them one component
    rng = np.random.default_rng(8)
    sets = unrelated_sets(rng, 40, 6000, 5) + unrelated_sets(rng, 40, 40_000, 5)
    gram = np.repeat([1, 2], 40)
    left, right = nj._candidate_edges(gram, may_link(sets, 80))
    assert len(left) == len(right) == 0


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_pairs_that_link_are_candidates(percent):
    rng = np.random.default_rng(percent)
    for size in (1, 2, 7, 50, 300, 6000):
        for _ in range(40):
            # as unlike as links allow, in parts of each set or of the longer one only
            union = rng.integers(0, 1 << 64, size, dtype=np.uint64)
            both = -(-size * percent // 100)
            for middle in (both + (size - both) // 2, size):
                sets = [np.unique(union[:middle]), np.unique(np.r_[union[:both], union[middle:]])]
                for gram in ([3, 3], [1, 2]):
                    left, right = nj._candidate_edges(np.array(gram), may_link(sets, percent))
                    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 1)] * (gram[0] == gram[1])
    sets = unrelated_sets(rng, 3, 200, 0)
    sets = [s for s in sets for _ in range(4)]
    left, right = nj._candidate_edges(np.zeros(12, np.int64), may_link(sets, percent))
    assert len(left) == 9 and (left // 4 == right // 4).all()  # three groups of four, spanned


def test_partnered_rows_against_all_pairs():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n, percent = int(rng.integers(1, 40)), int(rng.choice([50, 80, 90, 100]))
        gram, size = np.sort(rng.integers(0, 4, n)), rng.integers(1, 60, n)
        at = (rng.random(n) ** 2 * size * 0.3).astype(np.int64)
        rest = size - at
        links = (100 + percent) * np.minimum(rest[:, None], rest) >= percent * (size[:, None] + size)
        links &= (gram[:, None] == gram) & ~np.eye(n, dtype=bool)
        assert np.array_equal(nj._partnered(gram, size, at, percent), links.any(axis=1))


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(500, 500 + k) for k in range(1, 80)]
    rng.shuffle(edges)
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "test")
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, got.collect())) == sorted((x, find(x)) for x in parent if x not in loops)

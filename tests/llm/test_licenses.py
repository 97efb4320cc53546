"""Operator 9 against the contract's plain version, and its rules."""

import re

import pyarrow.parquet as pq

import brute
from titlelens.llm import queries
from titlelens.llm.licenses import GATE, Rule, rules, scan_licenses

SF = "/root/testdata/sf0.001"
TEXTS = [(1, None), (2, ""), (3, " ... "), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (None, "Apache-License mit\tlicense; MIT LICENSE"),
         (5, "Licensed under the Apache License, Version 2.0."), (6, "This work is licensed under the GNU General Public License, version 3."),
         (7, "Licensed under CC BY-NC 4.0."), (8, "SPDX-License-Identifier: LGPL-2.1-only"), (9, "admit license mitlicense mit licenses"),
         (10, "plain words only"), (11, "é MIT license " * 5000), (12, "License"), (13, "Permission is hereby granted, free of charge, to any person obtaining a copy")]


def base(df):
    return sorted((tuple(r)[:6] for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=repr)


def test_contract(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    docs = list(zip(*(c.to_pylist() for c in t.columns), strict=True))
    got = queries.op9_license_scan(spark, SF)
    assert base(got) == sorted(brute.licenses(docs), key=repr)
    for r in got.collect():
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_odd_rows_and_labels(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 as s", "2 as labels")
    got = scan_licenses(df)
    assert base(got) == sorted(brute.licenses(TEXTS), key=repr)
    labels = {r.doc_id: r.labels for r in got.collect() if r.doc_id}
    assert labels[4] == "mit" and labels[5] == "apache" and labels[6] == "gpl" and labels[7] == "cc-by-nc"
    assert labels[8] == "lgpl" and labels[9] == "" and labels[13] == "mit" and labels[2] == "" and labels[12] == ""
    assert scan_licenses(df.limit(0)).count() == 0


def test_containment_and_priority(spark):
    df = spark.createDataFrame([(1, "licensed under alpha beta gamma delta"), (2, "licensed beta gamma")], "doc_id long, text string")
    table = [Rule("long", 2, "beta", "alpha beta gamma", 0.5), Rule("same", 2, "beta", "beta gamma", 0.9),
             Rule("high", 3, "gamma", "gamma", 0.7), Rule("low", 1, "delta", "gamma delta", 0.2), Rule("never", 1, "nope", "alpha", 1.0)]
    got = {r.doc_id: (r.labels, r.detections, r.score) for r in scan_licenses(df, table=table).collect()}
    # 1: "same" lies in "long"; "high" has a higher priority than what holds it; "low" sticks out
    assert got == {1: ("high,long,low", 3, 0.7), 2: ("high,same", 2, 0.9)}


def test_rules_are_hundreds_and_gated():
    table = rules()
    assert len(table) > 250
    for r in table:
        re.compile(r.regex)
    for text in ("licence", "spdx license identifier mit"):
        assert any(g in text for g in GATE)


def example(parsed, k):
    """A text that the parsed regex matches: the k-th alternative of each choice, as few repeats as can be, or as many if k is odd."""
    out = ""
    for op, x in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(x)
        elif name == "NOT_LITERAL":
            out += "x"
        elif name == "IN":
            kind, value = x[0]
            out += chr(value if str(kind) == "LITERAL" else value[0])
        elif name == "BRANCH":
            out += example(x[1][k // 2 % len(x[1])], k)
        elif name == "SUBPATTERN":
            out += example(x[-1], k)
        elif name == "MAX_REPEAT":
            low, high, part = x
            out += example(part, k) * (min(high, max(low, 3)) if k % 2 else low)
        else:
            raise ValueError(name)
    return out


def test_every_rule_finds_its_own_example(spark):
    examples = [(i, example(re._parser.parse(r.regex), k)) for i, r in enumerate(rules()) for k in range(16)]
    assert all(re.fullmatch(rules()[i].regex, text) for i, text in examples)
    examples = sorted(set(examples))
    got = scan_licenses(spark.createDataFrame(examples, "doc_id long, text string").selectExpr("monotonically_increasing_id() as row", "*"))
    found = {}
    for r in got.select("doc_id", "labels", "score").collect():
        label = rules()[r.doc_id].label
        found.setdefault(r.doc_id, []).append(not label or (label in r.labels.split(",") and r.score > 0))
    assert [(rules()[i], found[i]) for i in found if not all(found[i])] == []
    assert len(found) == len(rules())


def test_names_with_versions_alone(spark):
    text = "Code: Apache 2.0. Data: CC BY-SA 4.0, parts GPL v3.0."
    got = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.labels == "apache,cc-by-sa,gpl" and got.score == 0.6 and got.detections == 3


def test_versions_of_software_are_no_licenses(spark):
    texts = ["Requires PHP 7.4 and Ruby 2.7 on the server.", "OpenSSL 1.1 and zlib 1.2", "PostgreSQL 9.6, curl 7.8, Vim 8.2", "Boost 1.7 Perl 5.3 Python 3.1", "Elastic 7.1 cluster, libpng 1.6",
             "X11 7.7 and W3C 1.0, Llama 3.1, Gemma 2.0, Sleepycat 1.0", "a discussion of permits, admits, misconduct and emits", "the general public 7 4"]
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r.doc_id, r.labels, r.score, r.detections) for r in got if r.labels or r.score] == []


def test_denials(spark):
    texts = {1: ("This code is not licensed under the GPL.", ""), 2: ("It is not under GPL; it is released under the BSD license.", "bsd"), 3: ("Unlike the LGPL license, MPL 2.0 applies.", "mpl"),
             4: ("never released under the terms of the Mozilla Public License", ""), 5: ("licensed under the GPL, not the LGPL", "gpl"), 6: ("not the MIT license", "mit")}
    got = {r.doc_id: r.labels for r in scan_licenses(spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")).collect()}
    assert got == {i: want for i, (_, want) in texts.items()}  # 6: a base label stays


def test_detections_against_plain_version(spark):
    """Priority and containment by comparing every two detections of a document."""
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    docs = [(i, x) for i, x in zip(*(c.to_pylist() for c in t.columns), strict=True)] + [(100_000 + k, x) for k, (_, x) in enumerate(TEXTS[:-2])] + [
        (200_000, "Unlike the LGPL license this file is licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements, GPL v2.0")]
    table = [(r, re.compile(f"(?<= )(?:{r.regex})(?= )")) for r in rules()]
    want = {}
    for i, text in docs:
        s = " " + " ".join(brute.ALNUM.findall(brute.low(text))) + " "
        found = []
        for no, (r, regex) in enumerate(table):
            if any(f" {k}" in s for k in r.keyword.split("|")):
                found += [(s.count(" ", 0, m.start()), s.count(" ", 0, m.end()) + 1, r, no) for m in regex.finditer(s)]
        found.sort(key=lambda d: (d[0], -d[1], -d[2].priority, d[3]))
        left = [d for k, d in enumerate(found) if not any(o[2].priority >= d[2].priority and o[1] >= d[1] for o in found[:k]) and d[2].label]
        want.setdefault(i, []).append((sorted({d[2].label for d in left}), len(left)))
    got = {}
    for r in scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        base_only = set(r.base_labels.split(","))
        got.setdefault(r.doc_id, []).append((r.labels, r.detections, base_only))
    for i, rows in want.items():
        assert sorted(n for _, n in rows) == sorted(n for _, n, _ in got[i])
        assert all(set(got[i][0][0].split(",")) - {""} == set(labels) | (got[i][0][2] - {""}) for labels, _ in rows[:1])

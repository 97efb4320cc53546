"""License scans: ordered signature rules over normalised words."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import ALNUM_WORD, ascii_lower


class Rule(NamedTuple):
    label: str
    priority: int  # of two overlapping detections, one inside the other, the lower or equal one goes
    keyword: str  # the regex is tried only where the text holds this, or one of several parted by |
    regex: str  # over lower-case words parted by one space
    confidence: float


# The base phrases of the contract and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label; a name as it is written in running text; its identifier; keywords, of which every form holds one.
LICENSES = [
    ("mit", r"mit", r"mit", "mit"),
    ("mit-0", r"mit no attribution", r"mit 0", "mit"),
    ("x11", r"x11", r"x11", "x11"),
    ("expat", r"expat", r"expat", "expat"),
    ("apache", r"apache(?: software)?", r"apache [12] [01]", "apache"),
    ("gpl", r"(?:gnu )?general public|(?:gnu )?gpl", r"gpl [123] 0(?: only| or later)?", "general public|gpl"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public|(?:gnu )?lgpl", r"lgpl [23] [01](?: only| or later)?", "lesser|library general|lgpl"),
    ("agpl", r"(?:gnu )?affero general public|(?:gnu )?agpl", r"agpl [13] 0(?: only| or later)?", "affero|agpl"),
    ("gfdl", r"(?:gnu )?free documentation|(?:gnu )?gfdl", r"gfdl 1 [123](?: only| or later)?", "free documentation|gfdl"),
    ("bsd", r"(?:(?:new|modified|simplified|revised|original) )?bsd|berkeley software distribution", r"bsd [1234] clause", "bsd|berkeley"),
    ("isc", r"isc|internet systems consortium", r"isc", "isc|internet systems"),
    ("mpl", r"mozilla public|mpl", r"mpl [12] [01]", "mozilla|mpl"),
    ("epl", r"eclipse public|epl", r"epl [12] 0", "eclipse|epl"),
    ("edl", r"eclipse distribution", r"edl 1 0", "eclipse distribution|edl"),
    ("cddl", r"common development and distribution|cddl", r"cddl 1 [01]", "common development|cddl"),
    ("cpl", r"common public|cpl", r"cpl 1 0", "common public|cpl"),
    ("ipl", r"ibm public", r"ipl 1 0", "ibm public|ipl"),
    ("eupl", r"european union public|eupl", r"eupl 1 [012]", "european union|eupl"),
    ("osl", r"open software", r"osl [123] [01]", "open software|osl"),
    ("afl", r"academic free", r"afl [123] [012]", "academic free|afl"),
    ("artistic", r"(?:clarified )?artistic", r"artistic [12] 0", "artistic"),
    ("perl", r"perl", r"perl", "perl"),
    ("python", r"python software foundation|psf", r"psf 2 0|python 2 0", "python|psf"),
    ("ruby", r"ruby", r"ruby", "ruby"),
    ("php", r"php", r"php 3 0[01]?", "php"),
    ("zlib", r"zlib(?: libpng)?", r"zlib", "zlib"),
    ("libpng", r"libpng", r"libpng 2 0", "libpng"),
    ("boost", r"boost(?: software)?", r"bsl 1 0", "boost|bsl"),
    ("busl", r"business source|busl", r"busl 1 1", "business source|busl"),
    ("sspl", r"server side public|sspl", r"sspl 1 0", "server side|sspl"),
    ("elastic", r"elastic", r"elastic 2 0", "elastic"),
    ("confluent", r"confluent community", r"confluent 1 0", "confluent"),
    ("commons-clause", r"commons clause", r"commons clause", "commons clause"),
    ("polyform", r"polyform (?:noncommercial|small business|strict|shield)", r"polyform noncommercial 1 0 0", "polyform"),
    ("unlicense", r"unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"do what the fuck you want to public|wtfpl", r"wtfpl", "what the fuck|wtfpl"),
    ("cc0", r"cc0|cc zero|creative commons zero", r"cc0 1 0", "cc0|cc zero|commons zero"),
    ("cc-by", r"creative commons attribution|cc by", r"cc by [1234] [05]", "commons attribution|cc by"),
    ("cc-by-sa", r"creative commons attribution share ?alike|cc by sa", r"cc by sa [1234] [05]", "commons attribution|cc by sa"),
    ("cc-by-nc", r"creative commons attribution non ?commercial|cc by nc", r"cc by nc [1234] [05]", "commons attribution|cc by nc"),
    ("cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s|cc by nd", r"cc by nd [1234] [05]", "commons attribution|cc by nd"),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike|cc by nc sa", r"cc by nc sa [1234] [05]", "commons attribution|cc by nc sa"),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s|cc by nc nd", r"cc by nc nd [1234] [05]", "commons attribution|cc by nc nd"),
    ("odbl", r"open database|odbl", r"odbl 1 0", "open database|odbl"),
    ("odc-by", r"open data commons attribution", r"odc by 1 0", "open data|odc by"),
    ("pddl", r"public domain dedication and|pddl", r"pddl 1 0", "public domain dedication|pddl"),
    ("ofl", r"sil open font|open font", r"ofl 1 [01]", "open font|ofl"),
    ("ms-pl", r"microsoft public", r"ms pl", "microsoft|ms pl"),
    ("ms-rl", r"microsoft reciprocal", r"ms rl", "microsoft|ms rl"),
    ("ncsa", r"university of illinois ncsa open source|ncsa", r"ncsa", "ncsa"),
    ("openssl", r"openssl", r"openssl", "openssl"),
    ("postgresql", r"postgresql", r"postgresql", "postgresql"),
    ("curl", r"curl", r"curl", "curl"),
    ("vim", r"vim", r"vim", "vim"),
    ("w3c", r"w3c(?: software)?", r"w3c", "w3c"),
    ("zpl", r"zope public|zpl", r"zpl [12] [01]", "zope|zpl"),
    ("sleepycat", r"sleepycat", r"sleepycat", "sleepycat"),
    ("upl", r"universal permissive", r"upl 1 0", "universal permissive|upl"),
    ("hpnd", r"historical permission notice and disclaimer", r"hpnd", "historical permission|hpnd"),
    ("blue-oak", r"blue oak model", r"blueoak 1 0 0", "blue oak|blueoak"),
    ("cecill", r"cecill(?: [abc])?", r"cecill [12] [01]", "cecill"),
    ("mulan", r"mulan (?:psl|permissive software)", r"mulanpsl 2 0", "mulan"),
    ("beerware", r"beer ?ware", r"beerware", "beer"),
    ("openrail", r"(?:creativeml )?open ?rail(?: m)?", r"openrail", "openrail|open rail"),
    ("llama", r"llama [234](?: [0123])? community", r"llama", "llama"),
    ("gemma", r"gemma terms of use", r"gemma", "gemma"),
]

# Label, a word of the notice, its wording, confidence. These need no license name.
NOTICES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    ("mit", "without limitation", r"to deal in the software without restriction including without limitation the rights", 0.9),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 0.95),
    ("bsd", "neither the name", r"neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors", 0.9),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose", 0.9),
    ("gpl", "free software", r"this (?:program|library|file) is free software you can redistribute it and or modify it", 0.95),
    ("gpl", "merchantability", r"without even the implied warranty of merchantability or fitness for a particular purpose", 0.6),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors", 0.9),
    ("boost", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization", 0.95),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", 0.95),
    ("public-domain", "public domain", r"(?:is|are|been) (?:placed|released|dedicated)? ?(?:in|into|to)? ?the public domain", 0.7),
    ("proprietary", "all rights reserved", r"all rights reserved", 0.4),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)", 0.7),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", 0.3),
    ("no-warranty", "warrant", r"without warranties or conditions of any kind", 0.5),
]

# Names that are licenses and nothing else; only their version standing alone is a license.
# The other names of the table are also those of programs, firms or formats ("php 7 4" is none).
ONLY_LICENSES = ("gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cddl", "cpl", "eupl", "osl", "afl", "cc0", "cc-by", "cc-by-sa", "cc-by-nc", "cc-by-nd",
                 "cc-by-nc-sa", "cc-by-nc-nd", "odbl", "odc-by", "ofl", "ms-pl", "ms-rl", "zpl", "upl", "busl", "sspl")
# The short names by which these are known beside their version; the names of a few families stand for more than a license alone.
BARE = {"apache": r"apache (?:software )?license|apache", "cecill": r"cecill(?: [abc])?"}

# Label, keyword, wording, confidence. Grants, headers, exceptions and disclaimers as they are written in files of each family.
SIGNATURES = [
    ("apache", "apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 1.0),
    ("apache", "compliance with the license", r"you may not use this file except in compliance with the license", 0.6),
    ("apache", "unless required by applicable law", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 0.7),
    ("apache", "asf", r"licensed to the apache software foundation asf under one or more contributor license agreements", 1.0),
    ("mit", "copyright notice and this permission notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0.95),
    ("mit", "noninfringement", r"warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable", 0.8),
    ("x11", "x consortium", r"the name of the x consortium shall not be used in advertising or otherwise to promote the sale", 0.95),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 0.95),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice this list of conditions", 0.95),
    ("bsd", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledgement", 0.9),
    ("bsd", "regents", r"(?:the )?regents of the university of california all rights reserved", 0.8),
    ("isc", "copyright notice and this permission notice", r"provided that the above copyright notice and this permission notice appear in all copies", 0.85),
    ("gpl", "free software foundation", r"terms of the gnu general public license as published by the free software foundation", 1.0),
    ("gpl", "general public license", r"you should have received a copy of the gnu general public license along with", 0.95),
    ("gpl", "classpath|combined work", r"classpath exception|linking this library statically or dynamically with other modules is making a combined work", 0.8),
    ("gpl", "copyleft|of the gpl", r"licensed to you under version [23] of the gpl|covered by the gpl copyleft", 0.8),
    ("lgpl", "lesser general public license", r"you should have received a copy of the gnu lesser general public license along with", 0.95),
    ("lgpl", "library general public license", r"you should have received a copy of the gnu library general public license along with", 0.95),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public license along with", 0.95),
    ("gfdl", "invariant sections", r"with no invariant sections no front cover texts and no back cover texts", 0.95),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public license", 1.0),
    ("mpl", "incompatible with secondary", r"this source code form is incompatible with secondary licenses", 0.9),
    ("epl", "eclipse", r"(?:this program and the )?accompanying materials are made available under the terms of the eclipse public license", 1.0),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("eupl", "eupl|this work except", r"licensed under the eupl|you may not use this work except in compliance with the licence", 0.8),
    ("artistic", "artistic|perl", r"you can redistribute it and or modify it under the (?:same )?terms (?:of|as) (?:the )?(?:perl|artistic license)", 0.9),
    ("perl", "same terms as perl", r"under the same terms as perl(?: 5)? itself", 0.95),
    ("python", "python software foundation", r"this license agreement is between the python software foundation psf and the individual or organization", 1.0),
    ("ruby", "ruby", r"you can redistribute it and or modify it under the same terms as ruby(?: itself)?", 0.9),
    ("php", "php", r"this source file is subject to version [23] [0-9]+ of the php license", 1.0),
    ("php", "php", r"this product includes php software freely available from", 0.9),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", 0.95),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 0.95),
    ("boost", "machine executable object code", r"solely in the form of machine executable object code generated by a source language processor", 0.95),
    ("unlicense", "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software", 0.9),
    ("wtfpl", "what the fuck", r"you just do what the fuck you want to", 0.95),
    ("cc0", "waived", r"to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights", 0.95),
    ("openssl", "openssl toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit", 1.0),
    ("postgresql", "university of california", r"in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages", 0.8),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer", 1.0),
    ("ofl", "reserved font name", r"(?:with )?reserved font name", 0.8),
    ("hpnd", "without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", 0.9),
    ("sspl", "service source code", r"make the service source code available via network download to everyone at no charge", 0.95),
    ("elastic", "hosted or managed service", r"you may not provide the software to third parties as a hosted or managed service", 0.9),
    ("commons-clause", "right to sell", r"does not (?:include and the license does not )?grant to you the right to sell the software", 0.9),
    ("busl", "additional use grant|change date", r"additional use grant|change date (?:[^ ]+ ){1,6}change license", 0.7),
    ("polyform", "noncommercial purpose", r"any noncommercial purpose is a permitted purpose", 0.9),
    ("openrail", "use based restrictions", r"use based restrictions as referenced in paragraph", 0.8),
    ("proprietary", "trade secret", r"contains (?:proprietary and )?confidential (?:information )?(?:and )?trade secrets?", 0.7),
    ("proprietary", "written permission|written consent", r"(?:reproduction|copying|distribution|use)(?: [^ ]+){0,6} without (?:the )?(?:express )?(?:prior )?written (?:permission|consent)", 0.5),
    ("no-warranty", "as is", r"(?:is )?provided as is without (?:any )?(?:express or implied )?warrant(?:y|ies)(?: of any kind)?", 0.5),
]

# What turns the license named right after it into none.
_NOT = r"(?:(?:is|are|was|were|be|been|has|have)(?: been)? (?:not|never)|isn t|aren t|wasn t|weren t|not|never|no longer|neither|nor|without a|incompatible with(?: the)?|unlike(?: the)?|instead of(?: the)?|rather than(?: the)?)"
_VERSION = r"(?: (?:version|v))?(?: v?[0-9]){0,3}(?: or (?:any )?later(?: version)?)?"
_VERB = r"(?:licensed|licenced|released|distributed|available|provided|published|covered|governed)"
_UNDER = rf"{_VERB}(?: [^ ]+)? (?:under|by|in accordance with)(?: the)?(?: terms(?: and conditions)? of)?(?: the| an?)?"
_LATER = rf"(?: (?:licen[sc]e|version|v?[0-9])){{0,2}}{_VERSION}"


def rules() -> list[Rule]:
    """From every license an identifier line, a grant sentence, the name with the word
    license, and both denied; of names that are licenses only also name and version; and
    hand-written notices and signatures.

    A denial has the highest priority but no label: it suppresses what lies inside it.
    """
    out = []
    for label, name, ident, key in LICENSES:
        out.append(Rule(label, 4, "spdx", rf"spdx license identifier (?:{ident})", 1.0))
        out.append(Rule(label, 3, key, rf"{_UNDER} (?:{name}){_LATER}", 0.9))
        out.append(Rule(label, 2, key, rf"(?:{name}) (?:public )?licen[sc]e{_VERSION}", 0.8))
        out.append(Rule("", 5, key, rf"{_NOT}(?: an?)?(?: {_UNDER})?(?: the)? (?:{name}){_LATER}", 0.0))
        if label in ONLY_LICENSES:
            out.append(Rule(label, 1, key, rf"(?:gnu )?{label.replace('-', ' ')} (?:version |v)?[0-9] [0-9]", 0.6))
        elif label in BARE:
            out.append(Rule(label, 1, key, rf"(?:{BARE[label]}) (?:version |v)?2 0", 0.6))
    out += [Rule(label, 3, key, regex, c) for label, key, regex, c in [*NOTICES, *SIGNATURES]]
    return out


def _keywords(table: list[Rule]) -> tuple[str, ...]:
    """Every keyword of the rules once."""
    return tuple(dict.fromkeys(k for r in table for k in r.keyword.split("|")))


# The prefilter: a text that holds none of these matches no rule and holds no base phrase.
GATE = ("licen", *_keywords(rules()))


def _spans(text: Column, regex: Column | str) -> Column:
    """``(start, end)`` in words, end excluded, of every match in turn. Matches are
    bracketed by control characters, which the words cannot hold."""
    marked = F.regexp_replace(text, F.concat(F.lit("(?<= )("), F.lit(regex) if isinstance(regex, str) else regex, F.lit(")(?= )")),
                              F.lit("\x01$1\x02"))
    tokens = F.split(F.trim(marked), " ")
    at = lambda test: F.filter(F.transform(tokens, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())
    return F.zip_with(at(lambda x: x.startswith("\x01")), at(lambda x: x.endswith("\x02")),
                      lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[Rule] | None = None) -> DataFrame:
    """One row a document, made in its scan task: ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score, detections``.

    The keywords of all rules are looked up once a document; a rule's
    regex is tried only where its own keyword stands.  Detections are taken
    in order of start, longer and higher ones first; one that lies inside an
    earlier one of the same or a higher priority is suppressed; a denial ("not licensed
    under the GPL") suppresses the license in it and is itself no detection.
    ``labels`` are the base labels and those of the detections left;
    ``score`` is the best confidence among them (0.5 for a base phrase alone).

    A null or empty text has no words, no labels, a score of 0 and null
    positions.  Rows do not depend on each other: repeated and null ids pass through.
    """
    gate = GATE if table is None else _keywords(table)
    table = rules() if table is None else table
    levels = sorted({r.priority for r in table})
    s = F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))
    df = docs.select(F.col(id_col).alias("doc_id"), s.alias("s"))
    n_words = F.when(F.col("s") == "  ", 0).otherwise(F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit(""))) - 1)
    # Keywords are whole words, but for an ending: "discussion" does not open the rules of "isc".
    present = F.filter(F.array(*map(F.lit, gate)), lambda k: F.contains("s", F.concat(F.lit(" "), k)))
    base = F.when(F.contains("s", F.lit(" license ")), _spans(F.col("s"), "|".join(BASE)))
    rule_array = F.array(*(F.struct(F.lit(i).alias("no"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                                    F.array(*map(F.lit, r.keyword.split("|"))).alias("keywords"), F.lit(r.regex).alias("regex"),
                                    F.lit(r.confidence).alias("confidence")) for i, r in enumerate(table)))
    tried = F.filter(rule_array, lambda r: F.arrays_overlap(r["keywords"], F.col("present")) & F.rlike("s", F.concat(F.lit(" ("), r["regex"], F.lit(") "))))
    df = df.select("doc_id", "s", n_words.cast("long").alias("n_words"), base.alias("base"), present.alias("present"))
    df = df.select("doc_id", "s", "n_words", "base", F.when(F.size("present") > 0, tried).alias("tried"))
    found = F.flatten(F.transform("tried", lambda r: F.transform(_spans(F.col("s"), r["regex"]), lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("before"), (-r["priority"]).alias("rank"), r["no"].alias("no"),
        r["label"].alias("label"), r["confidence"].alias("confidence")))))
    df = df.select("*", F.when(F.size("base") > 0, F.split(F.trim("s"), " ")).alias("words"))
    words_of = lambda x: F.array_join(F.slice("words", x["start"] + 1, x["end"] - x["start"]), " ")
    label = lambda x: F.coalesce(*(F.when(words_of(x) == p, v) for p, v in BASE.items()))
    df = df.select("doc_id", "n_words", "base", F.array_sort(F.array_distinct(F.transform("base", label))).alias("base_labels"),
                   F.sort_array(found).alias("found"))
    # The furthest end so far among detections of at least each priority decides containment in one pass.
    reach = F.struct(*(F.lit(0).alias(f"p{p}") for p in levels))
    start = F.struct(reach.alias("reach"), F.array().cast("array<string>").alias("labels"),
                     F.lit(0.0).alias("score"), F.lit(0).alias("kept"))

    def step(a: Column, d: Column) -> Column:
        limit = F.coalesce(*(F.when(-d["rank"] == p, a["reach"][f"p{p}"]) for p in levels))
        stays = -d["before"] > limit
        further = F.struct(*(F.when(-d["rank"] >= p, F.greatest(a["reach"][f"p{p}"], -d["before"])).otherwise(a["reach"][f"p{p}"]).alias(f"p{p}") for p in levels))
        named = stays & (d["label"] != "")
        return F.struct(further.alias("reach"),
                        F.when(named, F.array_union(a["labels"], F.array(d["label"]))).otherwise(a["labels"]).alias("labels"),
                        F.when(named, F.greatest(a["score"], d["confidence"])).otherwise(a["score"]).alias("score"),
                        (a["kept"] + named.cast("int")).alias("kept"))

    df = df.select("*", F.aggregate("found", start, step).alias("sum"))
    empty = F.array().cast("array<string>")
    n_base = F.when(F.col("base").isNull(), 0).otherwise(F.size("base"))
    base_labels, labels = F.coalesce("base_labels", empty), F.coalesce("sum.labels", empty)
    return df.select(
        "doc_id", "n_words", n_base.cast("long").alias("n_base"),
        F.get("base", F.lit(0))["start"].cast("long").alias("first_word"),
        F.get("base", F.size("base") - 1)["start"].cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, labels)), ",").alias("labels"),
        F.greatest(F.coalesce("sum.score", F.lit(0.0)), F.when(n_base > 0, 0.5).otherwise(0.0)).alias("score"),
        F.coalesce("sum.kept", F.lit(0)).cast("long").alias("detections"))

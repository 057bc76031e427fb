import random
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from tessera.llm.licenses import HINT, LATER, NAMES, RULES, SENTENCES, oracle, scan

CASES = {
    "Some text.\nReleased under the MIT License.": ("MIT", "permissive"),
    "x | y\nLicensed under the Apache License, Version 2.0.": ("Apache-2.0", "permissive"),
    "This work is licensed under the GNU General Public License, version 3.": ("GPL-3.0", "copyleft"),
    "a. Licensed under CC BY-NC 4.0.": ("CC-BY-NC-4.0", "restricted"),
    "All rights reserved.": ("proprietary", "restricted"),
    "# SPDX-License-Identifier: BSD-3-Clause": ("BSD-3-Clause", "permissive"),
    "The state licensed under a cow.": ("none", "none"),
    "Nothing to see.": ("none", "none"),
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met: Redistributions of source code must retain the above copyright notice, this list\nof conditions and the following disclaimer. " + SENTENCES["bsd_binary"]: ("BSD-2-Clause", "permissive"),
    f"{SENTENCES['mit_grant']} {SENTENCES['mit_notice']} {SENTENCES['mit_warranty']} Licensed under CC0.": ("MIT", "permissive"),
}


def test_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan(df).collect()}
    for i, wanted in enumerate(CASES.values()):
        assert (got[i]["licence"], got[i]["category"]) == wanted
    assert got[9]["licences"] == "MIT,CC0-1.0" and got[9]["sentence_ids"] == "mit_grant,mit_notice,mit_warranty,grant_CC0-1.0"


def test_longer_rules_come_before_their_parts():
    for k, (_, seq) in enumerate(RULES):
        assert not any(seq == s[: len(seq)] and len(s) > len(seq) for _, s in RULES[k + 1 :])


def test_odd_rows(spark, odd_docs, no_docs):
    got = scan(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r["licence"] for r in got} == {"none"}
    assert scan(no_docs).count() == 0


GRANTS = {"Released under MIT.": "MIT", "Distributed under GPLv2.": "GPL-2.0", "Available under Apache 2.0.": "Apache-2.0", "Published under MPL 2.0.": "MPL-2.0", "Code is released under GPL v3.": "GPL-3.0", "x\n\nAll rights\nreserved.": "proprietary", "This program is free  software: x": "none"}


def test_grants_are_found_without_other_hints(spark):
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(list(enumerate(GRANTS)), "doc_id long, text string")).collect()}
    assert [got[i]["licence"] for i in range(len(GRANTS))] == list(GRANTS.values())
    assert got[6]["sentence_ids"] == "gpl_free"



def test_hint_lets_all_rules_pass():
    known = [*SENTENCES.values(), *(f"Released under {x}" for xs in NAMES.values() for x in xs), "SPDX License Identifier MIT"]
    assert all(re.search(HINT, re.sub(r"\s", "\n\t", x)) for x in known)
    assert len({name for name, _ in RULES}) >= 40


SEVERAL = {
    "Dual licensed under MIT or Apache-2.0.": "MIT,Apache-2.0",
    "Licensed under either of the Apache License, Version 2.0 or the MIT license.": "MIT,Apache-2.0",
    "This program is distributed under the GNU GPL v2 or any later version.": "GPL-2.0-or-later",
    "SPDX-License-Identifier: LGPL-2.1 OR MIT": "MIT,LGPL-2.1",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.": "EPL-2.0",
    "Licensed under the Common Development and Distribution License 1.0.": "CDDL-1.0",
    "Licensed under CC BY-SA 2.5.": "CC-BY-SA-2.5",
}


def test_grants_of_several_licences(spark):
    got = {r["doc_id"]: r["licences"] for r in scan(spark.createDataFrame(list(enumerate(SEVERAL)), "doc_id long, text string")).collect()}
    assert {k: set(got[i].split(",")) for i, k in enumerate(SEVERAL)} == {k: set(v.split(",")) for k, v in SEVERAL.items()}


def _words(text):
    return tuple("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text).split())


def _drop(words, last):
    return words[:-1] if words and words[-1] in last else words


def _brute(text):
    """Rules over lists of words, without any prefilter: (identifiers, licences in the order of the rules)."""
    endings = {"license", "licence", "licenses", "licences"}
    known = {_words(v): k for k, v in SENTENCES.items()}
    named = {_drop(_words(x), endings): f"grant_{n}" for n, xs in NAMES.items() for x in (n, *xs)}
    later = {_drop(_words(x), endings): f"grant_{n}-or-later" for n in LATER for x in (n, *NAMES[n])}
    verbs = {"licensed", "licenced", "released", "distributed", "available", "published", "provided"}

    def name(words):
        words = list(words)
        for article in (("either",), ("of",), ("the", "a", "an")):
            if words and words[0] in article:
                words = words[1:]
        for tail in (["or", "at", "your", "option", "any", "later", "version"], ["or", "any", "later", "version"], ["or", "at", "your", "option", "any", "later"], ["or", "any", "later"], ["or", "later", "version"], ["or", "later"]):
            if words[-len(tail) :] == tail:
                return later.get(tuple(words[: -len(tail)]))
        return named.get(_drop(tuple(words), endings))

    def grants(words):
        for k in range(len(words) - 1):
            if words[k] in verbs and words[k + 1] == "under":
                lead = list(words[:k])
                if lead[-1:] == ["made"] and words[k] == "available":
                    lead.pop()
                if lead[-1:] == ["dual"]:
                    lead.pop()
                if not lead or lead[-1] in ("is", "are") and 2 <= len(lead) <= 9:
                    rest = words[k + 2 :]
                    rest = rest[3:] if rest[:3] == ("the", "terms", "of") else rest
                    return rest[1:] if rest[:1] == ("both",) else rest
        for k in range(len(words) - 3, -1, -1):
            if words[k : k + 3] == ("spdx", "license", "identifier"):
                return words[k + 3 :]
        return ()

    def read(lines):
        out = []
        for line in lines:
            tagged = re.sub("(spdx-license-identifier):", r"\1 ", line, flags=re.I)
            for sentence in re.split(r"(?<=[.!?;:])[ \t\r\n]+", tagged):
                w = _words(sentence)
                if w in known:
                    out.append(known[w])
                elif g := grants(w):
                    if name(g):
                        out.append(name(g))
                        continue
                    part: list = []
                    for k, x in enumerate((*g, "end")):
                        if x == "end" or x in ("or", "and") and k + 1 < len(g) and "later" not in g[k + 1 : k + 5]:
                            out += [name(part)] if name(part) else []
                            part = []
                        else:
                            part.append(x)
        return out

    ids = read(text.split("\n"))
    joined = read("\n".join(re.sub(r"\n", " ", p) if k % 2 == 0 else p for k, p in enumerate(re.split(r"(\n{2,})", text))).split("\n"))
    ids = joined if len(joined) > len(ids) else ids
    left, found = list(ids), []
    for licence, seq in RULES:
        k, hit = 0, False
        while k + len(seq) <= len(left):
            if left[k : k + len(seq)] == list(seq):
                left[k : k + len(seq)] = ["-"]
                hit = True
            k += 1
        if hit and licence not in found:
            found.append(licence)
    return ",".join(ids), ",".join(found)


def _texts():
    r = random.Random(4)
    all_names = [x for n, xs in NAMES.items() for x in (n, *xs)]
    verbs = ["Released under ", "This file is licensed under the ", "Dual licensed under ", "available under ", "Made available under the terms of the ", "The code and its tests are published under a "]
    out = [*CASES, *GRANTS, *SEVERAL, "", "under", "Copyright (c) 2020"]
    for _ in range(400):
        parts = []
        for _ in range(r.randrange(1, 7)):
            kind = r.random()
            if kind < 0.35:
                parts.append(r.choice(verbs) + r.choice(all_names) + r.choice(["", " license", " or later", " or MIT", " and the ISC License"]) + ".")
            elif kind < 0.5:
                parts.append("// SPDX-License-Identifier: " + r.choice(all_names))
            elif kind < 0.8:
                x = r.choice([r.choice(list(SENTENCES.values())), *r.choice([seq for _, seq in RULES])[:1]])
                parts.append(SENTENCES.get(x, x))
            elif kind < 0.9:
                seq = r.choice([seq for _, seq in RULES if len(seq) > 1])
                parts.append(" ".join(SENTENCES.get(x, "Licensed under the Apache License, Version 2.0.") for x in seq))
            else:
                parts.append(r.choice(["Plain words.", "Nobody knows what it is under.", "Copyright the authors", "The end!"]))
        text = r.choice([" ", "\n", "\n\n", "  "]).join(parts)
        if r.random() < 0.4:
            w = text.split(" ")
            text = "".join(x + ("\n" if k % 9 == 8 else " ") for k, x in enumerate(w))
        out.append(text.upper() if r.random() < 0.1 else text)
    return out + pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column("text").to_pylist()


def test_equals_brute_force_and_sql(spark):
    texts = _texts()
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    wanted = {i: _brute(t) for i, t in enumerate(texts)}
    assert {i: (texts[i], got[i], wanted[i]) for i in got if got[i] != wanted[i]} == {}
    assert sum(bool(x) for _, x in wanted.values()) > 300
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    assert {r[0]: (r[1], r[2]) for r in con.sql(oracle()).fetchall()} == wanted

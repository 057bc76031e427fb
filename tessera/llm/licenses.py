"""Licence recognition by sentence rules, in DataFrame functions only.

A text's sentences are normalised (a-z and 0-9, single spaces) and mapped to identifiers of known licence
sentences: either the whole sentence is known, or it is a grant ("released under ...") or an SPDX tag whose licence names
are; a grant may name several. Ordered rules then match identifier sequences: a rule's sentences must stand next to each other
among the text's identified ones, and a match is taken out before later rules are tried, so that the full
text of a licence is not reported again by its single sentences.

Sentences end at . ! ? ; : before white space and at line ends. A text whose licence sentences are wrapped over
lines is read a second time with single line ends as spaces, and the reading that identifies more sentences counts.

A text without any of a few words, at least one of which each known sentence and each pattern needs, is not cut into
sentences; the words follow from the sentences and patterns, so nothing is lost.

Defined results: null and empty texts have no identifiers, no licences and the licence 'none'; a licence found
by several rules or several times is listed once, in the order of the rules; repeated rows give
repeated results; columns other than id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names under which licences are granted, after the SPDX identifiers.
NAMES = {
    "MIT": ["MIT License", "MIT", "MIT Licence", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache License v2.0", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License version 2.0", "GNU GPL v2", "GPL v2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License version 3.0", "GNU GPL v3", "GPL v3", "GPLv3", "GPL-3.0"],
    "GPL": ["GNU General Public License", "GNU GPL", "GPL"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL v2.1", "LGPLv2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL v3", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL v3", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "MPL 1.1"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-clause BSD license", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-clause BSD license", "New BSD License", "Revised BSD License", "Modified BSD License", "BSD license", "BSD-3-Clause"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "0BSD"],
    "ISC": ["ISC License", "ISC"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0", "Boost Software License"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "EPL 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0", "CDDL 1.0"],
    "MS-PL": ["Microsoft Public License", "Ms-PL"],
    "MS-RL": ["Microsoft Reciprocal License", "Ms-RL"],
    "Artistic-1.0": ["Artistic License 1.0"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic License, version 2.0"],
    "PostgreSQL": ["PostgreSQL License"],
    "PSF-2.0": ["Python Software Foundation License", "PSF License", "PSF 2.0"],
    "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public License"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "OFL 1.1"],
    "GFDL-1.3": ["GNU Free Documentation License, version 1.3", "GNU Free Documentation License", "GFDL 1.3"],
    "ODbL-1.0": ["Open Database License", "Open Database License 1.0", "ODbL 1.0"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero"],
}
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _kind, _long in CREATIVE.items():
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _whole = f"Creative Commons {_long} {_version}"
        NAMES[f"CC-{_kind}-{_version}"] = [f"CC {_kind} {_version}", _whole, f"{_whole} International License", f"{_whole} Unported License"] + ([f"CC {_kind}", f"Creative Commons {_long}"] if _version == "4.0" else [])
#: Families granted "or later".
LATER = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
# Sentences of licence texts.
SENTENCES = {
    "reserved": "All rights reserved.",
    "domain": "This work is in the public domain.",
    "dedicated": "This work has been dedicated to the public domain.",
    "unencumbered": "This is free and unencumbered software released into the public domain.",
    "mit_grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit_liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd_warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache_use": "you may not use this file except in compliance with the License.",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_law": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "zlib_warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "mpl_form": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "cc_share": "Share \u2014 copy and redistribute the material in any medium or format",
    "cc_adapt": "Adapt \u2014 remix, transform, and build upon the material",
    "cc_by": "Attribution \u2014 You must give appropriate credit, provide a link to the license, and indicate if changes were made.",
    "cc_nc": "NonCommercial \u2014 You may not use the material for commercial purposes.",
    "cc_sa": "ShareAlike \u2014 If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.",
    "cc_nd": "NoDerivatives \u2014 If you remix, transform, or build upon the material, you may not distribute the modified material.",
    "gpl_free": "This program is free software:",
    "gpl_redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2_redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
}
#: Ordered rules: the licence and its sentences, the longest sequences first; grants by name follow, then the single sentences.
RULES = [
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty", "mit_liability"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_warranty"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("Apache-2.0", ["grant_Apache-2.0", "apache_use", "apache_copy", "apache_law", "apache_see"]),
    ("Apache-2.0", ["grant_Apache-2.0", "apache_use", "apache_copy", "apache_law"]),
    ("Apache-2.0", ["grant_Apache-2.0", "apache_use", "apache_copy"]),
    ("Apache-2.0", ["grant_Apache-2.0", "apache_use"]),
    ("CC-BY-NC-SA", ["cc_share", "cc_adapt", "cc_by", "cc_nc", "cc_sa"]),
    ("CC-BY-NC-ND", ["cc_share", "cc_by", "cc_nc", "cc_nd"]),
    ("CC-BY-NC", ["cc_share", "cc_adapt", "cc_by", "cc_nc"]),
    ("CC-BY-SA", ["cc_share", "cc_adapt", "cc_by", "cc_sa"]),
    ("CC-BY-ND", ["cc_share", "cc_by", "cc_nd"]),
    ("CC-BY", ["cc_share", "cc_adapt", "cc_by"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_redistribute"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_redistribute"]),
    ("Zlib", ["zlib_warranty", "zlib_grant"]),
    ("MPL-2.0", ["mpl_form", "mpl_copy"]),
    ("GPL-3.0-or-later", ["gpl_redistribute"]),
    ("GPL-2.0-or-later", ["gpl2_redistribute"]),
    ("MIT", ["mit_grant"]),
    ("ISC", ["isc_grant"]),
    ("Zlib", ["zlib_grant"]),
    ("Unlicense", ["unencumbered"]),
    *((n, [f"grant_{n}"]) for n in NAMES),
    *((f"{n}-or-later", [f"grant_{n}-or-later"]) for n in LATER),
    ("public-domain", ["domain"]),
    ("public-domain", ["dedicated"]),
    ("proprietary", ["reserved"]),
]
CATEGORIES = {
    **dict.fromkeys(("GPL", "LGPL", "AGPL", "MPL", "EPL", "EUPL", "CDDL", "MS-RL", "GFDL", "ODbL", "OFL", "CC-BY-SA"), "copyleft"),
    **dict.fromkeys(("CC-BY-NC", "CC-BY-ND", "proprietary"), "restricted"),
}
GRANT = "^(?:(?:[a-z0-9]+ ){1,8}(?:is|are) )?(?:dual )?(?:licensed|licenced|released|distributed|available|published|provided|made available) under (?:the terms of )?(?:both )?(.+)$"
SPDX = "^(?:.*[^a-z])?spdx license identifier (.+)$"
#: The tag's colon does not end a sentence.
SPDX_TAG = "(?i)(spdx-license-identifier):"
#: In names: "or later" is one word, "or" and "and" stand between names, articles and a last "license" do not count.
OR_LATER, BETWEEN, BEFORE, BEHIND = " or (?:at your option )?(?:any )?later(?: version)?", " (?:or|and) ", "^(?:either )?(?:of )?(?:the |a |an )?", " licen[sc]es?$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip(" ")


def names() -> dict[str, str]:
    """Normalised licence names, without a last 'license', to identifiers of grants."""
    bare = lambda x: re.sub(BEHIND, "", normal(x))
    out = {bare(x): f"grant_{licence}" for licence, known in NAMES.items() for x in (licence, *known)}
    for licence in LATER:
        out |= {f"{bare(x)} orlater": f"grant_{licence}-or-later" for x in (licence, *NAMES[licence])}
    return out


def _hint() -> str:
    """A few words, one of which is in every sentence that any rule can use: in each known sentence, each grant and each tag."""
    left, words = [set(normal(x).split()) for x in SENTENCES.values()], ["under", "spdx"]
    left = [x for x in left if not x & set(words)]
    while left:
        common = {"a", "in", "of", "the", "this", "to", "you", "may", "and", "or", "not", "is", "any", "if", "all", "has", "been", "at", "it", "as", "can", "one"}
        best = max(sorted(set().union(*left) - common), key=lambda w: (sum(w in x for x in left), len(w)))
        words.append(best)
        left = [x for x in left if best not in x]
    return "(?i)" + "|".join(words)


HINT = _hint()


def category(licence: str) -> str:
    return next((CATEGORIES[k] for k in sorted(CATEGORIES, key=len, reverse=True) if licence.startswith(k)), "permissive")


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _identifiers(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order."""
    tagged = F.regexp_replace(text, SPDX_TAG, "$1")
    parts = F.split(F.regexp_replace(tagged, "([.!?;:])[ \t\r\n]+", "$1\n"), "\n")
    normal_ = F.transform(parts, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))
    # few sentences speak of licences; the others need no look-up
    some = F.filter(normal_, lambda s: s.rlike(HINT))
    known, named = _map({normal(v): k for k, v in SENTENCES.items()}), _map(names())
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, BEFORE, ""), BEHIND, "")
    parts_of = lambda x: F.transform(F.split(F.regexp_replace(x, OR_LATER, " orlater"), BETWEEN), lambda y: F.try_element_at(named, bare(y)))

    def one(s: Column) -> Column:
        granted = F.concat(F.regexp_extract(s, GRANT, 1), F.regexp_extract(s, SPDX, 1))
        whole = F.coalesce(F.try_element_at(known, s), F.try_element_at(named, bare(granted)))
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.filter(parts_of(granted), lambda i: i.isNotNull()))

    return F.flatten(F.transform(some, one))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentence_ids, licences (both joined by commas), licence (the first), category of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<string>")
    hinted = docs.select(F.col(id_col).alias("doc_id"), F.when(text.rlike(HINT), text).otherwise(F.lit("")).alias("text"))
    wrapped = F.regexp_replace(F.regexp_replace("text", "([^\n])\n([^\n])", "$1 $2"), "([^\n])\n([^\n])", "$1 $2")
    read = hinted.select("doc_id", F.when(F.col("text") == "", none).otherwise(_identifiers(F.col("text"))).alias("lines"), F.when(F.col("text") == "", none).otherwise(_identifiers(wrapped)).alias("unwrapped"))
    ids = read.select("doc_id", F.when(F.size("unwrapped") > F.size("lines"), F.col("unwrapped")).otherwise(F.col("lines")).alias("ids"))
    return _hits(ids).select(
        "doc_id",
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join("found", ",").alias("licences"),
        F.coalesce(F.get("found", F.lit(0)), F.lit("none")).alias("licence"),
    ).withColumn("category", F.coalesce(F.try_element_at(_map({k: category(k) for k, _ in RULES}), F.col("licence")), F.lit("none")))


def _hits(ids: DataFrame) -> DataFrame:
    """ids with the licences of the matching rules: one fold over the ordered rules. Identifiers stand between bars."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{s}|" for s in seq)).alias("seq")) for name, seq in RULES])
    start = F.struct(F.concat(F.lit("|"), F.array_join("ids", "||"), F.lit("|")).alias("rest"), F.array().cast("array<string>").alias("found"))
    step = lambda s, r: F.struct(
        F.replace(s["rest"], r["seq"], F.lit("|-|")).alias("rest"),
        F.when(F.contains(s["rest"], r["seq"]), F.array_append(s["found"], r["name"])).otherwise(s["found"]).alias("found"),
    )
    fold = F.aggregate(rules, start, step, lambda s: F.array_distinct(s["found"]))
    return ids.withColumn("found", F.when(F.size("ids") > 0, fold).otherwise(F.array().cast("array<string>")))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def oracle() -> str:
    """The same in DuckDB SQL over documents."""
    as_map = lambda m: f"MAP {{{', '.join(f'{_quoted(k)}: {_quoted(v)}' for k, v in m.items())}}}"
    known, named = as_map({normal(v): k for k, v in SENTENCES.items()}), as_map(names())

    def read(text: str) -> str:
        parts = f"string_split(regexp_replace(regexp_replace({text}, '{SPDX_TAG}', '\\1', 'g'), '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10))"
        norm = f"list_transform({parts}, lambda s: trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' '))"
        granted = f"(regexp_extract(s, {_quoted(GRANT)}, 1) || regexp_extract(s, {_quoted(SPDX)}, 1))"
        bare = lambda x: f"regexp_replace(regexp_replace({x}, '{BEFORE}', ''), '{BEHIND}', '')"
        whole = f"coalesce(k[s], n[{bare(granted)}])"
        each = f"list_filter(list_transform(string_split_regex(regexp_replace({granted}, '{OR_LATER}', ' orlater', 'g'), '{BETWEEN}'), lambda y: n[{bare('y')}]), lambda i: i is not null)"
        return f"flatten(list_transform({norm}, lambda s: case when {whole} is not null then [{whole}] else {each} end))"

    single = "'([^\\n])\\n([^\\n])', '\\1 \\2', 'g'"
    seq, out = [], []
    for k, (licence, sentences) in enumerate(RULES):
        pattern = _quoted("".join(f"|{s}|" for s in sentences))
        seq.append(f"r{k + 1} as (select *, case when contains(rest{k}, {pattern}) then {_quoted(licence)} end as h{k}, replace(rest{k}, {pattern}, '|-|') as rest{k + 1} from r{k})")
        out.append(f"h{k}")
    cats = as_map({k: category(k) for k, _ in RULES})
    return f"""
with m as (select {known} as k, {named} as n),
t as (select doc_id, coalesce(text, '') as text from documents),
i as (select doc_id, case when text = '' then []::varchar[] else {read('text')} end as lines,
             case when text = '' then []::varchar[] else {read(f'regexp_replace(regexp_replace(text, {single}), {single})')} end as unwrapped from t, m),
j as (select doc_id, case when len(unwrapped) > len(lines) then unwrapped else lines end as ids from i),
r0 as (select doc_id, ids, case when len(ids) > 0 then '|' || array_to_string(ids, '||') || '|' else '' end as rest0 from j),
{', '.join(seq)},
f as (select doc_id, ids, list_filter([{', '.join(out)}], lambda x: x is not null) as hits from r{len(RULES)}),
g as (select doc_id, ids, list_filter(hits, lambda x, p: list_position(hits, x) = p) as found from f),
c as (select {cats} as c)
select doc_id, array_to_string(ids, ',') as sentence_ids, array_to_string(found, ',') as licences,
       coalesce(found[1], 'none') as licence, coalesce(c[found[1]], 'none') as category from g, c
"""

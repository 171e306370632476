"""License scans: sentence-rule recognition.

A text is cut into sentences (lines that go on in the next are joined first), each is normalised to words of small letters, digits and points, and a sentence that is known becomes an identifier:

* `spdx:<expression>` for a line that declares one, read by SPDX's grammar (OR, AND, WITH, +, parentheses) over the identifiers known here;
* `notice:<expression>` for a sentence that puts something under one or more licenses by name; names after "dual", "either" or between "or" are a choice;
* `denied` for one that says that something is not under a license;
* `title:<license>` for a sentence that is the name of a license and no more, as texts begin with;
* the identifier that the catalogue of license texts' sentences gives, a holder's name being a slot.

The identifiers of a text, in order, are matched against ordered rules: a rule is a run of identifiers, the first rules are the most specific, and what a rule has matched is taken out for those
after it. After the runs of the catalogue each declaration, notice and title stands for itself, and `denied` for no license.

Texts without any word that all of this needs are told in Arrow's own code, and only the others are cut.

Defined cases: a null or empty text has no sentences and no license; texts of any length are cut whole; repeated rows are scanned one by one; an empty
table gives no rows; only doc_id and text are read, so other columns clash with nothing. Identifiers that no rule takes (a sentence of a license's text alone, a declaration of identifiers that aren't
known) are counted in `n_unmatched`. A license that is named and one whose text stands there are one if they are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Sentences of license texts, normalised, and their identifiers.
SENTENCES = {
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution and": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-later",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-notice",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl2-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-notice",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl-grant",
    "all rights reserved under copyright": "reserved",
}
#: A name that a license leaves open, and what stands for it in the catalogue.
SLOT = re.compile(r"^neither the names? of .{1,200} (?:nor|and) the names of (?:its|their|any) contributors may")
NAMED = "neither the name of the copyright holder nor the names of its contributors may"

#: Runs of identifiers of the catalogue and the license each stands for, the most specific first.
RULES = (
    ("notice:Apache-2.0 apache-use apache-copy apache-warranty apache-see", "Apache-2.0"),
    ("notice:Apache-2.0 apache-use apache-copy", "Apache-2.0"),
    ("title:MIT mit-grant mit-condition mit-warranty", "MIT"),
    ("mit-grant mit-condition mit-warranty", "MIT"),
    ("bsd-grant bsd-source bsd-binary bsd-endorse", "BSD-3-Clause"),
    ("bsd-grant bsd-source bsd-binary", "BSD-2-Clause"),
    ("gpl3-later gpl-warranty", "GPL-3.0-or-later"),
    ("gpl2-later gpl-warranty", "GPL-2.0-or-later"),
    ("lgpl21-later gpl-warranty", "LGPL-2.1-or-later"),
    ("lgpl3-later gpl-warranty", "LGPL-3.0-or-later"),
    ("agpl3-later gpl-warranty", "AGPL-3.0-or-later"),
    ("zlib-warranty zlib-grant", "Zlib"),
    ("title:MIT mit-grant mit-condition", "MIT"),
    ("mit-grant mit-condition", "MIT"),
    ("isc-grant", "ISC"),
    ("gpl3-later", "GPL-3.0-or-later"),
    ("gpl2-later", "GPL-2.0-or-later"),
    ("lgpl21-later", "LGPL-2.1-or-later"),
    ("lgpl3-later", "LGPL-3.0-or-later"),
    ("agpl3-later", "AGPL-3.0-or-later"),
    ("mpl2-notice", "MPL-2.0"),
    ("unlicense-notice", "Unlicense"),
    ("cc0-notice", "CC0-1.0"),
    ("zlib-grant", "Zlib"),
    ("bsl-grant", "BSL-1.0"),
)

#: What licenses are called in normalised prose, and their SPDX names. `(?P<v>...)` is a version that goes into the name in place of {v}, `.0` behind a whole number.
VERSION = r"(?: licen[sc]e)?(?: public licen[sc]e)?(?: version| ?v\.?)? ?"
NAMES = (
    (r"(?:the )?(?:expat |x11 )?mit(?: style)?", "MIT"),
    (r"(?:the )?apache(?: software)?" + VERSION + r"(?P<v>2)(?:\.0)?", "Apache-{v}.0"),
    (r"(?:the )?(?:gnu )?(?:affero general public licen[sc]e|agpl)(?: version| ?v\.?)? ?(?P<v>3)(?:\.0)?", "AGPL-{v}.0"),
    (r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl)(?: version| ?v\.?)? ?(?P<v>2\.1)", "LGPL-{v}"),
    (r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl)(?: version| ?v\.?)? ?(?P<v>[23])(?:\.0)?", "LGPL-{v}.0"),
    (r"(?:the )?(?:gnu )?(?:general public licen[sc]e|gpl)(?: version| ?v\.?)? ?(?P<v>[123])(?:\.0)?", "GPL-{v}.0"),
    (r"(?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)", "BSD-3-Clause"),
    (r"(?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "BSD-2-Clause"),
    (r"(?:the )?isc", "ISC"),
    (r"(?:the )?(?:mozilla|mpl)" + VERSION + r"(?P<v>[12]\.[01])", "MPL-{v}"),
    (r"(?:the )?(?:eclipse|epl)" + VERSION + r"(?P<v>[12]\.0)", "EPL-{v}"),
    (r"(?:the )?(?:european union public licen[sc]e|eupl)(?: version| ?v\.?)? ?(?P<v>1\.[12])", "EUPL-{v}"),
    (r"(?:the )?(?:boost software licen[sc]e|boost|bsl)(?: version| ?v\.?)? ?(?P<v>1\.0)", "BSL-{v}"),
    (r"(?:the )?artistic" + VERSION + r"(?P<v>2\.0)", "Artistic-{v}"),
    (r"(?:the )?(?:creative commons )?(?:cc0|cc zero|zero)(?: (?P<v>1\.0))?(?: universal)?", "CC0-1.0"),
    (r"(?:a |the )?(?:creative commons )?(?:cc )?(?:by|attribution)(?P<more>(?: (?:nc|nd|sa|non ?commercial|no ?deriv(?:ative|atives|s)|share ?alike))*) (?P<v>[1-4]\.[05])(?: (?:international|unported|generic))?(?: public)?", "CC-BY{more}-{v}"),
    (r"(?:the )?zlib(?: libpng)?", "Zlib"),
    (r"(?:the )?unlicense", "Unlicense"),
)
#: SPDX identifiers beside those that NAMES make: as they are written, and of GNU licenses with -only and -or-later.
OTHERS = ("0BSD", "AFL-3.0", "Apache-1.1", "Artistic-1.0", "BSD-4-Clause", "CDDL-1.0", "EPL-1.0", "MIT-0", "MPL-1.1", "MS-PL", "NCSA", "OFL-1.1", "OpenSSL", "PostgreSQL", "Python-2.0", "Ruby", "Vim", "W3C", "WTFPL", "X11")
EXCEPTIONS = ("Classpath-exception-2.0", "LLVM-exception", "GCC-exception-3.1", "Autoconf-exception-3.0", "OpenSSL-exception", "Linux-syscall-note", "Bison-exception-2.2", "Font-exception-2.0")

#: Whatever is recognised holds one of these.
TRIGGER = "licen[sc]e|copyright|permission|permitted|redistribut|warrant|without restriction|distributed|unencumbered|names of|licensed|creative commons|cc0|public domain"
_TRIGGER = re.compile(TRIGGER)
_SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
#: A line goes on in the next, behind a comment mark or none: where small letters or capitals stand on both sides, behind a line of 50 characters and more, and where a version follows a license's title.
WRAPS = tuple(
    re.compile(p)
    for p in (
        r"(?<=[a-z,])[ \t]*\r?\n[ \t]*[#*/;]*[ \t]*(?=[a-z(])",
        r"(?<=[A-Z][A-Z,])[ \t]*\r?\n[ \t]*[#*/;]*[ \t]*(?=[A-Z][A-Z,])",
        r"(?<=[^\n]{50}[a-z,])[ \t]*\r?\n[ \t]*[#*/;]*[ \t]*(?=[A-Z])",
        r"(?<=[Ll][Ii][Cc][Ee][Nn][SsCc][Ee])[ \t]*\r?\n[ \t]*[#*/;]*[ \t]*(?=[Vv][Ee][Rr][Ss][Ii][Oo][Nn] )",
    )
)
ENDS = re.compile(r"[.!?][ \t]+(?![0-9])|[.!?]?[\r\n]+|[.!?]$")
_OTHER_SIGNS = re.compile(r"[^a-z0-9.]+")

_NAME = "(?:" + "|".join(re.sub(r"\?P<\w+>", "?:", p) for p, _ in NAMES) + r")(?: licen[sc]es?)?(?: (?:or|and) (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?)?(?: licen[sc]es?)?"
_UNDER = r"(?:licen[sc]ed|released|distributed|available|provided|published|covered|offered|redistributed|relicensed) (?:under|subject to|by the terms of)(?: (?:either|both))?(?: of)?(?: the)?(?: terms(?: and conditions)? of)?(?: either| both)?(?: of)? "
_NOTICE = re.compile(rf"\b{_UNDER}((?:(?:the|a|an) )?{_NAME}(?:(?: (?:and|or|and or))? (?:(?:the|a|under) )*{_NAME})*)(?=$| (?!press\b|media\b|labs?\b|group\b|institute\b|university\b))")
_NAMED_FIRST = re.compile(rf"(?:^|\b(?:is|are|be) )(?:dual )?({_NAME}(?: (?:and|or) {_NAME})*) licen[sc]ed\b")
_DENIED = re.compile(r"\b(?:not|never|no longer|cannot|isn t|aren t|wasn t|nor)(?: \w+){0,3} " + _UNDER.split("(?:under")[0])
_TITLE = re.compile(rf"^(?:the )?({_NAME})(?: mit)?(?: (?:january|february|march|april|may|june|july|august|september|october|november|december))?(?: \d{{1,2}}(?:st|nd|rd|th)?)?(?: (?:january|february|march|april|may|june|july|august|september|october|november|december))?(?: \d{{4}})?$")
_EACH = re.compile("|".join(f"(?P<n{i}>" + re.sub(r"\?P<(\w+)>", rf"?P<\g<1>{i}>", p) + ")" for i, (p, _) in enumerate(NAMES)))
_LATER = re.compile(r"^(?: licen[sc]es?)?(?: (?:or|and) (?:at your option )?(?:any )?(?:later|newer))")
_PARTS = (("non ?commercial|nc", "NC"), ("no ?deriv\\w*|nd", "ND"), ("share ?alike|sa", "SA"))


@lru_cache(maxsize=1)
def known() -> dict[str, str]:
    """SPDX identifiers in small letters, and as they are written."""
    names = set(OTHERS)
    for pattern, name in NAMES:
        versions = {"AGPL-{v}.0": "3", "LGPL-{v}.0": "23", "GPL-{v}.0": "123", "Apache-{v}.0": "2"}.get(name, re.findall(r"\(\?P<v>([^)]*)\)", pattern))
        if "{more}" in name:
            names |= {name.format(more=m, v=v) for m in ("", "-NC", "-ND", "-SA", "-NC-ND", "-NC-SA") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")}
        elif "{v}" in name:
            own = versions if isinstance(versions, str) else [v for x in versions for v in _spelt(x)]
            names |= {name.format(v=v) for v in own}
        else:
            names.add(name)
    gnu = {n for n in names if "GPL-" in n}
    names |= {f"{n}-{x}" for n in gnu for x in ("only", "or-later")}
    return {n.lower(): n for n in names}


def _spelt(pattern: str) -> list[str]:
    """What a pattern of versions, as 1\\.[12], can be."""
    out = [""]
    for part in re.findall(r"\[[^\]]*\]|\\?.", pattern):
        out = [x + c for x in out for c in (part[1:-1] if part[0] == "[" else part[-1])]
    return out


class _Bad(ValueError):
    pass


def expression(text: str) -> str | None:
    """An SPDX expression in its usual spelling, or None if it is none over known identifiers. OR binds least, then AND, then WITH."""
    tokens = re.findall(r"[()]|[^\s()]+", text)
    at = 0

    def peek() -> str:
        return tokens[at].upper() if at < len(tokens) else ""

    def take() -> str:
        nonlocal at
        at += 1
        if at > len(tokens):
            raise _Bad
        return tokens[at - 1]

    def some(word: str, part) -> list[str]:
        out = [part()]
        while peek() == word:
            take()
            out.append(part())
        return out

    def either() -> str:
        return " OR ".join(some("OR", every))

    def every() -> str:
        return " AND ".join(some("AND", one))

    def one() -> str:
        token = take()
        if token == "(":
            inside = either()
            if take() != ")":
                raise _Bad
            return f"({inside})" if " " in inside else inside
        plus = token.endswith("+")
        name = token if re.fullmatch(r"(?i)(DocumentRef-[\w.-]+:)?LicenseRef-[\w.-]+", token) else known().get(token.rstrip("+").lower())
        if name is None:
            raise _Bad
        if peek() == "WITH":
            take()
            given = take()
            said = next((x for x in EXCEPTIONS if x.lower() == given.lower()), None)
            if said is None:
                raise _Bad
            return f"{name}{'+' * plus} WITH {said}"
        return name + "+" * plus

    try:
        out = either()
    except _Bad:
        return None
    out = out[1:-1] if out.startswith("(") and out.endswith(")") and out.count("(") == 1 else out
    return out if at == len(tokens) else None


def names_in(phrase: str) -> list[str]:
    """The licenses that a phrase names, in order."""
    out = []
    for m in _EACH.finditer(phrase):
        i = int(m.lastgroup[1:]) if m.lastgroup and m.lastgroup[0] == "n" else next(i for i in range(len(NAMES)) if m.group(f"n{i}") is not None)
        groups = m.groupdict()
        more = groups.get(f"more{i}") or ""
        parts = "".join(f"-{short}" for pattern, short in _PARTS if re.search(rf"\b(?:{pattern})\b", more))
        name = NAMES[i][1].format(v=groups.get(f"v{i}") or "", more=parts)
        if "GPL-" in name and _LATER.match(phrase[m.end() :]):
            name += "-or-later"
        out.append(name)
    return list(dict.fromkeys(out))


def notice(sentence: str) -> str | None:
    """What a normalised sentence says of licenses by name: an identifier, or None."""
    if _DENIED.search(sentence):
        return "denied"
    found = _NOTICE.search(sentence) or _NAMED_FIRST.search(sentence)
    if found:
        names = names_in(found[1])
        if names:
            choice = re.search(r"\b(?:dual|either|your (?:option|choice))\b", sentence) or re.search(r"\bor (?!(?:at your option )?(?:any )?(?:later|newer))", found[1])
            return "notice:" + (" OR " if choice and len(names) > 1 else " AND ").join(names)
    title = _TITLE.match(sentence)
    if title and re.search("licen[sc]e|cc0|creative commons|public", sentence):
        names = names_in(title[1])
        if len(names) == 1:
            return f"title:{names[0]}"
    return None


def identifiers(text: str) -> list[str]:
    """The identifiers of the known sentences of a text, in order."""
    for wrap in WRAPS:
        text = wrap.sub(" ", text)
    out = []
    for sentence in ENDS.split(text):
        if not _TRIGGER.search(low := sentence.lower()) and "spdx" not in low:
            continue
        declared = _SPDX.search(sentence)
        if declared:
            said = re.sub(r"\s*(?:\*/|-->|\"\"\"|'''|#\}|%>|\*\))\s*$", "", declared[1]).strip(" \t\"'`*#;,.")
            out.append(f"spdx:{expression(said) or 'unknown'}")
            continue
        words = SLOT.sub(NAMED, _OTHER_SIGNS.sub(" ", low).strip())
        one = SENTENCES.get(words.rstrip(".")) or notice(words)
        if one:
            out.append(one)
            # An Apache header on one line says two things.
            if one == "notice:Apache-2.0" and words.endswith("you may not use this file except in compliance with the license"):
                out.append("apache-use")
    return out


def matched(ids: list[str]) -> tuple[list[str], int]:
    """(licenses, in order of rules; identifiers that no rule takes)."""
    rest: list[str | None] = list(ids)
    found = []
    for run, name in RULES:
        want = run.split()
        k = 0
        while k + len(want) <= len(rest):
            if rest[k : k + len(want)] == want:
                rest[k : k + len(want)] = [None] * len(want)
                found.append(name)
            k += 1
    for k, one in enumerate(rest):
        kind, _, said = (one or "").partition(":")
        if kind in ("spdx", "notice", "title") and said != "unknown":
            found += said.split(" AND ") if " OR " not in said else [said]
            rest[k] = None
        elif one == "denied":
            rest[k] = None
    return list(dict.fromkeys(found)), sum(x is not None for x in rest)


def joined(licenses: list[str]) -> str:
    """One expression: choices stand in parentheses beside others."""
    return " AND ".join(f"({x})" if " OR " in x and len(licenses) > 1 else x for x in licenses)


SCHEMA = "doc_id long, identifiers string, licenses string, n_sentences long, n_unmatched long"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, identifiers (joined by spaces), licenses (distinct, in order of rules, as an expression), n_sentences and n_unmatched of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            some = pc.fill_null(pc.match_substring_regex(column, TRIGGER + "|spdx", ignore_case=True), False)
            rows = [("", "", 0, 0)] * batch.num_rows
            for i in pc.indices_nonzero(some).to_pylist():
                ids = identifiers(column[i].as_py())
                licenses, left = matched(ids)
                rows[i] = (" ".join(x.replace(" ", "_") for x in ids), joined(licenses), len(ids), left)
            out = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=["doc_id", "identifiers", "licenses", "n_sentences", "n_unmatched"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def oracle() -> str:
    """Notices by name, looked for in the text as it stands and apart from the code above: what the tables of documents hold."""
    return r"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), '(?i)(?:licensed|released) under (?:the )?(?:Apache License, Version 2\.0|MIT License|GNU General Public License, version 3|CC BY-NC 4\.0)') AS found FROM documents),
named AS (
  SELECT doc_id, list_transform(found, lambda s: CASE WHEN s ILIKE '%apache%' THEN 'Apache-2.0' WHEN s ILIKE '%mit license' THEN 'MIT' WHEN s ILIKE '%gnu%' THEN 'GPL-3.0' ELSE 'CC-BY-NC-4.0' END) AS names FROM said)
SELECT doc_id, array_to_string(list_transform(names, lambda n: 'notice:' || n), ' ') AS identifiers,
  array_to_string(list_filter(names, lambda n, i: list_position(names, n) = i), ' AND ') AS licenses, len(names)::BIGINT AS n_sentences, 0::BIGINT AS n_unmatched
FROM named"""

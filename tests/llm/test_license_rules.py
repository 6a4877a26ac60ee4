import re

import pytest
from edge import edge_docs, empty_docs, texts

from skein.llm import license_rules as L
from skein.llm.queries import QUERIES


WHITE, LINE_END, QUOTES = " \t\r\n\x0b\x0c", "\r\n", "\"'`‘’“”"


def goes_on(text, at, before):
    """Whether the line that begins at ``at`` goes on with a sentence whose last character so far is ``before``."""
    rest = text[at:].lstrip(" \t")[:2]
    if rest[:1] and (rest[0] in "(\"" or "a" <= rest[0] <= "z"):
        return True
    return bool(before) and (before == "," or "A" <= before <= "Z") and len(rest) == 2 and all("A" <= c <= "Z" for c in rest)


def cut(text):
    """Sentences, by walking over the characters."""
    out, start, i = [], 0, 0
    while i < len(text):
        before, j = text[i - 1] if i else "", i
        if before and before in ".:;!?" and text[i] in WHITE:
            while j < len(text) and text[j] in WHITE:
                j += 1
        elif text[i] in LINE_END and not (before and before in LINE_END):
            while j < len(text) and text[j] in LINE_END:
                j += 1
            if goes_on(text, j, before):
                j -= 1  # only a line end that is followed by another one ends the sentence
        if j > i:
            out.append(text[start:i])
            start = i = j
        else:
            i += 1
    return [*out, text[start:]]


def key(sentence):
    return " ".join(re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), sentence)))


def plain(separator):
    return "".join("'" if c in QUOTES else c for c in separator)


PIECES = [(name, i, k, p) for name, t in L.SENTENCES.items() for i, (k, p) in enumerate([(key(p), p) for p in cut(t) if key(p)], 1)]
NAMES = {}
for _name, _i, _key, _ in PIECES:
    NAMES.setdefault(_key, _name if _i == 1 else f"{_name}/{_i}")
NEIGHBOURS = set()
for _, _, _, _piece in PIECES:
    _split = re.split("([^A-Za-z0-9]+)", _piece)
    for _a, _s, _b in zip(_split[0::2], _split[1::2], _split[2::2]):
        if _a and _b:
            NEIGHBOURS.add((_a.lower(), plain(_s.split(" ")[0]), _b.lower()))


def unwrapped(text):
    """Line ends between words that are neighbours in a known sentence become spaces."""
    parts = re.split("([^A-Za-z0-9]+)", text)
    for i in range(1, len(parts) - 1, 2):
        at = re.search("[\r\n]", parts[i])
        if at and parts[i - 1] and parts[i + 1]:
            head = parts[i][: at.start()].rstrip(" \t*")
            if (parts[i - 1].lower(), plain(head), parts[i + 1].lower()) in NEIGHBOURS:
                parts[i] = head + " "
    return "".join(parts)


def brute(text):
    """Plain Python form of the scan, with a splitter and an unwrapping of its own."""
    hits = [(NAMES[k], i) for i, k in enumerate(map(key, cut(unwrapped(text or "")))) if k in NAMES]
    found = [n for n, _ in hits]

    def ordered(rule):
        rest = iter(found)
        return all(NAMES[k] in rest for name in rule for n, _, k, _ in PIECES if n == name)

    rules = sorted((r, lic) for r, lic, seq in L.RULES if ordered(seq))
    return (len(hits), ",".join(found), ",".join(str(i) for _, i in hits), ",".join(r for r, _ in rules),
            ",".join(sorted({lic for _, lic in rules})), bool(rules))


def test_query_matches_brute_force(spark, sf_dir):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op10_license_rules"](spark, sf_dir).collect()}
    want = {i: brute(t) for i, t in texts(spark, sf_dir).items()}
    assert got == want and any(w[5] for w in want.values())


def notice(*ids):
    return "Intro line\n" + "\n".join(f"  {L.SENTENCES[i].replace(' ', '  ')}" for i in ids) + "\nthe end"


CASES = {
    notice("mit-grant", "mit-notice", "mit-warranty"): "MIT",
    notice("mit-warranty", "mit-notice"): "",
    notice("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"): "BSD-2-Clause,BSD-3-Clause",
    notice("gpl-free", "gpl-hope", "gpl-details"): "GPL-3.0-or-later",
    notice("gpl-2.0-free", "gpl-hope", "gpl-details"): "GPL-2.0-or-later",
    notice("apache-2.0-licensed", "apache-2.0-copy", "apache-2.0-required", "apache-2.0-see"): "Apache-2.0",
    notice("mit-grant", "mit-notice", "mit-warranty").replace("  ", " ").replace(" a ", "\na ").replace(" OR ", " OR\n"): "MIT",
    "Released under the mit licence": "",
    "x.  RELEASED UNDER THE MIT LICENSE! Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0,MIT",
}


@pytest.mark.parametrize("text,licenses", CASES.items())
def test_rules(spark, text, licenses):
    row = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["licenses"] == licenses and tuple(row)[1:] == brute(text)


def test_every_rule_and_sentence_is_reachable(spark):
    assert len(L.known()) == len(L.identifiers()) >= len(L.SENTENCES)
    rows = [(r, notice(*ids)) for r, _, ids in L.RULES]
    got = {r["doc_id"]: r["rules"].split(",") for r in L.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert all(rule in got[rule] for rule, _, _ in L.RULES)


def test_edges_and_plan(spark):
    docs = edge_docs(spark)
    got = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in L.scan(docs).collect())
    assert got == sorted((str(r["doc_id"]), *brute(r["text"])) for r in docs.collect())
    assert L.scan(empty_docs(spark)).count() == 0
    plan = L.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


#: Headers as their licences print them.
HEADERS = {
    "MIT": """MIT License

Copyright (c) 2024 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE.""",
    "Apache-2.0": """Copyright 2024 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "GPL-2.0-or-later": """Copyright (C) 2024 Jane Doe

This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "GPL-3.0-or-later": """Copyright (C) 2024 Jane Doe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "LGPL-2.1-or-later": """Copyright (C) 2024 Jane Doe

This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.""",
}
WHOLE = {"MIT": {"mit-text", "mit-title-short"}, "Apache-2.0": {"apache-2.0-header"}, "GPL-2.0-or-later": {"gpl-2.0-header"},
         "GPL-3.0-or-later": {"gpl-3.0-header"}, "LGPL-2.1-or-later": {"lgpl-2.1-header"}}


def test_wrapped_headers(spark):
    import textwrap
    rows = []
    for lic, text in HEADERS.items():
        for mark in ("", "# ", "// ", " * "):
            lines = [(mark + x).rstrip() for x in text.split("\n")]
            rows += [(lic, "\n".join(lines)), (lic, "\r\n".join(lines)), (lic, "  \n".join(lines))]
            for width in (24, 47, 71):
                parts = [textwrap.wrap(p, width, break_on_hyphens=False, break_long_words=False) or [""] for p in text.split("\n\n")]
                rows.append((lic, "\n".join((mark + x).rstrip() for p in parts for x in [*p, ""])))
    got = L.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows)
    assert [tuple(r)[1:] for r in got] == [brute(t) for _, t in rows]
    wrong = [(r["doc_id"], t) for r, (_, t) in zip(got, rows) if r["licenses"] != r["doc_id"] or not WHOLE[r["doc_id"]] <= set(r["rules"].split(","))]
    assert not wrong, wrong[:3]


def test_titles_and_other_lines_stay_apart(spark):
    text = "Apache License\nVersion 2.0, January 2004\n\nMIT License\nSome project\nAll rights reserved.\n"
    row = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["sequence"] == "apache-2.0-title,mit-title-short,all-rights-reserved"


@pytest.mark.parametrize("between", ["# " + "-" * 250, " *\n" * 400, "#" * 300_000, "\n" * 5_000])
def test_what_lies_between_two_lines_has_no_bound(spark, between):
    lines = HEADERS["MIT"].split("\n")
    at = next(i for i, x in enumerate(lines) if x.startswith("in the Software"))
    text = "\n".join([*lines[:at], between, *lines[at:]])
    row = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert "mit-text" in row["rules"].split(",") and tuple(row)[1:] == brute(text)

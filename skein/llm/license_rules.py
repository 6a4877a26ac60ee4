"""Licence recognition by sentences and ordered rules, in DataFrame expressions.

A text is cut into sentences, each is normalised (lower case, punctuation and white space
folded to single spaces) and looked up among the known licence sentences; what is left of a
document is the sequence of identifiers with their positions. A sentence may be wrapped at
any word, with comment marks before each line. A listed sentence that the
splitter cuts (at a semicolon, say) is known by each of its pieces. A rule is an ordered list of
sentences and matches when the document's sequence holds their pieces in that order (others may
lie between). Every matching rule is reported, also one that is part of a longer one.

Every step is row-local: no shuffle, no Python, and the only table that is shipped is the fixed
list of sentences below. Null and empty texts have no licences and a sequence of length 0; repeated
rows are reported each; a text of any length is one row, whose sentences are cut in one pass.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences and licence notices, by identifier.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-title": "The MIT License",
    "mit-title-short": "MIT License",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "apache-2.0-title": "Apache License",
    "apache-2.0-licensed-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-licensed": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-2.0-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0-required": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "mpl-2.0-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense-domain": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc-by-4.0-licensed": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc0-domain": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
    "all-rights-reserved": "All rights reserved.",
}

# Rules, as (rule, licence, ordered sentence identifiers).
RULES = [
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("mit-title", "MIT", ["mit-title", "mit-grant"]),
    ("mit-title-short", "MIT", ["mit-title-short", "mit-grant"]),
    ("mit-released", "MIT", ["mit-released"]),
    ("mit-licensed", "MIT", ["mit-licensed"]),
    ("apache-2.0-header", "Apache-2.0", ["apache-2.0-licensed", "apache-2.0-copy", "apache-2.0-required", "apache-2.0-see"]),
    ("apache-2.0-notice", "Apache-2.0", ["apache-2.0-licensed"]),
    ("apache-2.0-short", "Apache-2.0", ["apache-2.0-licensed-short"]),
    ("gpl-3.0-header", "GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details"]),
    ("gpl-2.0-header", "GPL-2.0-or-later", ["gpl-2.0-free", "gpl-hope", "gpl-details"]),
    ("gpl-3.0-work", "GPL-3.0-only", ["gpl-3.0-work"]),
    ("lgpl-2.1-header", "LGPL-2.1-or-later", ["lgpl-free", "lgpl-details"]),
    ("bsd-3-clause", "BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"]),
    ("bsd-2-clause", "BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("isc-text", "ISC", ["isc-grant", "isc-warranty"]),
    ("mpl-2.0-header", "MPL-2.0", ["mpl-2.0-subject", "mpl-2.0-copy"]),
    ("mpl-2.0-notice", "MPL-2.0", ["mpl-2.0-subject"]),
    ("unlicense-text", "Unlicense", ["unlicense-domain", "unlicense-anyone"]),
    ("cc-by-4.0", "CC-BY-4.0", ["cc-by-4.0-licensed"]),
    ("cc-by-4.0-short", "CC-BY-4.0", ["cc-by-4.0-short"]),
    ("cc-by-sa-4.0-short", "CC-BY-SA-4.0", ["cc-by-sa-4.0-short"]),
    ("cc-by-nc-4.0-short", "CC-BY-NC-4.0", ["cc-by-nc-4.0-short"]),
    ("cc0-dedication", "CC0-1.0", ["cc0-domain"]),
    ("all-rights-reserved", "Proprietary", ["all-rights-reserved"]),
]

#: A sentence ends after ``.``, ``:``, ``;``, ``!`` or ``?`` before white space, and at a line end unless the
#: next line goes on (begins with a small letter, a bracket or quote, or with capitals after capitals).
SENTENCE_END = (r"(?<=[.:;!?])[ \t\r\n\x0B\f]+|(?<![A-Z,\r\n])[\r\n]+(?![ \t]*[a-z(\"])"
                r"|(?<=[A-Z,])[\r\n]+(?![ \t]*(?:[a-z(\"]|[A-Z]{2}))")
#: A line end that may lie inside a sentence, with the comment marks, indentation and blank lines around it,
#: however many (what follows is a word, so nothing that was taken need be given back).
GAP = r"[ \t*]*[\r\n][^A-Za-z0-9]*+"
#: What normalisation folds to one space.
FOLD = r"[^a-z0-9]+"


def sentence_key(sentence: str) -> str:
    """Normal form of a sentence, as the column expressions compute it."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in sentence)
    return re.sub(FOLD, " ", lowered).strip(" ")


def sentence_parts(sentence: str) -> list[str]:
    """The normalised pieces into which the sentence splitter cuts a known sentence."""
    return [k for k in (sentence_key(p) for p in re.split(SENTENCE_END, sentence)) if k]


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else "[\"'`‘’“”]" if c == '"' else re.escape(c) for c in word)


def wrapping(sentences: dict[str, str] = SENTENCES) -> str:
    """Pattern of the line ends (``GAP``) between words that are neighbours in a known sentence."""
    after: dict[str, set[str]] = {}
    for text in sentences.values():
        for part in re.split(SENTENCE_END, text):
            for m in re.finditer(r"(?<![A-Za-z0-9])([A-Za-z0-9]+)(?=([^A-Za-z0-9]+)([A-Za-z0-9]+))", part):
                # the word and what follows it before a line end
                after.setdefault((m[1] + m[2].split(" ")[0]).lower(), set()).add(m[3].lower())
    by_last: dict[str, list[str]] = {}
    for word, following in sorted(after.items()):
        by_last.setdefault(word[-1], []).append(
            rf"(?<=(?<![A-Za-z0-9]){_any_case(word)}){GAP}(?=(?:{'|'.join(map(_any_case, sorted(following)))})(?![A-Za-z0-9]))")
    pairs = "|".join(f"(?<={_any_case(last)})(?:{'|'.join(group)})" for last, group in by_last.items())
    # cheap tests first: most places are no line end
    return rf"(?=[ \t*]*[\r\n])(?<![ \t*\r\n])(?:{pairs or '(?!)'})"


def known(sentences: dict[str, str] = SENTENCES) -> dict[str, int]:
    """Normalised piece -> number, from 1, in the order of first appearance."""
    out: dict[str, int] = {}
    for text in sentences.values():
        for part in sentence_parts(text):
            out.setdefault(part, len(out) + 1)
    return out


def identifiers(sentences: dict[str, str] = SENTENCES) -> list[str]:
    """Identifier of each number: the sentence's name, with ``/2``, ``/3`` for its further pieces."""
    out: dict[str, str] = {}
    for name, text in sentences.items():
        for i, part in enumerate(sentence_parts(text), 1):
            out.setdefault(part, name if i == 1 else f"{name}/{i}")
    return list(out.values())


def rule_numbers(ids: list[str], sentences: dict[str, str] = SENTENCES) -> list[int]:
    """The numbers that a rule's sentences give, in order."""
    numbers = known(sentences)
    return [numbers[part] for name in ids for part in sentence_parts(sentences[name])]


def normalised(sentence: Column) -> Column:
    lowered = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, FOLD, " "))


def sequence_of(text: Column, numbers: dict[str, int], wrapped: str) -> Column:
    """Array of (number, position, sentence) of a text's known sentences, in order; ``wrapped`` is
    the pattern of their line ends."""
    sentences = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), wrapped, " "), SENTENCE_END)
    keys = F.transform(sentences, normalised)
    places = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("position")))
    hits = F.filter(places, lambda p: p["key"].isin(list(numbers)))
    table = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return F.transform(hits, lambda p: F.struct(F.element_at(table, p["key"]).alias("number"), p["position"].alias("position")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: dict[str, str] = SENTENCES,
         rules: list[tuple[str, str, list[str]]] = RULES) -> DataFrame:
    """doc_id, n_known (licence sentences), sequence (their identifiers in order), positions (their
    sentence numbers), rules (matching rules, sorted), licenses (their licences, sorted), licensed."""
    numbers = known(sentences)
    found = docs.select(F.col(doc_id).alias("doc_id"), sequence_of(F.col(text), numbers, wrapping(sentences)).alias("__hits"))
    found = found.withColumn("__line", F.concat(F.lit(","), F.array_join(F.transform("__hits", lambda h: h["number"].cast("string")), ",,"), F.lit(",")))
    matches = [F.when(F.col("__line").rlike(".*".join(f",{n}," for n in rule_numbers(ids, sentences))), F.struct(F.lit(rule).alias("rule"), F.lit(lic).alias("license")))
               for rule, lic, ids in sorted(rules)]
    found = found.withColumn("__rules", F.when(F.size("__hits") > 0, F.array_compact(F.array(*matches)))
                             .otherwise(F.array().cast("array<struct<rule:string,license:string>>")))
    names = F.array(*[F.lit(x) for x in identifiers(sentences)])
    return found.select(
        "doc_id", F.size("__hits").cast("long").alias("n_known"),
        F.array_join(F.transform("__hits", lambda h: F.element_at(names, h["number"])), ",").alias("sequence"),
        F.array_join(F.transform("__hits", lambda h: h["position"].cast("string")), ",").alias("positions"),
        F.array_join(F.col("__rules.rule"), ",").alias("rules"),
        F.array_join(F.array_sort(F.array_distinct(F.col("__rules.license"))), ",").alias("licenses"),
        (F.size("__rules") > 0).alias("licensed"))

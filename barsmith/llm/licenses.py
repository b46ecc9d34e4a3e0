"""Licence recognition by sentence rules.

A text is cut into sentences, which are normalised (A-Z lower-cased, every run of other
than a-z and 0-9 one space). Sentences that appear in a known licence text or notice
have an identifier; a document becomes the sequence of the identifiers it holds. Rules
are licences' own identifier sequences, ordered from long to short: from left to right
the first rule that matches the next identifiers names a licence, an identifier that
starts no rule is passed over. So a whole licence text counts once, and sentences that
licences share never name one by themselves unless a rule says so.

A known sentence may run over lines: pieces that end at a line's end, blank lines
included, are put together where they make up a known sentence (the longest from left to
right), so wrapping, comment marks and addresses on their own line don't matter. It still
begins at the start and ends at the end of a sentence or line; list marks such as ``1)``
come before it. Other pieces stay sentences of their own.

Everything is Spark SQL functions on one pass over the table, without a shuffle.

Result: ``n_sentences`` (with a letter a-z or digit), ``n_known`` (with an identifier),
``sentence_ids`` and ``licenses`` (in order, joined by blanks / semicolons), ``n_matches``.

Edge cases: a null or empty text has no sentences and no licences (empty strings, zeros).
Lines wrapped inside a sentence (next line starts in lower case) are joined, whatever they
say. The SQL of ``oracle`` knows only these joins: it agrees on texts without a known
sentence that is broken elsewhere or follows a list mark. Sentences repeated in a text
count each time. Rows are judged one by one; other columns are
untouched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import documents

# Well-known licence texts and notices, in their published wording.
# Each entry is a rule: licence, text.
KNOWN_TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("GPL-2.0-or-later", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

WRAPPED = r"([a-z0-9,])[ \t\r]*\n[ \t]*([a-z(])"
SENTENCE_END = r"[.!?;:][ \t\r\n]+|\n+"
STOP = r"[.!?;:][ \t\r\n]+"  # no known sentence goes on behind it
# "1) " or "(a) " at the start of a line; upper-case letters mark places in lower-cased text
LIST_MARK = r"((?:^|\n)[^a-z0-9\n]*(?:[0-9]{1,2}|[a-z]))\)[ \t][^a-z0-9\n.!?;:]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip(" ")


def pieces(text: str) -> list[str]:
    """The normalised sentences of a text, cut at every line that isn't visibly wrapped."""
    return [s for s in map(normalised, re.split(SENTENCE_END, re.sub(WRAPPED, r"\1 \2", text))) if s]


def sentences(text: str, texts=KNOWN_TEXTS) -> list[str]:
    """The normalised sentences of a text, pieces of known ones put together."""
    known = rules(texts)[0]
    longest = max(s.count(" ") for s in known) + 1
    lower = re.sub(WRAPPED, r"\1 \2", text).translate(str.maketrans(UPPER, LOWER))
    out = []
    for run in re.split(STOP, re.sub(LIST_MARK, r"\1L", lower)):
        lines = [(normalised(x.rpartition("L")[2]), normalised(x.replace("L", " ")), "L" in x) for x in run.split("\n")]
        lines = [x for x in lines if x[1]]
        at = 0
        while at < len(lines):
            joined, end, found = lines[at][0], at + 1, None
            while True:
                if joined in known:
                    found = joined, end
                if end == len(lines) or lines[end][2] or joined.count(" ") >= longest:
                    break
                joined, end = f"{joined} {lines[end][0]}", end + 1
            sentence, at = found or (lines[at][1], at + 1)
            out.append(sentence)
    return out


def rules(texts=KNOWN_TEXTS) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """(identifier of each known sentence, (identifier sequence, licence) from long to short)."""
    ids: dict[str, str] = {}
    found = []
    for licence, text in texts:
        found.append((" ".join(ids.setdefault(s, f"s{len(ids) + 1}") for s in pieces(text)) + " ", licence))
    return ids, sorted(found, key=lambda r: -r[0].count(" "))


def _once(value: Column, use) -> Column:
    """``use(value)``, the value computed only once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scan(text: Column, texts=KNOWN_TEXTS) -> Column:
    """The struct of results for one text column."""
    ids, ordered = rules(texts)
    known = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    licence = F.create_map(*[F.lit(x) for pair in ordered for x in pair])
    broken = "|".join(s.replace(" ", "[ \n]") for s in sorted(ids, key=lambda s: (-len(s), s)))
    # words, "H" where a sentence stops, line ends, "L" behind a list mark
    flow = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), WRAPPED, "$1 $2"), UPPER, LOWER)
    for pattern, by in ((LIST_MARK, "$1L"), (STOP, "H"), ("[^a-z0-9HL\n]+", " "), (" ?\n[ \n]*", "\n"), ("[ \n]?H[ \nH]*", "H")):
        flow = F.regexp_replace(flow, pattern, by)

    def of_flow(flow: Column) -> Column:
        hits = F.regexp_extract_all(flow, F.lit(rf"(?<![^HL\n])({broken})(?![^H\n])"), 1)
        cuts = F.when(flow == "", 0).otherwise(F.regexp_count(flow, F.lit("[H\n]")) + 1)
        return _once(hits, lambda hits: of_hits(hits, cuts - F.regexp_count(F.array_join(hits, " "), F.lit("\n"))))

    def of_hits(hits: Column, n_sentences: Column) -> Column:
        return _once(F.transform(hits, lambda s: F.try_element_at(known, F.translate(s, "\n", " "))), lambda found: of_found(found, n_sentences))

    def of_found(found: Column, n_sentences: Column) -> Column:
        sequence = F.when(F.size(found) > 0, F.concat(F.array_join(found, " "), F.lit(" "))).otherwise("")
        matches = F.regexp_extract_all(sequence, F.lit("(" + "|".join(r for r, _ in ordered) + ")"), 1)
        return F.struct(
            n_sentences.cast("long").alias("n_sentences"), F.size(found).cast("long").alias("n_known"),
            F.array_join(found, " ").alias("sentence_ids"),
            F.array_join(F.transform(matches, lambda m: F.try_element_at(licence, m)), ";").alias("licenses"),
            F.size(matches).cast("long").alias("n_matches"),
        )

    return _once(F.btrim(flow, F.lit(" \nH")), of_flow)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", scan(F.col("text")).alias("v")).select("doc_id", "v.*")


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle() -> str:
    """The same by joins on sentence and rule tables instead of maps."""
    ids, ordered = rules()
    known = ", ".join(f"({_literal(s)}, {_literal(i)})" for s, i in ids.items())
    licence = ", ".join(f"({_literal(r)}, {_literal(x)})" for r, x in ordered)
    return rf"""
WITH known(sentence, id) AS (VALUES {known}), licence(rule, name) AS (VALUES {licence}),
numbered AS (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents),
cut AS (
  SELECT row_no, unnest(p) AS part, generate_subscripts(p, 1) AS pos
  FROM (SELECT row_no, regexp_split_to_array(regexp_replace(coalesce(text, ''), '{WRAPPED}', '\1 \2', 'g'), '{SENTENCE_END}') AS p FROM numbered)
), normal AS (
  SELECT row_no, pos, trim(regexp_replace(translate(part, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' ') AS sentence FROM cut
), per_doc AS (
  SELECT row_no, count(*) FILTER (sentence <> '') AS n_sentences, count(id) AS n_known,
         coalesce(string_agg(id, ' ' ORDER BY pos), '') AS sentence_ids
  FROM normal LEFT JOIN known USING (sentence) GROUP BY row_no
), matched AS (
  SELECT row_no, unnest(m) AS rule, generate_subscripts(m, 1) AS pos
  FROM (SELECT row_no, regexp_extract_all(sentence_ids || ' ', '{"|".join(r for r, _ in ordered)}') AS m FROM per_doc)
), named AS (
  SELECT row_no, string_agg(name, ';' ORDER BY pos) AS licenses, count(*) AS n_matches FROM matched JOIN licence USING (rule) GROUP BY row_no
)
SELECT doc_id, n_sentences, n_known, sentence_ids, coalesce(licenses, '') AS licenses, coalesce(n_matches, 0) AS n_matches
FROM numbered JOIN per_doc USING (row_no) LEFT JOIN named USING (row_no)
"""

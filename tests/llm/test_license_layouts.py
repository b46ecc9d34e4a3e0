"""Licence texts in the layout they are published in."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barsmith.llm import licenses

from llm_helpers import make

MIT = """MIT License

Copyright (c) 2020 Some Person

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

APACHE = """Copyright 2020 Some Person

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""

BSD = """Copyright (c) 2020, Some Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

LAYOUTS = {
    "as published": lambda t: t,
    "#": lambda t: "".join(f"# {x}\n" for x in t.split("\n")),
    "//": lambda t: "".join(f"// {x}\n" for x in t.split("\n")),
    "/* */": lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */\nint main() {}\n",
    "crlf": lambda t: t.replace("\n", "\r\n"),
    "1)": lambda t: t.replace("1. R", "1) R").replace("2. R", "(b) R").replace("3. N", "  c)  N"),
    "narrow": lambda t: "\n".join(" ".join(w) for w in _rows(t, 3)),
}


def _rows(text, n):
    for part in text.split("\n\n"):
        found = part.split()
        yield from (found[i : i + n] for i in range(0, len(found), n))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_published_licences_are_named_in_any_layout(spark, layout):
    texts = {"MIT": MIT, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "BSD-3-Clause": BSD}
    if layout == "narrow":  # its rows may begin in the middle of a line before a licence's first sentence
        texts = {name: text[text.index(first) :] for (name, text), first in zip(texts.items(), ("Permission", "Licensed", "This", "Redistribution"))}
    texts = {name: LAYOUTS[layout](text) for name, text in texts.items()}
    rows = make(spark, list(enumerate(texts.values()))).orderBy("doc_id").select("text", licenses.scan(F.col("text")).alias("v")).collect()
    assert [r.v.licenses for r in rows] == list(texts)
    ids = licenses.rules()[0]
    for r in rows:
        found = licenses.sentences(r.text)
        assert (r.v.n_sentences, r.v.sentence_ids) == (len(found), " ".join(ids[s] for s in found if s in ids))


def test_other_lines_stay_sentences_and_longer_sentences_are_not_known(spark):
    texts = ["Not released\nUnder the\nMIT License.", "Released under the.\nMIT License.", "Released under the\n1) MIT License.", "A Title\nReleased Under\nThe MIT License\nThe End"]
    got = make(spark, list(enumerate(texts))).orderBy("doc_id").select(licenses.scan(F.col("text")).alias("v")).collect()
    assert [(r.v.n_sentences, r.v.licenses) for r in got] == [(3, ""), (2, ""), (2, ""), (3, "MIT")]

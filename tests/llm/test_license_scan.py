from __future__ import annotations

import re

import pytest

from tablewarden.llm.common import table
from tablewarden.llm.license_scan import BODIES, PHRASES, compile_template, license_scan, scan, tokens
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in found]
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_whole_table_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op7_license_scan"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {i: slow(t) for i, t in texts.items()}
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert any(r.labels != r.base_labels for r in got)


@pytest.mark.parametrize(
    "markup, text, end",
    [
        ("a [[b]] c", "a c", 2),
        ("a [[b]] c", "A, b: c d", 3),
        ("a [[b]] c", "a b b c", None),
        ("a {{2}} c", "a x c", 3),
        ("a {{2}} c", "a x y c", 4),
        ("a {{2}} c", "a c", None),
        ("a {{2}} c", "a x y z c", None),
        ("a [[b [[c]] d]] e", "a b d e", 4),
        ("[[a b]] c", "c", 1),
        ("a [[c]]", "a c", 2),
        ("a b", "a", None),
    ],
)
def test_automata(markup, text, end):
    assert compile_template("x", markup).match(tokens(text.encode()), 0) == end


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MIT License.", "mit"),
        ("Released under an MIT License.", ""),
        ("Licensed under the Apache License, Version 2.0.", "apache"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("Copyright 2020 Some Body. All rights reserved.", "proprietary,reserved"),
        ("ALL  rights\nreserved", "reserved"),
        ("all writes reserved", ""),
    ],
)
def test_labels(text, labels):
    assert scan(text.encode())["labels"] == labels


def test_odd_rows(rows):
    docs = rows("doc_id BIGINT, text STRING, labels INT, _id STRING", (None, "cc by cc by", 1, "x"), (1, None, 1, "x"), (1, "", 1, "x"), (1, "", 1, "x"), (2, "cc " * 50000 + "by", 1, "x"))
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan(docs).collect()), key=str)
    assert got == sorted([(None, 4, 2, 0, 2, "cc-by"), *[(1, 0, 0, None, None, "")] * 3, (2, 50001, 1, 49999, 49999, "cc-by")], key=str)
    assert license_scan(docs.limit(0)).count() == 0


# A body as it is published: numbered clauses, names, quotes and line breaks.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = "\n3. Neither the name of the Example Group nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."


@pytest.mark.parametrize(
    "text, label",
    [
        (MIT, "mit-text"),
        ("MIT License\n\nCopyright (c) 2020 A. Person\n\n" + MIT + "\n\nMore words.", "mit-text"),
        (BSD.format(third=""), "bsd-text"),
        (BSD.format(third=THIRD), "bsd-text"),
    ],
)
def test_whole_bodies(text, label):
    assert label in scan(text.encode())["labels"].split(",")


@pytest.mark.parametrize(
    "text",
    [
        MIT.replace("without restriction", "without commercial restriction"),
        MIT.replace("use, copy, modify", "use, copy"),
        MIT.replace(" The above copyright", " No fee may be charged. The above copyright").replace("\nThe above copyright", "\nNo fee may be charged. The above copyright"),
        MIT[: len(MIT) // 2],
        BSD.format(third=THIRD.replace("without specific", "with or without specific")),
        BSD.format(third="").replace("are permitted provided that", "are permitted for non-commercial purposes only provided that"),
        "Redistribution and use in source and binary forms, with or without modification, are permitted for non-commercial purposes only after payment",
    ],
)
def test_altered_bodies_are_rejected(text):
    assert not [x for x in scan(text.encode())["labels"].split(",") if x.endswith("-text")]


def test_every_body_accepts_itself_and_no_part_of_itself():
    for label, markup in BODIES:
        words = re.sub(r"\{\{\d+\}\}", "someone", re.sub(r"\[\[|\]\]", "", markup)).split()
        assert label in scan(" ".join(words).encode())["labels"].split(","), label
        for left_out in (0, len(words) // 3, len(words) - 1):
            rest = [w for i, w in enumerate(words) if i != left_out]
            assert label not in scan(" ".join(rest).encode())["labels"].split(",") or words[left_out] in ("1", "2", "3"), (label, words[left_out])


def test_other_notices():
    assert scan(b"This library is licensed under the GNU Lesser General Public License, version 2.1.")["labels"] == "gpl,lgpl"
    assert scan(b"subject to the terms of the Mozilla Public License, v. 2.0.")["labels"] == "mpl"

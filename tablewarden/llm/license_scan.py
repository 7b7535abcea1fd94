"""License scans: phrases, and templates compiled to token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices in template markup (a text that begins like one is accepted, whatever follows; whole bodies are below): [[...]] may be left out, {{n}} stands for one to n words of any kind. All other words
# must be there in this order; case, punctuation and line breaks do not matter.
TEMPLATES = [
    ("mit", "[[this {{4}} is]] released under the [[terms of the]] MIT license"),
    ("mit", "licensed under the [[terms of the]] MIT license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [[the software]] "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "[[the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software]]",
    ),
    ("apache", "licensed under the Apache license [[version {{2}}]] [[the license]] [[you may not use this file except in compliance with the license]]"),
    ("gpl", "this {{3}} is licensed under the GNU [[lesser]] general public license [[version {{1}}]]"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the GNU [[lesser]] general public license [[as published by the free software foundation]]"),
    ("cc-by-nc", "licensed under [[a]] [[creative commons]] CC BY NC [[{{2}}]]"),
    ("cc-by-sa", "licensed under [[a]] [[creative commons]] CC BY SA [[{{2}}]]"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted [[provided that the following conditions are met]]",
    ),
    ("proprietary", "copyright {{6}} all rights reserved"),
    ("public-domain", "[[this {{3}} is]] [[released]] into the public domain"),
    ("lgpl", "this {{3}} is licensed under the GNU lesser general public license [[version {{2}}]]"),
    ("lgpl", "free software you can redistribute it and or modify it under the terms of the GNU lesser general public license [[as published by the free software foundation]]"),
    ("mpl", "subject to the terms of the Mozilla public license [[v {{2}}]] [[version {{2}}]]"),
    ("epl", "made available under the terms of the Eclipse public license [[v {{2}}]] [[{{2}}]]"),
]

_NO_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and [[noninfringement]] [[non infringement]] in no event shall {{12}} be liable for any claim damages or other liability whether in an "
    "action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
_SOLE_RISK = (
    "the software is provided as is and {{12}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
    "in no event shall {{12}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
    "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"
)

# Whole license bodies, from the first word of the grant to the last of the disclaimer. A body in which a mandatory
# word is altered, left out or added is not accepted; its opening may still be, as a notice above.
BODIES = [
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [[the software]] "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software "
        + _NO_WARRANTY,
    ),
    (
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "[[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
        "and or other materials provided with the distribution [[ [[3]] neither the name of {{12}} nor the names of {{6}} contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission ]] this software is provided by {{12}} as is and any express or implied warranties including "
        "but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for any direct "
        "indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way "
        "out of the use of this software even if advised of the possibility of such damage",
    ),
    (
        "isc-text",
        "permission to use copy modify [[and]] [[or]] distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies " + _SOLE_RISK,
    ),
    ("0bsd-text", "permission to use copy modify [[and]] [[or]] distribute this software for any purpose with or without fee is hereby granted " + _SOLE_RISK),
    (
        "unlicense-text",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in "
        "source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or "
        "authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and "
        "to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law " + _NO_WARRANTY,
    ),
    (
        "apache-text",
        "licensed under the Apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "{{8}} unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions "
        "of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
]
TEMPLATES += BODIES


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words; a null text has none."""
    return _WORD.findall((text or b"").lower())


@dataclass(frozen=True)
class Automaton:
    """A straight program. ``words[i]`` is a word, or None for any word; ``jumps[i]`` are places reachable from i without a
    word; ``end`` accepts. ``needed`` counts the words that must be there; ``first`` are the words a match can begin with."""

    label: str
    words: tuple[bytes | None, ...]
    jumps: tuple[tuple[int, ...], ...]
    needed: int
    first: frozenset[bytes]

    def reach(self, places: set[int]) -> set[int]:
        todo, out = list(places), set(places)
        while todo:
            for to in self.jumps[todo.pop()]:
                if to not in out:
                    out.add(to)
                    todo.append(to)
        return out

    def match(self, words: list[bytes], at: int) -> int | None:
        """End of the longest match that begins at ``at``."""
        end, best = len(self.words), None
        now = self.reach({0})
        for i in range(at, len(words) + 1):
            if end in now:
                best = i
            if i == len(words):
                break
            now = self.reach({p + 1 for p in now if p < end and (self.words[p] is None or self.words[p] == words[i])})
            if not now:
                break
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """Optional regions become jumps over them, replaceable ones a row of optional wildcards after a first."""
    words: list[bytes | None] = []
    jumps: dict[int, set[int]] = {}
    opened: list[int] = []
    needed = 0
    for part in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
        if part == "[[":
            opened.append(len(words))
        elif part == "]]":
            jumps.setdefault(opened.pop(), set()).add(len(words))
        elif part.startswith("{{"):
            most = int(part[2:-2])
            last = len(words) + most
            for i in range(most):
                if i:
                    jumps.setdefault(len(words), set()).add(last)
                words.append(None)
            needed += not opened
        else:
            for word in tokens(part.encode()):
                words.append(word)
                needed += not opened
    table = tuple(tuple(sorted(jumps.get(i, ()))) for i in range(len(words) + 1))
    bare = Automaton(label, tuple(words), table, needed, frozenset())
    first = frozenset(words[p] for p in bare.reach({0}) if p < len(words))
    if None in first or len(words) in bare.reach({0}):
        raise ValueError("a template must begin with a word")
    return Automaton(label, tuple(words), table, needed, first)


@lru_cache(maxsize=4)
def _automata(templates: tuple[tuple[str, str], ...]) -> dict[bytes, list[Automaton]]:
    by_first: dict[bytes, list[Automaton]] = {}
    for label, markup in templates:
        made = compile_template(label, markup)
        for word in made.first:
            by_first.setdefault(word, []).append(made)
    return by_first


def scan(text: bytes | None, phrases: dict[str, str] = PHRASES, templates: tuple[tuple[str, str], ...] = tuple(TEMPLATES)) -> dict:
    """Counts, places and labels of one text. The score is 1 where a template is accepted, one half where only a
    phrase stands, else 0."""
    words = tokens(text)
    by_phrase = [(p.encode().split(), label) for p, label in phrases.items()]
    by_first = _automata(templates)
    anchors = {p[0] for p, _ in by_phrase} | set(by_first)
    places, base, labels, score = [], set(), set(), 0.0
    for i, word in enumerate(words):
        if word not in anchors:
            continue
        for phrase, label in by_phrase:
            if phrase[0] == word and words[i : i + len(phrase)] == phrase:
                places.append(i)
                base.add(label)
                score = max(score, 0.5)
        for automaton in by_first.get(word, ()):
            if automaton.label not in labels and automaton.match(words, i) is not None:
                labels.add(automaton.label)
                score = 1.0
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": places[0] if places else None,
        "last_word": places[-1] if places else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | labels)),
        "score": score,
    }


DDL = "n_words BIGINT, n_base BIGINT, first_word BIGINT, last_word BIGINT, base_labels STRING, labels STRING, score DOUBLE"


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the scan of every row's whole text.

    Null and empty texts have no words, no labels and the score 0. Null and repeated keys are scanned row by row; other
    columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in DDL.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            columns = [pa.array([f[n] for f in found], k) for n, k in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_id", *names])

    made = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, f"_id {kind}, {DDL}")
    return made.withColumnRenamed("_id", key)

"""Operator 9: licence scans by template-markup matching.

A template is wording with ``[[optional words]]`` regions and ``{{name:min-max}}``
replaceable regions of that many words.  It compiles to an automaton over word
hashes; a text carries the licence when some run of its consecutive words takes
the automaton from its first to its last state, so the mandatory wording has to
match exactly.  A second, plain rule finds fixed phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelforge.llm.arrowtext import ALNUM, lower, segment, slices, word_hashes

#: The phrases whose places are counted, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_BSD_HEAD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "[[{0}]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[[{1}]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
    "and or other materials provided with the distribution "
)
_BSD_NAMES = (
    "neither the name of {{org:1-20}} nor the names of [[its]] contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission "
)
_BSD_ADVERTISING = (
    "[[3]] all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software "
    "developed by {{org:1-20}} [[4]] "
)
_BSD_TAIL = (
    "this software is provided by {{holder:1-20}} as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed in no event shall {{holder:1-20}} be liable for any direct indirect incidental special "
    "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business "
    "interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way "
    "out of the use of this software even if advised of the possibility of such damage"
)
_GPL = (
    "this {0} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] general public license as published by the free "
    "software foundation [[either]] version {{{{number:1-2}}}} of the license [[or at your option any later version]] this {0} is distributed in the hope that it "
    "will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu [[lesser]] "
    "general public license for more details you should have received a copy of the gnu [[lesser]] general public license along with this {0}"
)


def _bsd(middle: str, *bullets: str) -> str:
    return _BSD_HEAD.replace("{0}", bullets[0]).replace("{1}", bullets[1]) + middle + _BSD_TAIL


#: Fixed values: (label, template).  Every template begins with two mandatory words.  A template is a whole one-line notice or the whole wording of a licence
#: (of its customary notice for apache and gpl), from its grant to the end of its disclaimer.
TEMPLATES = [
    ("mit", "released under the [[terms of the]] mit license"),
    ("mit", "licensed under the [[terms of the]] mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of {{work:1-8}} and associated documentation files the software to deal in the "
        "software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
        "software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission "
        "notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is provided as is without "
        "warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall {{holder:1-20}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of "
        "or in connection with the software or the use or other dealings in the software",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    (
        "apache",
        "licensed under the apache license [[version]] 2 0 the license you may not use {{work:1-6}} except in compliance with the license you may obtain a copy of the "
        "license at {{scheme:1-1}} www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license "
        "is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing "
        "permissions and limitations under the license",
    ),
    ("gpl", "licensed under the gnu [[lesser]] general public license version {{number:1-1}}"),
    *[("gpl", _GPL.format(work)) for work in ("program", "library")],
    ("cc-by", "licensed under [[a]] [[creative commons]] cc by {{number:1-1}} 0"),
    ("cc-by-nc", "licensed under [[a]] [[creative commons]] cc by nc {{number:1-1}} 0"),
    *[
        ("bsd", _bsd(middle, *bullets))
        for bullets in (("1", "2"), ("a", "b"))
        for middle in ("", f"[[{'3' if bullets[0] == '1' else 'c'}]] {_BSD_NAMES}", _BSD_ADVERTISING + _BSD_NAMES)
    ],
    (
        "isc",
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
        "notice and this permission notice appear in all copies the software is provided as is and {{author:1-10}} disclaims all warranties with regard to this software "
        "including all implied warranties of merchantability and fitness in no event shall {{author:1-20}} be liable for any special direct indirect or consequential "
        "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out "
        "of or in connection with the use or performance of this software",
    ),
]

_MARKUP = re.compile(r"\[\[(.*?)\]\]|\{\{\w+:(\d+)-(\d+)\}\}|([^\s\[\]{}]+)")


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes that ``word_hashes`` gives these words inside any text."""
    raw = [w.encode("utf-8") for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)


class Automaton:
    """Word automaton of one template: steps[state] = [(word hash or None for any, next state)], skips[state] = states reached freely."""

    def __init__(self, template: str):
        self.steps: list[list[tuple[int | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        first: list[str] = []
        plain = True
        for optional, least, most, word in _MARKUP.findall(template):
            if word:
                self._word(word)
                if plain:
                    first.append(word)
                continue
            plain = False
            if optional:
                start = len(self.steps) - 1
                for w in optional.split():
                    self._word(w)
                self.skips[start].append(len(self.steps) - 1)
            else:
                for _ in range(int(least)):
                    self._step(None)
                free = []
                for _ in range(int(most) - int(least)):
                    free.append(len(self.steps) - 1)
                    self._step(None)
                for state in free:
                    self.skips[state].append(len(self.steps) - 1)
        if len(first) < 2:
            raise ValueError("a template begins with two mandatory words")
        self.first = tuple(hash_words(first[:2]).tolist())
        self.last = len(self.steps) - 1

    def _step(self, what: int | None) -> None:
        self.steps[-1].append((what, len(self.steps)))
        self.steps.append([])
        self.skips.append([])

    def _word(self, word: str) -> None:
        self._step(int(hash_words([word])[0]))

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for nxt in self.skips[todo.pop()]:
                if nxt not in states:
                    states.add(nxt)
                    todo.append(nxt)
        return states

    def accepts(self, words: np.ndarray, at: int, end: int) -> bool:
        """Does the run of words that starts at ``at`` (inside a text that ends at ``end``) reach the last state?"""
        states = self._closed({0})
        while self.last not in states:
            if at >= end or not states:
                return False
            word = int(words[at])
            states = self._closed({n for s in states for what, n in self.steps[s] if what is None or what == word})
            at += 1
        return True


def template_regex(template: str) -> str:
    """The same language as a regular expression over words joined by one space (for SQL)."""
    out = ""
    for optional, least, most, word in _MARKUP.findall(template):
        if word:
            out += f" {word}"
        elif optional:
            out += f"( {optional})?"
        else:
            out += f"( [^ ]+){{{least},{most}}}"
    return out[1:]


def scan(
    documents: DataFrame,
    *,
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z
    lower-cased.  ``n_base`` counts all places of all phrases; ``first_word`` and
    ``last_word`` are their smallest and largest start (null without one).  Labels
    are distinct, sorted, comma-joined, '' without any.  Score: 1.0 when a
    template is accepted, 0.5 for a phrase alone, else 0.0.  A null or empty text
    has no words; repeated rows repeat; other columns are not read.
    """
    wanted = PHRASES if phrases is None else phrases
    forms = TEMPLATES if templates is None else templates

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(hash_words(p.split()), label) for p, label in wanted.items()]
        automata = [(label, Automaton(t)) for label, t in forms]
        by_first: dict[tuple, list] = {}
        for label, automaton in automata:
            by_first.setdefault(automaton.first, []).append((label, automaton))
        for batch in batches:
            for rows, data, offsets in slices(batch, text_col):
                starts, ends, first = segment(low := lower(data), offsets, ALNUM)
                words = word_hashes(low, starts, ends)
                size = rows.num_rows
                count = np.zeros(size, np.int64)
                low_at, high_at = np.full(size, 1 << 60), np.full(size, -1)
                base: list[set] = [set() for _ in range(size)]
                more: list[set] = [set() for _ in range(size)]
                where = np.repeat(np.arange(size), np.diff(first))

                def places(run_of: np.ndarray) -> np.ndarray:
                    k = len(run_of)
                    if len(words) < k:
                        return np.zeros(0, np.int64)
                    at = np.flatnonzero(words[: len(words) - k + 1] == run_of[0])
                    for j in range(1, k):
                        at = at[words[at + j] == run_of[j]]
                    return at[at + k <= first[where[at] + 1]] if len(at) else at

                for run_of, label in known:
                    at = places(run_of)
                    doc = where[at] if len(at) else at
                    np.add.at(count, doc, 1)
                    np.minimum.at(low_at, doc, at - first[doc])
                    np.maximum.at(high_at, doc, at - first[doc])
                    for d in np.unique(doc).tolist():
                        base[d].add(label)
                for head, group in by_first.items():
                    for at in places(np.array(head, dtype=np.uint64)).tolist():
                        d = int(where[at])
                        for label, automaton in group:
                            if label not in more[d] and automaton.accepts(words, at, int(first[d + 1])):
                                more[d].add(label)
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(count),
                        pa.array(low_at.astype(np.int64), mask=none),
                        pa.array(high_at.astype(np.int64), mask=none),
                        pa.array([",".join(sorted(b)) for b in base]),
                        pa.array([",".join(sorted(b | m)) for b, m in zip(base, more, strict=True)]),
                        pa.array([1.0 if m else 0.5 if b else 0.0 for b, m in zip(base, more, strict=True)]),
                    ],
                    names=[id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(
        run,
        f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    )

"""License scan by matching template markup.

A template is license wording with markup: ``<<beginOptional>>`` ... ``<<endOptional>>`` encloses what may be left
out, ``<<var;name="...";match="a,b">>`` stands for a to b words of any kind. Its words are compiled to an automaton
over words that accepts any stretch of a text whose mandatory wording matches word by word. All templates run as one
automaton whose sets of states are numbered as they are met. Plain phrases are templates without markup.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.work import map_arrow

# Fixed values of the contract.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

TEMPLATES = {
    "apache-2.0-notice": """Licensed under the Apache License<<beginOptional>>, Version<<endOptional>> 2.0""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        <<var;name="what";match="1,3">> except in compliance with the License. You may obtain a copy of the License
        at <<beginOptional>>http<<endOptional>><<beginOptional>>https<<endOptional>>://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "mit-notice": """<<var;name="verb";match="1,1">> under the <<beginOptional>>terms of the <<endOptional>>MIT License""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "<<var;name="name";match="1,2">>"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
        do so, subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the Software.""",
    "gpl-3.0-notice": """<<beginOptional>>is <<endOptional>>licensed under the <<beginOptional>>terms of the
        <<endOptional>>GNU General Public License<<beginOptional>>, version<<endOptional>> 3""",
    "bsd-3-clause-text": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions
        of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of
        <<var;name="holder";match="1,12">> nor the names of its contributors may be used""",
    "cc-by-nc-4.0-notice": """licensed under <<beginOptional>>the <<endOptional>><<beginOptional>>Creative Commons
        <<endOptional>>CC BY-NC 4.0""",
}

SLICE_BYTES = 1 << 20
# Words are digits, letters a to z and everything beyond ASCII; the rest separates.
_FOLD = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_ANY = None


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def _parsed(markup: str) -> list:
    """Items of a template: a word, ("var", least, most), or ("optional", items)."""
    stack: list[list] = [[]]
    for i, part in enumerate(_MARK.split(markup)):
        if i % 2 == 0:
            stack[-1].extend(words_of(part.encode()))
        elif part == "beginOptional":
            stack.append([])
        elif part == "endOptional":
            if len(stack) == 1:
                raise ValueError("an optional region ends that has not begun")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            match = re.search(r'match="(\d+),(\d+)"', part)
            if not match or int(match[1]) > int(match[2]):
                raise ValueError(f"a replaceable region needs match=\"least,most\": {part}")
            stack[-1].append(("var", int(match[1]), int(match[2])))
    if len(stack) != 1:
        raise ValueError("an optional region does not end")
    return stack[0]


class Automaton:
    """All templates at once. ``feed`` goes on from word to word and tells where a template has been accepted."""

    def __init__(self, templates: dict[str, str]):
        self.moves: list[list[tuple[bytes | None, int]]] = []
        self.skips: list[list[int]] = []
        self.accepts: dict[int, str] = {}
        self.mandatory: dict[str, frozenset[bytes]] = {}
        starts = []
        for label, markup in templates.items():
            items = _parsed(markup)
            self.mandatory[label] = frozenset(x for x in items if isinstance(x, bytes))
            if not self.mandatory[label]:
                raise ValueError(f"template {label} has no mandatory word")
            start = self._state()
            starts.append(start)
            self.accepts[self._chain(start, items)] = label
        self.words = {w for moves in self.moves for w, _ in moves if w is not _ANY}
        self.first = self._closed(starts)
        # sets of states by number; what follows each, by word
        self.numbers: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.next: list[dict[bytes | None, int]] = []
        self.labels: list[tuple[str, ...]] = []
        self._number(self.first)

    def _state(self) -> int:
        self.moves.append([])
        self.skips.append([])
        return len(self.moves) - 1

    def _chain(self, at: int, items: list) -> int:
        for item in items:
            if isinstance(item, bytes):
                to = self._state()
                self.moves[at].append((item, to))
            elif item[0] == "optional":
                to = self._chain(at, item[1])
                if to != at:
                    end = self._state()
                    self.skips[to].append(end)
                    self.skips[at].append(end)
                    to = end
            else:
                end = self._state()
                for k in range(item[2]):
                    if k >= item[1]:
                        self.skips[at].append(end)
                    to = self._state()
                    self.moves[at].append((_ANY, to))
                    at = to
                self.skips[at].append(end)
                to = end
            at = to
        return at

    def _closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def _number(self, states: frozenset[int]) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.next.append({})
            self.labels.append(tuple(sorted({self.accepts[s] for s in states if s in self.accepts})))
        return self.numbers[states]

    def feed(self, at: int, words: list[bytes]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(state, index, labels) where templates end, and at last (state, -1, ())."""
        known, following, labels = self.words, self.next, self.labels
        for i, word in enumerate(words):
            if word not in known:
                word = _ANY
            to = following[at].get(word, -1)
            if to < 0:
                reached = [s for state in self.sets[at] for w, s in self.moves[state] if w is _ANY or w == word]
                to = self._number(self._closed([*reached, *self.first]))
                following[at][word] = to
            at = to
            if labels[at]:
                yield at, i, labels[at]
        yield at, -1, ()


@cache
def _automaton() -> Automaton:
    return Automaton({**PHRASES, **TEMPLATES})


def _slices(data: bytes) -> Iterator[bytes]:
    """Parts of about ``SLICE_BYTES`` that end between words."""
    start = 0
    while start < len(data):
        end = min(len(data), start + SLICE_BYTES)
        while end < len(data) and _FOLD[data[end]] != 32:
            end += 1
        yield data[start:end]
        start = end


def scan_text(text: str | None, automaton: Automaton) -> tuple[int, list[tuple[str, int]]]:
    """Number of words, and (label, index of the last word) of each acceptance."""
    data = (text or "").encode()
    n, seen = 0, set()
    for part in _slices(data):
        words = words_of(part)
        n += len(words)
        seen |= automaton.words.intersection(words)
    if not any(need <= seen for need in automaton.mandatory.values()):
        return n, []
    state, offset, found = 0, 0, []
    for part in _slices(data):
        words = words_of(part)
        for state, i, labels in automaton.feed(state, words):
            found += [(label, offset + i) for label in labels]
        offset += len(words)
    return n, found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    length = {label: len(phrase.split()) for label, phrase in PHRASES.items()}
    for batch in batches:
        rows = []
        for value in batch.column(1):
            n, found = scan_text(value.as_py(), automaton)
            starts = [at - length[label] + 1 for label, at in found if label in length]
            labels = sorted({label for label, _ in found})
            base = [label for label in labels if label in length]
            score = 1.0 if len(labels) > len(base) else 0.5 if base else 0.0
            rows.append((n, len(starts), min(starts, default=None), max(starts, default=None),
                         ",".join(base), ",".join(labels), score))
        columns = list(zip(*rows)) if rows else [()] * 7
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
            ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``n_base`` counts the places of the plain phrases, ``first_word`` and ``last_word`` are the smallest and largest
    of their starts (null without any). ``labels`` adds the templates found. The score is 1 if a template with
    markup matches, 0.5 if only phrases do, else 0. A null text is empty: no words, empty labels. Texts are read
    whole, in slices; repeated rows are repeated, other columns ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
        "last_word long, base_labels string, labels string, score double"
    )
    return map_arrow(rows, _scan, schema).withColumnRenamed("id", id_col)

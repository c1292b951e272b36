"""License scan by template markup: licence texts with optional and replaceable regions, compiled to token automata.

Markup: plain words are mandatory; ``[[...]]`` may be left out; ``{{n}}`` stands for up to n words of any kind (names,
years). A text matches when some run of its words is accepted by the automaton, so mandatory wording must be exact and
in order, while case and punctuation don't count. Licences are whole texts, conditions and disclaimer included: one with a
condition changed or added is not accepted. A template is run on texts in which some mandatory run begins (its first ``ANCHOR``
words), from the places where one of the template's first words stands.

Score: 1 where a template accepts; else the largest share of a template's mandatory words that a run of words got
through in order, at least 0.5 where a base phrase stands; 0 without either.

Defined results: null and empty texts have no words, labels '' and score 0; a document given twice is judged twice;
overlapping places all count; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from bidtide.llm.text import alnum_words, per_batch, small_batches, utf8

# Phrases of the contract, and the wording of public licences and their usual notices.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
the {{3}} to deal in the {{2}} without restriction including without limitation the rights to use copy modify merge publish distribute
sublicense and or sell copies of the {{2}} and to permit persons to whom the {{2}} is furnished to do so subject to the following conditions
the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial
portions of the {{2}}
the {{2}} is provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and [[non]] [[infringement]] [[noninfringement]] in no event shall {{8}} be liable for any
claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the {{2}} or
the use or other dealings in the {{2}}"""
_BSD_2 = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
[[1]] [[a]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
[[2]] [[b]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in
the documentation and or other materials provided with the distribution"""
_BSD_3 = """[[3]] [[c]] neither the name of {{8}} nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission"""
_BSD_DISCLAIMER = """this software is provided by {{8}} as is and any express or implied warranties including but not limited to the implied warranties of
merchantability and fitness for a particular purpose are disclaimed in no event shall {{8}} be liable for any direct indirect incidental
special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or
profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including
negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
_ISC = """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the
above copyright notice and this permission notice appear in all copies
the software is provided as is and {{4}} disclaims all warranties with regard to this software including all implied warranties of
merchantability and fitness in no event shall {{4}} be liable for any special direct indirect or consequential damages or any damages
whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out
of or in connection with the use or performance of this software"""
TEMPLATES = [
    ("mit", "[[released]] [[licensed]] [[distributed]] [[available]] under the [[terms of the]] mit license"),
    ("mit", _MIT),
    ("apache-2", "[[licensed under]] the apache license version 2 0 [[the license]]"),
    ("gpl-3", "[[this {{2}} is]] licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 3 [[of the license]] [[or at your option any later version]]"),
    ("gpl-2", "[[this {{2}} is]] licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 2 [[of the license]] [[or at your option any later version]]"),
    ("cc-by-nc-4", "[[this {{2}} is]] licensed under [[a]] [[creative commons]] cc by nc 4 0 [[international]] [[license]]"),
    ("cc-by-4", "[[this {{2}} is]] licensed under [[a]] [[creative commons]] cc by 4 0 [[international]] [[license]]"),
    ("isc", _ISC),
    ("bsd-2", f"{_BSD_2} {_BSD_DISCLAIMER}"),
    ("bsd-3", f"{_BSD_2} {_BSD_3} {_BSD_DISCLAIMER}"),
]
#: Words of a mandatory run that make a text a candidate for its template.
ANCHOR = 4
_MARK = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+")


@dataclass
class TokenAutomaton:
    """States 0 (start) to ``accepting``; a step reads one word, or any word from a state in ``anything``."""

    label: str
    steps: list[dict[bytes, int]]
    anything: list[int]
    skips: list[list[int]]
    depth: list[int]
    accepting: int
    mandatory: int
    anchors: list[bytes]

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.skips[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def furthest(self, words: list[bytes], start: int) -> tuple[bool, int]:
        """Whether a run from ``start`` is accepted, and the most mandatory words got through."""
        states, best = self.closed({0}), 0
        for at in range(start, len(words)):
            word = words[at]
            moved = {self.steps[s][word] for s in states if word in self.steps[s]} | {s + 1 for s in self.anything if s in states}
            if not moved:
                break
            states = self.closed(moved)
            best = max(best, *(self.depth[s] for s in states))
            if self.accepting in states:
                return True, self.mandatory
        return False, best

    def first_words(self) -> set[bytes]:
        return {word for state in self.closed({0}) for word in self.steps[state]}


def _anchors(runs: list[list[bytes]]) -> list[bytes]:
    """The first words of every long mandatory run, or the longest run if all are short."""
    long = [run for run in runs if len(run) >= ANCHOR] or [max(runs, key=len)]
    return [b" " + b" ".join(run[:ANCHOR]) + b" " for run in long]


def compile_template(label: str, template: str) -> TokenAutomaton:
    """An automaton whose states follow the template's words in order; optional regions are skips over states."""
    steps: list[dict[bytes, int]] = [{}]
    skips: list[list[int]] = [[]]
    depth, anything, opened, runs = [0], [], [], [[]]

    def add_state(mandatory: int) -> int:
        steps.append({})
        skips.append([])
        depth.append(depth[-1] + mandatory)
        return len(steps) - 1

    for mark in _MARK.findall(template.lower()):
        here = len(steps) - 1
        if mark == "[[":
            opened.append(here)
            runs.append([])
        elif mark == "]]":
            skips[opened.pop()].append(here)
            runs.append([])
        elif mark.startswith("{{"):
            for _ in range(int(mark[2:-2])):
                anything.append(len(steps) - 1)
                skips[len(steps) - 1].append(here + int(mark[2:-2]))
                add_state(0)
            runs.append([])
        else:
            steps[here][mark.encode()] = add_state(0 if opened else 1)
            if not opened:
                runs[-1].append(mark.encode())
    return TokenAutomaton(label, steps, anything, skips, depth, len(steps) - 1, depth[-1], _anchors(runs))


def _places(joined: bytes, phrase: bytes) -> list[int]:
    found, number, counted, at = [], 0, 0, joined.find(phrase)
    while at >= 0:
        number += joined.count(b" ", counted, at)
        counted = at
        found.append(number)
        at = joined.find(phrase, at + 1)
    return found


def license_labels(docs: DataFrame, base: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score."""
    small_batches(docs)
    phrases = [(f" {k} ".encode(), label) for k, label in (BASE if base is None else base).items()]
    automata = [compile_template(*t) for t in (TEMPLATES if templates is None else templates)]
    starts = [(a, a.first_words()) for a in automata]
    columns = {
        "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
        "base_labels": pa.list_(pa.string()), "labels": pa.list_(pa.string()), "score": pa.float64(),
    }

    def judged(text: bytes) -> tuple:
        words = alnum_words(text)
        joined = b" " + b" ".join(words) + b" "
        places, labels, score = [], set(), 0.0
        for phrase, label in phrases:
            if found := _places(joined, phrase):
                places += found
                labels.add(label)
                score = 0.5
        own = set(labels)
        for automaton, first in starts:
            if not any(anchor in joined for anchor in automaton.anchors):
                continue
            for start in (i for i, w in enumerate(words) if w in first):
                accepted, depth = automaton.furthest(words, start)
                score = max(score, depth / automaton.mandatory)
                if accepted:
                    own.add(automaton.label)
                    break
        return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels), sorted(own), score

    def rows(batch: pa.RecordBatch) -> dict:
        found = [judged(text) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id")} | {name: pa.array([row[i] for row in found], kind) for i, (name, kind) in enumerate(columns.items())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double"
    return per_batch(docs.select("doc_id", utf8().alias("text")), schema, rows)

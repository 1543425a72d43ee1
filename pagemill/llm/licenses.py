"""License scans: phrases, and license texts matched by templates compiled into token automata.

A template is wording with marked regions: ``<<optional>> ... <<end>>`` may be left out as a whole (regions may be
nested), ``<<any 0-9>>`` stands for so many words of any kind.  All else is mandatory, word by word.  Each template
becomes an automaton over words; a text holds the license if a stretch of its words is accepted, the longest from each
start, from left to right.  Sets of states are made into single states as they are met, and kept.

Only places where a template can open (its first two words, or one where the second is free) are tried: they are found
by searching the text's words, joined by single spaces.  A place is left at the first word that no state accepts.

Base labels come from phrases, wherever their words stand consecutively.  ``score`` is the share of a text's words that
lie in a phrase or an accepted stretch.

Defined cases: null and empty texts have no words and the score 0; punctuation, case (A-Z) and line breaks play no part;
very long texts are searched whole; repeated rows each get their result; an empty table gives no rows; other columns are
left out, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_WARRANTY = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
_BSD_OPENS = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_BSD_SOURCE = "<<optional>>1<<end>> redistributions of source code must retain the <<optional>>above<<end>> copyright notice this list of conditions and the following disclaimer"
_BSD_BINARY = "<<optional>>2<<end>> redistributions in binary form must reproduce the <<optional>>above<<end>> copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_NAMES = "<<optional>>3<<end>> neither the name of <<any 1-12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_ENDS = "this software is provided by <<any 1-12>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
_GNU = "under the <<optional>>terms of the<<end>> gnu <<optional>>{0}<<end>> general public license <<optional>>as published by the free software foundation either<<end>> version {1}"
#: Wording by label; a label may have several.
TEMPLATES = (
    ("mit", f"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or substantial portions of the software {_WARRANTY} <<optional>>in no event shall <<any 1-12>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software<<end>>"),
    ("mit", "<<optional>>licensed<<end>> <<optional>>released<<end>> under the <<optional>>terms of the<<end>> mit license"),
    ("isc", "permission to use copy modify <<optional>>and or<<end>> <<optional>>and<<end>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies <<optional>>the software is provided as is and <<any 1-12>> disclaims all warranties with regard to this software<<end>>"),
    ("bsd-2-clause", f"{_BSD_OPENS} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_ENDS}"),
    ("bsd-3-clause", f"{_BSD_OPENS} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES} {_BSD_ENDS}"),
    ("apache-2", "licensed under the apache license version 2 <<optional>>0<<end>> <<optional>>the license you may not use this file except in compliance with the license you may obtain a copy of the license at <<any 1-12>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied<<end>>"),
    ("gpl-2", "<<optional>>licensed<<end>> " + _GNU.format("", "2").replace(" <<optional>><<end>>", "") + " <<optional>>of the license<<end>> <<optional>>or at your option any later version<<end>>"),
    ("gpl-3", "<<optional>>licensed<<end>> " + _GNU.format("", "3").replace(" <<optional>><<end>>", "") + " <<optional>>of the license<<end>> <<optional>>or at your option any later version<<end>>"),
    ("lgpl", "<<optional>>licensed<<end>> under the <<optional>>terms of the<<end>> gnu lesser general public license <<optional>>as published by the free software foundation either<<end>> version <<any 1-1>>"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 <<optional>>if a copy of the mpl was not distributed with this file you can obtain one at <<any 1-1>> mozilla org mpl 2 0<<end>>"),
    ("cc-by-nc", "<<optional>>licensed<<end>> under <<optional>>a<<end>> <<optional>>the<<end>> creative commons attribution noncommercial <<any 0-2>> license"),
    ("cc-by-sa", "<<optional>>licensed<<end>> under <<optional>>a<<end>> <<optional>>the<<end>> creative commons attribution sharealike <<any 0-2>> license"),
    ("cc-by", "<<optional>>licensed<<end>> under <<optional>>a<<end>> <<optional>>the<<end>> creative commons attribution <<optional>>4 0<<end>> <<optional>>3 0<<end>> <<optional>>international<<end>> license"),
    ("cc-by-nc", "licensed under cc by nc <<optional>>4 0<<end>> <<optional>>3 0<<end>>"),
    ("cc-by-sa", "licensed under cc by sa <<optional>>4 0<<end>> <<optional>>3 0<<end>>"),
    ("unlicense", "this is free and unencumbered software released into the public domain <<optional>>anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means<<end>>"),
    ("all-rights-reserved", "<<optional>>copyright <<optional>>c<<end>> <<any 1-8>><<end>> all rights reserved"),
)
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Automaton:
    """The stretches of words that a template accepts.

    ``_edges``: by state, (word or None for any, next state); ``_free``: by state, states that it may pass to without a word.
    """

    def __init__(self, template: str):
        self._edges: list[list[tuple[bytes | None, int]]] = [[]]
        self._free: list[list[int]] = [[]]
        at, opened = 0, []
        for m in re.finditer(r"<<(optional|end|any)(?: (\d+)-(\d+))?>>|([^\s<>]+)", template):
            kind, least, most, word = m.groups()
            if word:
                at = self._step(at, word.encode())
            elif kind == "optional":
                opened.append(at)
            elif kind == "end":
                at = self._pass(at)
                self._free[opened.pop()].append(at)
            else:
                after = self._pass(at) if least == "0" else None
                for i in range(int(most)):
                    at = self._step(at, None)
                    if i + 1 == int(least):
                        after = self._pass(at)
                    elif i + 1 > int(least):
                        self._free[at].append(after)
                at = after
        if opened:
            raise ValueError(f"an optional region has no end: {template}")
        self._last = at
        self._sets: dict[frozenset[int], int] = {}
        self._of: list[frozenset[int]] = []
        self._next: list[dict[bytes | None, int]] = []
        self.accepts: list[bool] = []
        self.begin = self._state(frozenset([0]))
        if self.accepts[self.begin] or any(w is None for s in self._of[self.begin] for w, _ in self._edges[s]):
            raise ValueError(f"a template must open with a word: {template}")

    def _new(self) -> int:
        self._edges.append([])
        self._free.append([])
        return len(self._edges) - 1

    def _step(self, at: int, word: bytes | None) -> int:
        self._edges[at].append((word, self._new()))
        return len(self._edges) - 1

    def _pass(self, at: int) -> int:
        self._free[at].append(self._new())
        return len(self._edges) - 1

    def _state(self, states: frozenset[int]) -> int:
        """The number of a set of states, with all that they may pass to."""
        reached, todo = set(states), list(states)
        while todo:
            for s in self._free[todo.pop()]:
                if s not in reached:
                    reached.add(s)
                    todo.append(s)
        whole = frozenset(reached)
        if whole not in self._sets:
            self._sets[whole] = len(self._of)
            self._of.append(whole)
            self.accepts.append(self._last in whole)
            known: dict[bytes | None, int] = {}
            self._next.append(known)
            words = {w for s in whole for w, _ in self._edges[s]}
            for w in words:  # each word of the template by itself; None: any other
                known[w] = -1
        return self._sets[whole]

    def step(self, state: int, word: bytes) -> int | None:
        known = self._next[state]
        key = word if word in known else None
        to = known.get(key)
        if to == -1:
            to = known[key] = self._state(frozenset(t for s in self._of[state] for w, t in self._edges[s] if w is None or w == key))
        return to

    def openings(self) -> set[tuple[bytes, ...]]:
        """The first one or two words of accepted stretches: two where the second is told, one where it's free or none need follow."""
        out: set[tuple[bytes, ...]] = set()
        for one in [w for w in self._next[self.begin] if w is not None]:
            state = self.step(self.begin, one)
            if self.accepts[state] or None in self._next[state]:
                out.add((one,))
            else:
                out |= {(one, two) for two in self._next[state]}
        return out

    def longest(self, words: Sequence[bytes], at: int) -> int:
        """Where the longest accepted stretch from ``at`` ends; ``at`` if there is none."""
        state, end = self.begin, at
        for i in range(at, len(words)):
            state = self.step(state, words[i])
            if state is None:
                break
            if self.accepts[state]:
                end = i + 1
        return end


def _places(line: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which ``phrase`` (between spaces) stands in ``line``."""
    at, number, counted = line.find(phrase), 0, 0
    while at >= 0:
        number, counted = number + line.count(b" ", counted, at), at
        yield number
        at = line.find(phrase, at + 1)


class Scanner:
    """Phrases and templates, in the form in which texts are searched for them."""

    def __init__(self, phrases: dict[str, str], templates: Iterable[tuple[str, str]]):
        self.phrases = [(f" {p} ".encode(), len(p.split()), label) for p, label in phrases.items()]
        self.templates = [(label, a, [b" " + b" ".join(o) + b" " for o in sorted(a.openings())]) for label, a in ((label, Automaton(t)) for label, t in templates)]
        self.openings = {o for _, _, all_ in self.templates for o in all_}

    def spans(self, text: bytes) -> tuple[int, list[tuple[int, int, str, bool]]]:
        """The number of words, and (start, end, label, by a phrase) in words."""
        words = text.translate(_WORD_BYTES).split()
        line = b" " + b" ".join(words) + b" "
        out = [(at, at + n, label, True) for phrase, n, label in self.phrases for at in _places(line, phrase)]
        places = {o: list(_places(line, o)) for o in self.openings if o in line}
        for label, automaton, openings in self.templates if places else ():
            done = 0
            for at in sorted({x for o in openings for x in places.get(o, ())}):
                end = automaton.longest(words, at) if at >= done else at
                if end > at:
                    out.append((at, end, label, False))
                    done = end
        return len(words), sorted(out)


def _covered(spans: list[tuple[int, int, str, bool]]) -> int:
    n = reach = 0
    for s, e, *_ in spans:
        n, reach = n + max(0, e - max(s, reach)), max(reach, e)
    return n


_SPANS = "n_words long, covered long, spans array<struct<start: bigint, end: bigint, label: string, phrase: boolean>>"


def _found(phrases: dict[str, str], templates: Sequence[tuple[str, str]]):
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(phrases, templates)
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("phrase", pa.bool_())])
        for batch in batches:
            rows = [scanner.spans(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch]
            flat = [s for _, spans in rows for s in spans]
            ends = np.concatenate(([0], np.cumsum([len(s) for _, s in rows]))).astype(np.int32)
            columns = [pa.array([s[i] for s in flat], kind.field(i).type) for i in range(4)]
            spans = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(kind)))
            yield pa.StructArray.from_arrays([pa.array([n for n, _ in rows], pa.int64()), pa.array([_covered(s) for _, s in rows], pa.int64()), spans], names=["n_words", "covered", "spans"])

    return found


def licensed(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, ``spans`` (start, end in words; label; phrase: by a phrase, else by a template), score."""
    found = F.arrow_udf(_found(phrases, templates), _SPANS)
    out = docs.select("doc_id", found(F.col("text").cast("binary")).alias("_f")).select("doc_id", "_f.*")
    return out.select("doc_id", "n_words", "spans", F.when(F.col("n_words") > 0, F.col("covered") / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"))


def license_digest(docs: DataFrame) -> DataFrame:
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    base: Column = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"])
    return licensed(docs).select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score")

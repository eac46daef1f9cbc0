"""License scans by matching template markup.

A template is a license's wording with tags: ``<<beginOptional>>`` to
``<<endOptional>>`` may be left out, ``<<var;words=a-b>>`` stands for a to b
words of any kind, all else must stand as it is.  Case, punctuation and line
ends do not count.  All templates are compiled into one automaton over words;
its sets of states are made as they are met and kept.  A place is accepted for a
template if a run from its first word reads all mandatory wording; one changed,
missing or added word outside the tags ends the run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepared
from cadence.llm.wordscan import ALPHANUMERIC, slices, text_bytes, words

#: Phrases that are found at every place (fixed values): label, wording.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

_GRANT = "<<beginOptional>>this <<beginOptional>>work<<endOptional>><<beginOptional>>software<<endOptional>><<beginOptional>>program<<endOptional>><<beginOptional>>file<<endOptional>> is <<endOptional>>"
_CREATIVE = "<<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> "

_WARRANTY_MIT = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_BSD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
<<beginOptional>>3<<endOptional>> Neither the name of <<var;words=1-16>> nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission.
"""
_WARRANTY_BSD = """
THIS SOFTWARE IS PROVIDED BY <<var;words=1-16>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""

#: Licenses and notices (public texts): label, markup.  A template starts with
#: a mandatory or optional word.
TEMPLATES = (
    ("apache-2.0", _GRANT + "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0"),
    ("apache-2.0", "licensed to <<var;words=1-12>> under the apache license <<beginOptional>>version<<endOptional>> 2.0"),
    ("mit", _GRANT + "released under the mit license"),
    ("mit", _GRANT + "licensed under the mit license"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>
        shall be included in all copies or substantial portions of the Software."""
        + _WARRANTY_MIT,
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    ("bsd-2-clause", _BSD + _WARRANTY_BSD),
    ("bsd-3-clause", _BSD + _BSD_NAMES + _WARRANTY_BSD),
    ("gpl-3.0", _GRANT + "licensed under the gnu general public license <<beginOptional>>version<<endOptional>> 3 <<beginOptional>>0<<endOptional>>"),
    ("gpl-2.0", _GRANT + "licensed under the gnu general public license <<beginOptional>>version<<endOptional>> 2 <<beginOptional>>0<<endOptional>>"),
    (
        "gpl-2.0-or-later",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at
        your option) any later version.""",
    ),
    (
        "gpl-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at""",
    ),
    ("cc0-1.0", _GRANT + "dedicated to the public domain under <<beginOptional>>the<<endOptional>> cc0 1.0"),
    *(
        (f"cc-by{kind}-{version}.0", f"{_GRANT}licensed under {_CREATIVE}{name}{kind.replace('-', ' ')} {version}.0")
        for kind in ("", "-sa", "-nc", "-nd", "-nc-sa", "-nc-nd")
        for version in (3, 4)
        for name in ("cc by",)
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_TAG = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _wording(text: str) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return _WORD.findall(low)


def parsed(markup: str) -> list:
    """A sequence of words, ('optional', sequence) and ('any', least, most)."""
    stack, at = [[]], 0
    for tag in _TAG.finditer(markup):
        stack[-1] += _wording(markup[at : tag.start()])
        at = tag.end()
        if tag[1] == "beginOptional":
            stack.append([])
        elif tag[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("an optional region ends that did not begin")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            stack[-1].append(("any", int(tag[2]), int(tag[3])))
    if len(stack) > 1:
        raise ValueError("an optional region does not end")
    return stack[0] + _wording(markup[at:])


class Automaton:
    """Runs of all templates at once.  States are numbers; a set of them is a
    row, made when first met; ``most`` rows are kept."""

    def __init__(self, templates: list[tuple[str, str, bool]], most: int = 50_000):
        self.labels = [(label, base) for label, _, base in templates]
        self.step: list[dict[str | None, int]] = []  # word, or None for any word, to the next state
        self.free: list[list[int]] = []  # states reached without a word
        self.accepts: dict[int, int] = {}
        starts = []
        for i, (_, markup, _) in enumerate(templates):
            sequence = parsed(markup)
            begin = self._state()
            end = self._line(sequence, begin)
            self.accepts[end] = i
            if end in self._closure({begin}):
                raise ValueError(f"template {i} has no mandatory wording")
            starts.append(begin)
        vocabulary = sorted({w for s in self.step for w in s if w is not None})
        self.number = {w.encode(): i + 1 for i, w in enumerate(vocabulary)}  # 0: any other word
        self.step_of = [{(None if w is None else self.number[w.encode()]): t for w, t in s.items()} for s in self.step]
        self.start = frozenset(self._closure(set(starts)))
        self.first = {w for s in self.start for w in self.step_of[s]}
        if None in self.first:
            raise ValueError("a template starts with a variable region")
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[int, int]] = []
        self.ends: list[tuple[int, ...]] = []
        self._row(self.start)

    def _state(self) -> int:
        self.step.append({})
        self.free.append([])
        return len(self.step) - 1

    def _line(self, sequence: list, at: int) -> int:
        for x in sequence:
            if isinstance(x, str):
                after = self._state()
                self.step[at][x] = after
                at = after
            elif x[0] == "optional":
                inner = self._state()
                self.free[at].append(inner)
                after = self._line(x[1], inner)
                join = self._state()
                self.free[at].append(join)
                self.free[after].append(join)
                at = join
            else:
                skips = []
                for k in range(x[2]):
                    if k >= x[1]:
                        skips.append(at)
                    after = self._state()
                    self.step[at][None] = after
                    at = after
                join = self._state()
                for s in (*skips, at):
                    self.free[s].append(join)
                at = join
        return at

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def _row(self, states: frozenset) -> int:
        got = self.rows.get(states)
        if got is None:
            got = self.rows[states] = len(self.sets)
            self.sets.append(states)
            self.next.append({})
            self.ends.append(tuple(sorted({self.accepts[s] for s in states if s in self.accepts})))
        return got

    def _follow(self, row: int, word: int) -> int:
        """The next row, -1 if every run has ended."""
        out = set()
        for s in self.sets[row]:
            step = self.step_of[s]
            for w in (word, None):
                if w != 0 and w in step:
                    out.add(step[w])
        got = self._row(frozenset(self._closure(out))) if out else -1
        self.next[row][word] = got
        return got

    def places(self, line: np.ndarray, at: int) -> dict[int, int]:
        """For the runs from word ``at``: template to the end of its longest place."""
        if len(self.sets) > self.most:
            self._clear()
        row, found, n = 0, {}, len(line)
        while at < n:
            word = int(line[at])
            after = self.next[row].get(word)
            row = self._follow(row, word) if after is None else after
            if row < 0:
                break
            at += 1
            for t in self.ends[row]:
                found[t] = at
        return found


@lru_cache(maxsize=4)
def _automaton(templates: tuple) -> Automaton:
    return Automaton(list(templates))


def standard() -> tuple[tuple[str, str, bool], ...]:
    """(label, markup, base) of BASE and TEMPLATES."""
    return (*((label, text, True) for label, text in BASE), *((label, text, False) for label, text in TEMPLATES))


PLACE = "array<struct<label:string,base:boolean,first:long,last:long>>"


def scanned(docs: DataFrame, templates: tuple = standard(), id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, places) of every row: each accepted place with its
    template's label and its first and last word (from 0), by first word, then
    template.  Of several ends the longest counts.

    Null texts are empty: no words, no places.  Repeated rows are scanned each;
    ids are passed on as they are, null too.  A run reads no further than its
    template, so a long text costs its words times a constant.  No rows give no
    rows; further columns are ignored."""
    prepared(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(templates)
        begins = np.zeros(len(auto.number) + 1, bool)
        begins[list(auto.first)] = True
        for part in slices(batches):
            found = words(part.column("text"), ALPHANUMERIC)
            known = np.fromiter((auto.number.get(t, 0) for t in found.terms.to_pylist()), np.int64, len(found.terms))
            line = known[found.number] if len(known) else np.zeros(0, np.int64)
            at = np.flatnonzero(begins[line])
            edge = np.searchsorted(at, found.bound)
            out = []
            for i in range(part.num_rows):
                own: list[dict] = []
                if edge[i] < edge[i + 1]:
                    lo, hi = int(found.bound[i]), int(found.bound[i + 1])
                    text = line[lo:hi]
                    for a in (at[edge[i] : edge[i + 1]] - lo).tolist():
                        for t, end in sorted(auto.places(text, a).items()):
                            label, base = auto.labels[t]
                            own.append({"label": label, "base": base, "first": a, "last": end - 1})
                out.append(own)
            kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("last", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(found.bound).astype(np.int64)), pa.array(out, kind)],
                names=["doc_id", "n_words", "places"],
            )

    own = text_bytes(docs, F.col(id_col).cast("long").alias("doc_id"))
    return own.mapInArrow(scan, f"doc_id long, n_words long, places {PLACE}")


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score): the base phrases' places and the labels of all places; score is 1
    where a license's whole wording stands, 0.5 where only a base phrase does,
    else 0."""
    base = F.filter("places", lambda p: p["base"])
    names = lambda ps: F.array_join(F.array_sort(F.array_distinct(F.transform(ps, lambda p: p["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["first"])).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.when(F.exists("places", lambda p: ~p["base"]), 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"),
    )


def _pattern(sequence: list) -> str:
    """A regular expression of words, each behind a blank."""
    out = ""
    for x in sequence:
        if isinstance(x, str):
            out += " " + re.escape(x)
        elif x[0] == "optional":
            out += f"(?:{_pattern(x[1])})?"
        elif x[2]:
            out += f"(?: [^ ]+){{{x[1]},{x[2]}}}"
    return out


def sql() -> str:
    """DuckDB SQL of the query's rows over the table documents."""
    own: dict[str, list[str]] = {}
    for label, markup in TEMPLATES:
        own.setdefault(label, []).append(_pattern(parsed(markup)) + " ")
    listed = ", ".join(f"CASE WHEN regexp_matches(t, '{'|'.join(ps)}') THEN '{label}' END" for label, ps in own.items())
    places = " UNION ALL ".join(
        f"SELECT r, '{label}' AS label, i - 1 AS place FROM w WHERE "
        + " AND ".join(f"ws[i + {k}] = '{x}'" for k, x in enumerate(text.split()))
        for label, text in BASE
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
 w AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d WHERE array_to_string(ws, ' ') LIKE '%license%' OR list_contains(ws, 'cc')),
 b AS ({places}),
 s AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS ls FROM b GROUP BY r),
 m AS (SELECT r, list_filter([{listed}], lambda x: x IS NOT NULL) AS own FROM (SELECT r, ' ' || array_to_string(ws, ' ') || ' ' AS t FROM d))
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(ls), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(ls, []), own))), ',') AS labels,
       CASE WHEN len(own) > 0 THEN 1.0 WHEN n_base > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM d JOIN m USING (r) LEFT JOIN s USING (r)
"""


SQL = sql()

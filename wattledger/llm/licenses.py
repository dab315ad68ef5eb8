"""License scans: a suffix automaton of all templates' words streams over each text; long
matches are chained into covered spans of a template."""

from __future__ import annotations

from bisect import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattledger.llm.common import arrow, ship, slices, utf8
from wattledger.llm.decontaminate import words_of

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Usual notices, by label.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0"],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
}


class Automaton:
    """Generalised suffix automaton of token sequences; each state knows the sequences that hold
    its strings and all places in them where these end.

    ``limits``: per sequence the shortest match that is given out.
    """

    def __init__(self, sequences: list[list[int]], limits: list[int] | None = None):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for c in sequence:
                last = self._extend(last, c)
        ends: list[dict[int, list[int]]] = [{} for _ in self.next]
        for number, sequence in enumerate(sequences):
            state = 0
            for i, c in enumerate(sequence):
                state = above = self.next[state][c]
                while above:
                    ends[above].setdefault(number, []).append(i + 1)
                    above = self.link[above]
        self.limits = limits or [1] * len(sequences)
        # Per state and sequence the longest of its suffixes there: what the state itself has is
        # as long as the match, what only a suffix link leads to as long as the strings there.
        self.own = [list(x.items()) for x in ends]
        self.rest: list[list[tuple]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            n, known = self.length[up], ends[state]
            self.rest[state] = [x for x in self.rest[up] if x[0] not in known] + [
                (number, n, places) for number, places in self.own[up] if number not in known and n >= self.limits[number]]
        # No match in a state that is shorter than this is given out.
        self.least = [min((self.limits[number] for number, _ in x), default=0) for x in self.own]

    def _state(self, length: int, link: int, follow: dict) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier template has this string already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def statistics(self, tokens: list[int]) -> list[tuple[int, int, int, list[int]]]:
        """Maximal matches (start, end, sequence, places of the end in it) in ``tokens``: per
        sequence the longest match that ends at a place is followed, and given out where it
        can't grow, whatever other sequences go on with."""
        out, state, n = [], 0, 0
        held: dict[int, tuple[int, list[int]]] = {}
        for i, c in enumerate(tokens):
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            else:
                state, n = 0, 0
            now = {number: (size, places) for number, size, places in self.rest[state]}
            if state and n >= self.least[state]:
                now.update((number, (n, places)) for number, places in self.own[state] if n >= self.limits[number])
            for number, (size, places) in held.items():
                if number not in now or now[number][0] != size + 1:
                    out.append((i - size, i, number, places))
            held = now
        out += [(len(tokens) - size, len(tokens), number, places) for number, (size, places) in held.items()]
        return out


def chained(matches: list[tuple[int, int, int, list[int]]], sizes: list[int], least: int, gap: int) -> list[tuple[int, int, int, int]]:
    """(start, end, template, words covered) of matches that follow one another in text and
    template, at most ``gap`` words apart. A match counts if it has ``least`` words or is a
    whole template.

    A match that stands at several places of its template can go on from each of them: of the
    chains of a template the ones that cover most are given out, none over another's words.
    """
    by_template: dict[int, list] = {}
    for start, end, number, places in matches:
        if end - start >= min(least, sizes[number]):
            by_template.setdefault(number, []).append((start, end, places))
    out = []
    for number, found in by_template.items():
        open_: list[tuple] = []  # (start, end, place, covered) that can still go on
        closed: list[tuple] = []

        def close(chains):
            taken: list[tuple] = []  # ascending, without overlaps
            for c in sorted(chains, key=lambda c: (-c[3], c[1] - c[0], c[0])):
                at = bisect(taken, c)
                if (not at or taken[at - 1][1] <= c[0]) and (at == len(taken) or c[1] <= taken[at][0]):
                    taken.insert(at, c)
            out.extend((c[0], c[1], number, c[3]) for c in taken)

        for start, end, places in found:
            n = end - start
            near = [c for c in open_ if start - c[1] <= gap]
            if open_ and not near:
                close(closed)
                closed = []
            fresh = []
            for place in places:
                best = (start, end, place, n)
                for s, e, at, covered in near:
                    if place - n >= at - gap and place > at and end > e:
                        # Words of the text or of the template that both have count once.
                        more = n - max(0, e - start, at - (place - n))
                        if (covered + more, s) > (best[3], best[0]):
                            best = (s, end, place, covered + more)
                fresh.append(best)
            open_ = near + fresh
            closed += fresh
        close(closed)
    return out


def scan(documents: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None, least: int = 5, gap: int = 8, cover: float = 0.8) -> DataFrame:
    """The columns of ``documents`` but ``text``, with n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans (label, start, end, score in words).

    A label is added where chained matches cover ``cover`` of one of its templates; score is the
    largest such share, 1 where a phrase stands. Null and empty texts have no words and score 0.
    Only the templates' own words lead into the automaton, which each task builds once.
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    ship(documents.sparkSession)
    results = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))}
    schema, spark_schema = arrow(results)
    rest = [c for c in documents.columns if c.lower() not in ("text", *results)]
    df = documents.select(*rest, utf8().alias("__utf8"))
    out_schema = T.StructType([*documents.select(*rest).schema.fields, *spark_schema.fields])

    def run(batches):
        vocabulary: dict[bytes, int] = {}
        number = lambda text: [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text.encode())]
        keys = [(number(p), label) for p, label in phrases.items()]
        named = [(label, number(t)) for label, ts in templates.items() for t in ts]
        sizes = [len(s) for _, s in named]
        automaton = Automaton([s for _, s in named], [min(least, n) for n in sizes])
        shortest = min(least, *sizes)
        shortest_run = min([2, *sizes, *(len(key) for key, _ in keys)])
        for b in batches:
            at = b.num_columns - 1
            rows = []
            for _, texts in slices(b, at):
                for text in texts:
                    words = words_of(text)
                    x = np.fromiter((vocabulary.get(w, 0) for w in words), np.int32, len(words)) if words else np.empty(0, np.int32)
                    base, found, spans, best = [], set(), [], 0.0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], (x > 0).astype(np.int8), [0]])))
                    starts, ends = edge[::2], edge[1::2]
                    long = ends - starts >= shortest_run
                    matches = []
                    for s, e in zip(starts[long].tolist(), ends[long].tolist()):
                        tokens = x[s:e].tolist()
                        for key, label in keys:
                            for i in range(len(tokens) - len(key) + 1):
                                if tokens[i] == key[0] and tokens[i : i + len(key)] == key:
                                    base.append(s + i)
                                    found.add(label)
                        if e - s >= shortest:
                            matches += [(s + i, s + j, which, places) for i, j, which, places in automaton.statistics(tokens)]
                    for start, end, which, covered in chained(matches, sizes, least, gap):
                        share = min(1.0, covered / sizes[which])
                        if share >= cover:
                            spans.append({"label": named[which][0], "start": start, "end": end, "score": share})
                            best = max(best, share)
                    labels = sorted(found | {s["label"] for s in spans})
                    rows.append((len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(found)), ",".join(labels), 1.0 if base else best, spans))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *columns], [*b.schema.names[:at], *schema.names])

    return df.mapInArrow(run, out_schema)

"""Words that several license templates share count for each of them."""

from __future__ import annotations

import random

from wattledger.llm import licenses


def test_statistics_are_those_of_each_sequence():
    r = random.Random(41)
    for _ in range(60):
        texts = [[r.randrange(3) for _ in range(r.randrange(1, 14))] for _ in range(4)]
        limits = [r.randrange(1, 4) for _ in texts]
        tokens = [r.randrange(4) for _ in range(40)]
        want = []
        for number, t in enumerate(texts):
            ends = lambda w, t=t: [j for j in range(len(w), len(t) + 1) if t[j - len(w) : j] == w]
            longest = [max(n for n in range(i + 1) if n == 0 or ends(tokens[i - n : i])) for i in range(len(tokens) + 1)]
            for i in range(1, len(tokens) + 1):
                n = longest[i]
                if n >= limits[number] and (i == len(tokens) or longest[i + 1] != n + 1):
                    want.append((i - n, i, number, ends(tokens[i - n : i])))
        assert sorted(licenses.Automaton(texts, limits).statistics(tokens)) == sorted(want)


def test_shared_words_count_for_every_template(spark):
    common = "You may use copy and share this work as long as you name the people who made it"
    templates = {"share-1": [f"{common} version one of these terms"], "share-2": [f"{common} version two of these terms"],
                 "twice": ["keep this very same notice here always then keep this very same notice here never"]}
    usual = "This work is licensed under the Creative Commons Attribution 4.0 International License"
    rows = [(1, usual), (2, "This work is licensed under the GNU General Public License, version 3")]
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "cc-by-4.0" and [(s.label, s.start, s.end) for s in got[1].spans] == [("cc-by-4.0", 0, 13)]
    assert abs(got[1].score - 12 / 13) < 1e-9 and got[2].labels == "gpl,gpl-3.0"
    rows = [(1, templates["share-1"][0]), (2, templates["share-2"][0]), (3, f"{common} version"), (4, f"{templates['twice'][0]} and {templates['twice'][0]}")]
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=templates).collect()}
    assert {(s.label, s.score) for s in got[1].spans} >= {("share-1", 1.0)} and {(s.label, s.score) for s in got[2].spans} >= {("share-2", 1.0)}
    size = len(common.split()) + 5
    assert {s.label: s.score for s in got[3].spans} == {"share-1": (size - 4) / size, "share-2": (size - 4) / size}
    assert [(s.label, s.start, s.end, s.score) for s in got[4].spans] == [("twice", 0, 15, 1.0), ("twice", 16, 31, 1.0)]

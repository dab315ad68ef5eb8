"""Anchor strings with many runs, and window lengths beyond the usual one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import repeats_of
from wattledger.llm import substring_dedup


def drawn(r, n, letters="abcdefgh é\n"):
    return "".join(r.choice(list(letters)) for _ in range(n))


def as_dict(rows):
    return {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in rows}


@pytest.mark.parametrize("hot_runs", [5])
def test_hot_anchors_are_split_and_exact(spark, run, monkeypatch, hot_runs):
    """No task gets more runs of an anchor string to sort than allowed, with the results of brute force."""
    r = random.Random(31)
    passages = [drawn(r, n) for n in (100, 120, 150, 400)]
    docs = [(i, drawn(r, r.randrange(200)) + r.choice(passages) + drawn(r, r.randrange(200)) + r.choice(passages)) for i in range(120)]
    docs += [(200, "ab" * 300), (201, "ab" * 300), (202, "z" * 500), (203, None), (204, ""), (205, docs[3][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    spans, most = substring_dedup._spans, []

    def watched(contexts, length):
        sizes = contexts.filter("context is not null").groupBy("fp").count()
        most.append(sizes.agg(F.max("count")).collect()[0][0] or 0)
        return spans(contexts, length)

    monkeypatch.setattr(substring_dedup, "_spans", watched)
    got = substring_dedup.without_repeats(table, run, hot_runs=hot_runs).collect()
    assert as_dict(got) == repeats_of(docs, 100) and most and max(most) <= hot_runs


@pytest.mark.parametrize("length", [92, 200])
def test_windows_of_other_lengths(spark, run, length):
    """Strings that differ in one byte somewhere in the middle are different."""
    r = random.Random(37)
    base = drawn(r, 330, "abcdefgh")
    docs = [(0, base)] + [(i, base[:i] + "X" + base[i + 1 :]) for i in range(1, 330, 7)]
    docs += [(1000 + i, drawn(r, r.randrange(90)) + base[r.randrange(60) :]) for i in range(20)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert as_dict(substring_dedup.without_repeats(table, run, length=length).collect()) == repeats_of(docs, length)

"""Fingerprints against a version that looks at every window by itself."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import odd_documents
from wattledger.llm import fingerprints as fp
from wattledger.llm import queries

W = fp.WINDOW


def plain_class(window):
    whole = round(W * math.log2(W) * (1 << 20))
    return fp.CLASSES * (whole - sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values())) // whole


def plain_features(text, rank):
    """Windows that lead in LEAD of the runs of W windows that hold them."""
    padded = bytes(W - 1) + text
    windows = [padded[i : i + W] for i in range(len(text))]
    ranks = [rank[plain_class(w)] for w in windows]
    led = Counter()
    for start in range(1 - W, len(windows)) if windows else ():
        led[min((ranks[i], i) for i in range(max(start, 0), min(start + W, len(windows))))[1]] += 1
    return [windows[i] for i in sorted(led) if led[i] >= fp.LEAD]


def texts(seed):
    r = random.Random(seed)
    draw = lambda n: "".join(r.choice("abcdefg  éü\nXYZ0123") for _ in range(n))
    return [draw(n) for n in (0, 1, 5, W - 1, W, W + 1, 300, 2000)] + ["aaaa" * 100, "", draw(700)]


def test_classes_and_features():
    rank = fp.ranking(np.random.default_rng(1).integers(0, 1000, fp.CLASSES + 1))
    raw = [t.encode() for t in texts(1)]
    laid = fp.Laid(raw)
    for block in (1 << 21, 97):  # results don't depend on where the work is cut
        blocks = [c[a - lo : b - lo] for a, b, lo, c in laid.blocks(block)]
        classes = np.concatenate(blocks)
        want = [plain_class(laid.data[i : i + W].tobytes()) for i in range(len(laid.data) - W + 1)]
        assert classes.tolist() == want
    prints = fp.Prints(raw, rank)
    for i, t in enumerate(raw):
        wanted = plain_features(t, rank)
        assert prints.own(i)[0].sum() == len(set(wanted)), t
        assert bool(wanted) == bool(t)
    long = fp.Laid([b"x".join(raw)] * 3)
    found = fp.features(long, rank)
    whole, long.blocks = long.blocks, lambda block=101: fp.Laid.blocks(long, 101)
    assert np.array_equal(found, fp.features(long, rank))


def test_likeness():
    rank = np.arange(fp.CLASSES + 1)
    r = random.Random(2)
    a, b = ("".join(r.choice("abcdefghijklmnop ") for _ in range(60_000)) for _ in range(2))
    some = [a, a, b, a[:40_000] + b[:20_000], "", "", "short", "short"]
    prints = fp.Prints([t.encode() for t in some], rank)
    own = [prints.own(i) for i in range(len(some))]
    assert len(own[0][0]) > 5 and (own[0][0][:-1] == fp.CAPACITY).all()
    for p in own:
        back = fp.parsed(fp.written(p))
        assert np.array_equal(back[0], p[0]) and np.array_equal(back[1], p[1])
    like = lambda i, j: fp.likeness(own[i], own[j])
    assert like(0, 1) == like(4, 5) == like(6, 7) == 1 and like(0, 4) == like(4, 6) == 0
    assert like(0, 2) < 0.02 and 0.55 < like(0, 3) < 0.75 and like(0, 3) == like(3, 0)


@pytest.mark.parametrize("parts", [1, 5])
def test_query(spark, folder, parts):
    r = random.Random(4)
    docs = [(i, "".join(r.choice("abcdef ghi") for _ in range(r.randrange(400)))) for i in r.sample(range(-50, 5000), 150)]
    docs += [(9000, docs[0][1]), (9001, None), (9002, ""), (None, "null id"), (7777, "same id"), (7777, "same id, other text")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(parts).write.parquet(f"{folder}/documents.parquet")
    got = queries.op11_improbable_features(spark, folder).collect()
    assert len(got) == len(docs)
    by = {}
    for x in got:
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
        by.setdefault(x.doc_id, []).append(x)
    chain = sorted((d for d in docs if d[0] is not None and d[0] != 7777), key=lambda d: -d[0])
    last = [d for d in docs if d[0] is None]
    for (i, text), (j, following) in zip(chain, chain[1:] + last):
        if j is not None and i > 7777 > j:
            continue
        t, n = text or "", following or ""
        edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        (x,) = by[i]
        assert (x.n_chars, x.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        if len(t) > 150:
            assert x.near_edited > 0.2 > x.near_next
    (end,) = by[None]  # after the last comes the first
    assert end.edited_sha256 == hashlib.sha256(("null id"[:5] + (chain[0][1] or "")[:2]).encode()).hexdigest()
    assert by[9000][0].fingerprint == by[docs[0][0]][0].fingerprint and by[9001][0].fingerprint == ""


def test_odd_and_no_rows(spark, odd, none):
    rank = fp.ranking(fp.class_counts(odd))
    assert fp.edits(odd, rank).count() == len(odd_documents())
    out = fp.fingerprints(odd.withColumnRenamed("score", "Fingerprint"), rank)
    assert out.columns == ["doc_id", "lang", "row", "fingerprint"] and out.count() == len(odd_documents())
    assert fp.class_counts(none).sum() == 0 and fp.edits(none, rank).count() == 0
    pair = spark.createDataFrame([("", ""), (None, "")], "a string, b string")
    assert [x.likeness for x in fp.compared(pair, "a", "b").collect()] == [1.0, None]

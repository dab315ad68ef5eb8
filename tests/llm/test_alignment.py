"""Links and groups against a version that compares sets of token ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm.conftest import odd_documents
from wattledger.llm import alignment, queries

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def tables():
    return alignment.Tables(*PATHS)


def whole_ids(tables, text):
    return tables.a.encode(" " + text, add_special_tokens=False).ids, tables.b.encode(text)


def brute(docs, tables):
    rows, counts = [], Counter()
    for i, text in docs:
        a, b = whole_ids(tables, text) if text else ([], [])
        x, y = [[t[k] for k in ids] for t, ids in ((tables.a_bytes, a), (tables.b_bytes, b))]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            rows.append((i, [], [], [], ""))
            continue
        ends = [{int(e): k for k, e in enumerate(np.cumsum([len(w) for w in ws]))} for ws in (x, y)]
        links, groups, p, q = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            m, n = ends[0][e], ends[1][e]
            links.append((a[m], b[n]))
            groups.append(",".join(map(str, a[p : m + 1])) + "|" + ",".join(map(str, b[q : n + 1])))
            p, q = m + 1, n + 1
        counts.update(links)
        rows.append((i, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(i, len(a), len(b), len(x), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), s) for i, a, b, x, s in rows]


def odd_texts(seed, n):
    r = random.Random(seed)
    words = ["the", "Größe", "zebra", "数字", "don't", "<|endoftext|>", "<s>", "<0x41>", "▁", "\n", "\t", " ", "  ", "", "é", "é", "🙂", "　", "\xa0", "1234567", "a.b@c", "\x00", "ﬁ"]
    return [r.choice([" ", "", "  "]).join(r.choice(words) for _ in range(r.randrange(1, 40))) for _ in range(n)]


def test_cut_texts_have_the_ids_of_whole_ones(tables):
    texts = odd_texts(5, 400) + [" lead", "trail ", "a  b", "", None]
    for text, got in zip(texts, tables.encode(texts)):
        if not text:
            assert got is None
            continue
        a, b = whole_ids(tables, text)
        if got is None:
            whole = (" " + text).encode()
            assert b"".join(tables.a_bytes[k] for k in a) != whole or b"".join(tables.b_bytes[k] for k in b) != whole
        else:
            assert [np.frombuffer(x, np.uint16).tolist() for x in got] == [a, b]


@pytest.mark.parametrize("lane", [1, 7, 256])
def test_lockstep(lane):
    r = np.random.default_rng(lane)
    ends, first, at = ([], []), ([0], [0]), 0
    for _ in range(60):
        size = int(r.choice([0, 1, 5, 400, 2000]))
        for k in (0, 1):
            own = np.flatnonzero(r.random(size) < 0.4) + 1
            own = np.unique(np.append(own, size)) if size else own
            ends[k].append(own + at)
            first[k].append(first[k][-1] + len(own))
        at += size
    a, b = map(np.concatenate, ends)
    partner = alignment.lockstep(a, b, *map(np.array, first), lane=lane)
    where = {int(e): k for k, e in enumerate(b)}
    assert partner.tolist() == [where.get(int(e), -1) for e in a]


@pytest.mark.parametrize("block_bytes", [4 << 20, 500])
def test_align(spark, run, tables, block_bytes):
    docs = [(i, t) for i, t in enumerate(odd_texts(7, 120))] + [(500, "word " * 5000), (501, None), (502, ""), (503, "x " * 400 + "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = alignment.align(frame, run, *PATHS, detail=True, block_bytes=block_bytes)
    want = {r[0]: r for r in brute(docs, tables)}
    rows = got.collect()
    assert len(rows) == len(docs)
    for x in rows:
        assert tuple(x)[:8] == want[x.doc_id]
        a, b, p, q = (np.frombuffer(x[c], np.uint32) for c in ("a_ids", "b_ids", "a_links", "b_links"))
        assert len(a) == x.n_a and len(b) == x.n_b and len(p) == len(q) == x.n_links
        if x.n_a:
            assert np.array_equal(np.cumsum(tables.sizes[0][a])[p], np.cumsum(tables.sizes[1][b])[q])


def test_odd_and_no_rows(spark, run, odd, none, folder):
    got = alignment.align(odd, run, *PATHS)
    assert got.count() == len(odd_documents()) and got.filter("doc_id is null").count() == 2
    assert alignment.align(none, run, *PATHS).count() == 0
    odd.write.parquet(f"{folder}/documents.parquet")
    assert queries.op13_lockstep_alignment(spark, folder).columns[:2] == ["doc_id", "n_a"]


def test_new_words_go_to_the_tokenizers_together():
    from tests.llm.test_pieces import Counting, many_words

    tables = alignment.Tables(*PATHS)
    tables.a = Counting(tables.a)
    texts = many_words(5000)
    got = tables.encode(texts)
    assert tables.a.strings <= 100  # one for each word before
    for text, (a, b) in zip(texts, got, strict=True):
        assert [np.frombuffer(x, np.uint16).tolist() for x in (a, b)] == list(whole_ids(tables, text))


def test_words_that_differ_among_words_that_fit(monkeypatch):
    tables = alignment.Tables(*PATHS)
    fits = tables._fits
    monkeypatch.setattr(tables, "_fits", lambda text, a, b: "q" not in text and fits(text, a, b))
    texts = [" ".join(["one", f"x{i}", "aqa" if i % 7 == 0 else "two"]) for i in range(3000)]
    ids, counts = tables.tokens(texts)
    fit = ["q" not in t for t in texts]
    assert (counts[0] > 0).tolist() == (counts[1] > 0).tolist() == fit
    for k in (0, 1):
        assert ids[k].tolist() == [i for t, f in zip(texts, fit) if f for i in whole_ids(tables, t)[k]]

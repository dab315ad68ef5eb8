"""Every operator against a plain brute-force version, and over odd, repeated and empty rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.conftest import odd_documents
from wattledger.llm import (
    byte_bpe, decontaminate, graph, licenses, near_dedup, pii, quality, substring_dedup,
    token_store, toxicity, vector_dedup,
)

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def smallest(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_of_chains_and_stars(spark, run):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    links = [*chain, *star, (7, 7), (None, 3), (140, 100)]
    got = graph.components(spark.createDataFrame(links, "a long, b long"), run)
    want = smallest({n for e in chain + star for n in e}, chain + star)
    assert {r.node: r.component for r in got.collect()} == want
    assert graph.components(spark.createDataFrame([], "a long, b long"), run).count() == 0


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, run, size, percent):
    r = random.Random(size)
    vocabulary = [f"w{i}" for i in range(300)]
    docs, i = [(d[0], d[1]) for d in odd_documents() if d[0] is not None], 100
    for _ in range(6):
        base = [r.choice(vocabulary) for _ in range(80)]
        for _ in range(7):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            docs.append((i, " ".join(words)))
            i += 1
    sets = {d: shingle_set(t, size) for d, t in docs}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = smallest(sets, links)
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), run, size, percent).collect()
    assert len(got) == len(docs)
    for x in got:
        assert (x.n_shingles, x.component_id, x.kept) == (len(sets[x.doc_id]), want[x.doc_id], want[x.doc_id] == x.doc_id), x


def test_circulant_coordinates_estimate_similarity():
    r = np.random.default_rng(1)
    universe = r.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    a, b = np.unique(universe[:2000]), np.unique(universe[500:2500])
    s = near_dedup.signatures([a, b], 512)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - true) < 0.1


def contamination_of(text, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        n = min(window, len(x))
        for j in range(len(x) - n + 1) if n else ():
            for i in range(len(w) - n + 1):
                if w[i : i + n] == x[j : j + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    names = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination(spark, run):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["é"]
    draw = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(n))) for i, n in enumerate([30, 13, 12, 5, 2, 1, 40, 13])]
    items += [(20, items[0][1]), (21, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    docs = [(1, items[0][1]), (2, " ".join(draw(200))), (3, None), (4, ""), (5, "w1 " * 60), (5, "w1 " * 60), (None, items[6][1])]
    for i in range(6, 20):
        x = items[i % 8][1].split()
        docs.append((i, " ".join(draw(20) + x[r.randrange(3) :] + draw(r.randrange(60)))))
    table = spark.createDataFrame([*items, (None, "w1 w2"), (30, None)], "item_id long, text string")
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), table, run).collect()
    want = Counter((i, *contamination_of(t, items)) for i, t in docs)
    assert Counter(tuple(x) for x in got) == want


def test_contamination_without_items(spark, run, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(odd, none, run).collect()
    assert len(got) == len(odd_documents()) and not any(x.contaminated or x.n_hit for x in got)


def test_byte_bpe_round_trip(spark, odd):
    encoding = tiktoken.Encoding("x", pat_str=byte_bpe.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS), special_tokens={})
    got = byte_bpe.decode(byte_bpe.encode(odd, RANKS, block_bytes=64), RANKS).collect()
    want = Counter((d[0], tuple(encoding.encode_ordinary(d[1] or "")), (d[1] or "").encode()) for d in odd_documents())
    assert Counter((x.doc_id, tuple(np.frombuffer(x.ids, np.uint32).tolist()), bytes(x.bytes)) for x in got) == want


def test_pieces_never_split_a_match():
    r, block = random.Random(5), byte_bpe.Block()
    for _ in range(3000):
        text = "".join(r.choice(list(" \n\t\r ab'sé1²!\x1c\x85字 ")) for _ in range(r.randrange(14)))
        words, (sequence,) = block.cut([text])
        assert [words[k] for k in sequence] == block.pattern.findall(text)


def test_token_store(spark, run, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    folder = f"{run.folder}/store"
    token_store.write(odd, folder, run, JSON, segment_bytes=200)
    got = sorted(token_store.read(spark, folder).collect(), key=lambda x: x.start)
    order = sorted(odd_documents(), key=lambda d: (d[0] is not None, d[0] or 0, len(d[1] or "")))
    at = 0
    for x, d in zip(got, order, strict=True):
        ids = [*t.encode(d[1] or "", add_special_tokens=False).ids, 0]
        assert (x.doc_id, x.start, np.frombuffer(x.ids, np.uint32).tolist()) == (d[0], at, ids)
        at += len(ids)
    one = token_store.read(spark, folder, [7]).collect()
    assert [x.doc_id for x in one] == [7] and one[0].ids == next(x.ids for x in got if x.doc_id == 7)


@pytest.mark.parametrize("chosen", ["quality", "toxic"])
def test_classifiers_learn_and_take_odd_rows(spark, odd, chosen):
    r = random.Random(7)
    good, bad = [f"g{i}" for i in range(200)], ["idiot", "scum", "moron"]
    docs, labels = [], []
    for i in range(600):
        words = [r.choice(good) for _ in range(30)]
        y = i % 3 == 0
        if y:
            words[r.randrange(30)] = r.choice(bad)
        text = ". ".join(" ".join(words[k : k + 6]) for k in range(0, 30, 6))
        if chosen == "quality" and y:
            text = text.upper() + "!! !! !!"
        docs.append((1000 + i, text))
        labels.append((1000 + i, int(y) if chosen == "toxic" else int(not y), int(y)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    module = quality if chosen == "quality" else toxicity
    weights = module.train(table, known)
    out = [r for r in ("score",)]
    got = {x.doc_id: x.score for x in module.score(table, weights).select("doc_id", *out).collect()}
    column = {i: (q, t)[chosen == "toxic"] for i, q, t in labels}
    held = [i for i in column if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == column[i] for i in held]) > 0.95
    scored = module.score(odd, weights).collect()
    assert len(scored) == len(odd_documents()) and all(0 <= x.score <= 1 for x in scored)
    assert {x.row for x in scored} == {d[4] for d in odd_documents()}
    unlabelled = module.train(table, known.limit(0))
    assert module.score(odd, unlabelled).count() == len(odd_documents())


def test_toxic_sentences_are_located(spark):
    weights = np.zeros((1 << toxicity.LOG2_FEATURES) + 1, np.float32)
    weights[-1] = -6
    weights[list(toxicity.word_features(b"scum"))] = 9
    text = "Größe ist gut. You scum! Fine."
    x = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), weights).collect()[0]
    assert x.score > 0.9 and [text[s.start : s.end].strip() for s in x.sentences] == ["You scum!"]


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def rule_spans(text):
    out = []
    for kind, pattern in RULES.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            out.append((kind, *m.span()))
    return out


def test_personal_data_rules():
    r = random.Random(11)
    for _ in range(5000):
        text = "".join(r.choice(list("12 .-+()@aA%_½é")) for _ in range(r.randrange(60)))
        assert sorted(pii.base_spans(text)) == sorted(rule_spans(text)), text
    assert [k for k, *_ in pii.base_spans("4111 1111 1111 1111")] == ["card"]


def test_personal_data_patterns(spark, run, odd):
    """Cards behind the cue "card:" teach that 16 digits there are a card, Luhn or not."""
    r = random.Random(13)

    def card():
        d = "4" + "".join(r.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    docs = [(i, f"pay card: {card()} now") for i in range(40)] + [(90, "pay card: 4000000000000001 now"), (91, "nothing 12 here")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    patterns = pii.learn(table, run)
    assert ("card", "card:", "916") in patterns
    got = {x.doc_id: x for x in pii.extract(table, patterns).collect()}
    assert [tuple(s) for s in got[90].found] == [("card", 10, 26)] and not got[91].found and len(got[0].base) == 1
    clean = {x.doc_id: x.text for x in pii.redacted(table, patterns).collect()}
    assert clean[90] == "pay card: <card> now" and clean[91] == "nothing 12 here"
    out = pii.redacted(odd, patterns)
    assert out.columns == odd.columns and out.count() == len(odd_documents())
    assert all((x.text is None) == (d is None) for x, d in zip(sorted(out.filter("doc_id = 3").collect()), [None]))


def test_licenses(spark, odd):
    texts = [(1, "a Licensed under the Apache License, Version 2.0. b"), (2, "the apache  LICENSE"), (3, "cc by mit license mit license"),
             (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and other associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction"), (5, None), (6, "license")]  # fmt: skip
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].labels == "apache,apache-2.0" and got[1].base_labels == "apache" and got[1].first_word == 4
    assert (got[2].n_base, got[2].first_word, got[2].labels) == (1, 1, "apache")
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].base_labels) == (3, 0, 4, "cc-by,mit")
    assert got[4].n_base == 0 and got[4].labels == "mit" and got[4].score > 0.9
    assert (got[5].n_words, got[5].first_word, got[5].labels, got[5].score) == (0, None, "", 0.0) and got[6].labels == ""
    out = licenses.scan(odd)
    assert out.count() == len(odd_documents()) and set(odd.columns) - {"text"} <= set(out.columns)


def test_automaton_knows_exactly_the_substrings():
    r = random.Random(17)
    texts = [[r.randrange(3) for _ in range(12)] for _ in range(4)]
    a = licenses.Automaton(texts)
    known = {tuple(t[i:j]) for t in texts for i in range(12) for j in range(i + 1, 13)}
    for n in range(1, 6):
        for word in itertools.product(range(3), repeat=n):
            state, ok = 0, True
            for c in word:
                ok = c in a.next[state]
                if not ok:
                    break
                state = a.next[state][c]
            assert ok == (word in known)


def repeats_of(docs, length):
    seen, out = set(), {}
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("block_bytes", [1 << 34, 20_000])
def test_repeated_passages(spark, run, block_bytes):
    r = random.Random(19)
    draw = lambda n, a="abcdefgh é\n": "".join(r.choice(list(a)) for _ in range(n))
    passages = [draw(n) for n in (90, 100, 101, 160, 400)]
    docs = [(i, draw(r.randrange(300)) + r.choice(passages) + draw(r.randrange(200)) + r.choice(passages)[r.randrange(40) :]) for i in range(60)]
    docs += [(100, "ab" * 300), (101, "ab" * 300), (102, "z" * 500), (103, None), (104, ""), (105, "q" * 99), (106, docs[3][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substring_dedup.without_repeats(table, run, block_bytes=block_bytes).collect()
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in got} == repeats_of(docs, 100)


def test_repeated_passages_of_odd_rows(spark, run, odd, none):
    got = substring_dedup.without_repeats(odd, run).collect()
    assert len(got) == len(odd_documents())
    assert sum(x.n_removed > 0 for x in got if x.doc_id in (1, 2)) == 2  # of three equal rows the first stays
    assert substring_dedup.without_repeats(none, run).count() == 0


def test_near_vectors(spark, run):
    r = np.random.default_rng(23)
    base = r.standard_normal((12, 64))
    rows = []
    for i, b in enumerate(base):
        for k in range(6):
            rows.append((100 * (i + 1) + k, (b + r.standard_normal(64) * 0.12).astype(np.float32).tolist()))
    rows += [(1, None), (2, []), (3, [0.0] * 64), (4, [float("nan")] * 64), (5, [None] * 64), (6, [1.0, 0.0]), (7, [1.0, 0.1]), (8, rows[0][1]), (9, [float("inf")] * 64)]
    x = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a, b in itertools.combinations(x, 2) if len(x[a]) == len(x[b]) and x[a] @ x[b] >= 0.9]
    degree, want = Counter(n for e in links for n in e), smallest([i for i, _ in rows], links)
    got = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), run).collect()
    assert {y.vec_id: (y.n_links, y.component_id, y.kept) for y in got} == {i: (degree[i], want[i], want[i] == i) for i, _ in rows}


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(29)
    a, b = r.standard_normal((400, 64)), r.standard_normal((400, 64))
    b = a * 0.9 + 0.4 * b
    a, b = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (a, b))
    turned = vector_dedup.rotation(64, 0)
    _, code, factor = vector_dedup.encode(a, turned)
    value, error = vector_dedup.estimates(code, factor, b.astype(np.float32) @ turned)
    true = (a * b).sum(1)
    assert abs((value - true).mean()) < 0.02 and (np.abs(value - true) <= 5 * error).all()


def test_empty_tables(spark, run, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert near_dedup.near_duplicates(none, run).count() == 0
    assert decontaminate.contamination(none, items, run).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none, RANKS), RANKS).count() == 0
    assert pii.learn(none, run) == [] and pii.extract(none, []).count() == 0
    assert licenses.scan(none).count() == 0
    token_store.write(none, f"{run.folder}/empty", run, JSON)
    assert token_store.read(spark, f"{run.folder}/empty").count() == 0
    assert vector_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), run).count() == 0
    assert F is not None

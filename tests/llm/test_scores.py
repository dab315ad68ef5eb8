"""Scores recomputed feature by feature; patterns that may not vouch for themselves; clashes."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import odd_documents
from wattledger.llm import licenses, pii, quality, queries, toxicity


def mix(value):
    value &= (1 << 64) - 1
    value ^= value >> 29
    return value * 0xBF58476D1CE4E5B9 % (1 << 64) >> 64 - quality.LOG2_FEATURES


def shape_of(word):
    kinds = ["A" if 65 <= c <= 90 else "a" if 97 <= c <= 122 or c >= 128 else "0" if 48 <= c <= 57 else chr(c) for c in word]
    return "".join(k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k).encode()


def plain_quality(text, w):
    """The sigmoid of eight times the mean weight of the features, and the bias."""
    words = [b"\x01", *(text or "").encode().split(), b"\x02"]
    low = [xxhash.xxh32_intdigest(x.lower()) for x in words]
    shape = [xxhash.xxh32_intdigest(shape_of(x), 7) for x in words]
    m, total = 0x9E3779B97F4A7C15, 0.0
    for i in range(len(words)):
        back = lambda a, k: a[i - k] if i >= k else 0  # noqa: B023, E731
        again = (low[i] == back(low, 1)) + 2 * (low[i] == back(low, 2))
        for number, value in enumerate((
            low[i], low[i] * 31 + back(low, 1), shape[i], shape[i] * 31 + back(shape, 1),
            (shape[i] * 31 + back(shape, 1)) * 31 + back(shape, 2), again), 1):
            total += float(w[mix(value * m + number)])
    return 1 / (1 + math.exp(-(8 * total / (6 * len(words)) + float(w[-1]))))


def test_quality_scores(spark, odd):
    r = np.random.default_rng(1)
    w = r.normal(0, 1, (1 << quality.LOG2_FEATURES) + 1).astype(np.float32)
    long_words = spark.createDataFrame([(99, "x" * 70 + "!!A " + "Q1" * 50, "en", 0.0, 0)], odd.schema)
    some = odd.union(long_words).filter("length(coalesce(text, '')) < 5000")
    got = sorted((x.row or -1, x.score) for x in quality.score(some, w).collect())
    want = sorted((x.row or -1, plain_quality(x.text, w)) for x in some.collect())
    assert [g[0] for g in got] == [x[0] for x in want]
    assert np.allclose([g[1] for g in got], [x[1] for x in want], atol=1e-5)


def plain_toxicity(text, w):
    clean = 1.0
    for sentence in re.findall(rb"[^.!?\n]+", (text or "").encode()):
        z = float(w[-1]) + sum(float(w[f]) for word in sentence.split() for f in toxicity.word_features(word))
        clean *= 1 - 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))
    return 1 - clean


def test_toxicity_scores(spark, odd):
    w = np.zeros((1 << toxicity.LOG2_FEATURES) + 1, np.float32)
    w[:-1] = np.random.default_rng(2).exponential(0.3, len(w) - 1)
    w[-1] = -5
    some = odd.filter("length(coalesce(text, '')) < 5000")
    got = sorted((x.row or -1, x.score) for x in toxicity.score(some, w).collect())
    want = sorted((x.row or -1, plain_toxicity(x.text, w)) for x in some.collect())
    assert np.allclose([g[1] for g in got], [x[1] for x in want], atol=1e-6)


def test_queries_return_sentences_and_held_out(spark, tables):
    got = queries.op3_noisy_or_toxicity(spark, tables)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "sentences"] and got.count() == len(odd_documents())


def luhn_card(r):
    d = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if pii.luhn(d + c))


def not_luhn(r):
    card = luhn_card(r)
    return card[:-1] + str((int(card[-1]) + 3) % 10)


def test_a_pattern_is_no_evidence_for_itself(spark, run):
    """Nine seeds and eight strangers behind "the": 9/17 stays 9/17 in every round."""
    r = random.Random(3)
    docs = [f"read the {luhn_card(r)} again" for _ in range(9)] + [f"read the {not_luhn(r)} again" for _ in range(8)]
    shared = [not_luhn(r) for _ in range(4)]
    # Behind "code" four of ten are strangers, but all four stand behind the trusted "card:" too.
    docs += [f"card: {luhn_card(r)} ok" for _ in range(40)] + [f"card: {s} ok" for s in shared]
    docs += [f"code {luhn_card(r)} ok" for _ in range(6)] + [f"code {s} ok" for s in shared]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {(x.cue, x.shape): x.confidence for x in pii.learned(table, run).collect()}
    assert ("the", "916") not in found and found["card:", "916"] > 0.9 and found["code", "916"] > 0.8


def test_long_cues_and_instances_stay_apart():
    a, b = "x" * 45 + "a", "x" * 45 + "b"
    assert pii.cue(f"{a} 12", 47) != pii.cue(f"{b} 12", 47) and len(pii.cue(f"{a} 12", 47)) < 60
    assert pii.cue("one card:  \n 12", 13) == "card:" and pii.cue("  12", 2) == "^" and pii.cue("a (b", 3) == "a ("[:0] + "("
    token = "a" * 100 + "1" + "b" * 10 + "2"
    assert [m[0] for m in pii.mentions(f"see {token} now")] == [None]
    assert pii.shape("a1-" * 40) != pii.shape("a1-" * 41)


def test_columns_whose_names_clash(spark, odd, tables):
    named = odd.withColumnRenamed("lang", "Base").withColumnRenamed("score", "found").withColumn("__key", F.lit(1))
    for patterns in ([], [("card", "card;", "*")], spark.createDataFrame([("card", "card;", "*")], "kind string, cue string, shape string")):
        got = pii.redacted(named, patterns)
        assert got.columns == named.columns and got.count() == len(odd_documents())
    clash = odd.withColumnRenamed("score", "Score").withColumn("__score", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, clash, tables).columns == clash.columns, name


def test_quality_stage_keeps_what_scores_half(spark, odd, tables):
    weights = quality.train(spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{tables}/labels.parquet"))
    want = sorted(str(x.row) for x in quality.score(odd, weights).filter("score >= 0.5").collect())
    got = corpus_pipeline.quality_stage(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables)
    assert sorted(str(x.row) for x in got.collect()) == want


@pytest.mark.parametrize("text, n", [("MIT", 1), ("a mit b. Mit", 2), ("none", 0)])
def test_phrases_of_one_word(spark, text, n):
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (x,) = licenses.scan(table, {"mit": "mit"}).collect()
    assert x.n_base == n and x.base_labels == ("mit" if n else "")

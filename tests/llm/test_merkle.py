"""The manifest against a tree built row by row."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wattledger.llm import merkle, queries
from wattledger.llm.common import numbered

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Last digest, and per node its siblings (left, right) by level."""
    paths, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(now) > 1:
        for i, p in enumerate(paths):
            a = at[i] // 16 * 16
            p.append(("".join(now[a : at[i]]), "".join(now[at[i] + 1 : a + 16])))
        now = [digest(*now[a : a + 16]) for a in range(0, len(now), 16)]
        at = [x // 16 for x in at]
    return now[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]])
    root, over = tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, over):
        for r, own in zip(groups[s], trees[s][1]):
            path, node = own + above, leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path:
                node = digest(left, node, right)
            out.append((r[0], leaf(r), trees[s][0], root, digest(*[a + b for a, b in path]), node, node == root))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def sample(n, sources, seed):
    r = random.Random(seed)
    ids = r.sample([*range(-300, 3 * n), 1 << 62, -(1 << 63), (1 << 63) - 1], n)
    rows = [(i, r.choice(sources), r.choice(["en", None]), r.choice([None, 7]), r.choice([None, "", "Text É", "low"]) or f"T{i}") for i in ids]
    rows += [(None, sources[0], None, None, t) for t in (None, "", "a", "a", "B")]
    return rows + [(5, "twice", "en", 1, "X"), (5, "twice", "en", 1, "Y"), (5, "twice", "en", 1, "Y"), (9, "alone", None, None, None)]


@pytest.mark.parametrize("n, sources", [(700, ["a", "b", None, "é"]), (60, [f"s{i}" for i in range(40)])])
def test_manifest(spark, folder, n, sources):
    rows = sample(n, sources, n)
    table = spark.createDataFrame(rows, COLUMNS).withColumn("leaf", F.lit(1)).withColumn("src", F.lit("x"))
    table.repartition(4).write.parquet(f"{folder}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, folder)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert ordered(map(tuple, got.collect())) == ordered(brute(rows))


def test_ranks_and_nodes(spark, run):
    rows = [(i * i, "s" if i % 3 else None, "en", 1, "t") for i in range(500)]
    made = merkle.build(spark.createDataFrame(rows, COLUMNS), run)
    asked = [(s, i) for i, s, *_ in rows] + [("s", 2), ("none", 1), (None, 4)]
    got = {(r.source, r.doc_id): r.at for r in made.rank(spark.createDataFrame(asked, "source string, doc_id long")).collect()}
    want = {}
    for s in ("s", None):
        want |= {(s, i): k for k, i in enumerate(sorted(i for i, x, *_ in rows if x == s))}
    assert got == want
    levels = {(r.source, r.level): r.n for r in made.nodes().groupBy("source", "level").agg(F.count("*").alias("n")).collect()}
    assert levels == {("s", 1): 21, ("s", 2): 2, ("s", 3): 1, (None, 1): 11, (None, 2): 1, (None, -1): 1}


def test_no_rows_and_one_row(spark, run):
    assert merkle.build(spark.createDataFrame([], COLUMNS), run).proofs().count() == 0
    (one,) = merkle.build(spark.createDataFrame([(1, None, None, None, None)], COLUMNS), run).proofs().collect()
    assert one.digest == one.subroot == one.root == leaf((1, None, None, None, None)) and one.path == []


def test_numbered(spark, run):
    r = random.Random(3)
    values = [(r.randrange(50), f"v{i}") for i in range(300)]
    got = numbered(spark.createDataFrame(values, "k long, v string").repartition(7), ["k", "v"], run, "n").collect()
    assert [(x.k, x.v) for x in sorted(got, key=lambda x: x.at)] == sorted(values)
    assert sorted(x.at for x in got) == list(range(300))

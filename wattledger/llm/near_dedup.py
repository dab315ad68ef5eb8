"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Two bijections of the 32-bit shingle space give every signature coordinate: the first is
applied once, the second to its result shifted circularly by the coordinate's number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import Bloom, Hashes, Run, arrow, slices, utf8, window_hashes
from wattledger.llm.graph import components

BANDS, ROWS = 25, 5
K = BANDS * ROWS
#: A pair whose signatures agree in fewer coordinates than the threshold less this many
#: standard errors is not verified: one in 10^9 pairs at the threshold.
ERRORS = 6.0


def shingles(words: list[bytes], hashes: Hashes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.array(words)
    return np.unique(window_hashes(h, min(size, len(h))))


def _first(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    x = x ^ (x >> np.uint32(15))
    return x * np.uint32(0x85EBCA77)


def signatures(sets: list[np.ndarray], k: int = K, piece: int = 1 << 16) -> np.ndarray:
    """(documents, k) coordinates of non-empty sets.

    Coordinate i is the smallest of p2(p1(x) + i) over the set, where p1 and p2 are bijections
    of the 32-bit numbers and the sum wraps round.
    """
    out = np.full((len(sets), k), 0xFFFFFFFF, np.uint32)
    sizes = np.array([len(s) for s in sets])
    group = (np.cumsum(sizes) - sizes) // piece
    for g in np.unique(group):
        rows = np.flatnonzero(group == g)
        x = _first((np.concatenate([sets[r] for r in rows]) >> np.uint64(32)).astype(np.uint32))
        starts = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
        y, t = np.empty_like(x), np.empty_like(x)
        for i in range(k):
            np.add(x, np.uint32(i), out=y)
            for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
                np.right_shift(y, np.uint32(shift), out=t)
                np.bitwise_xor(y, t, out=y)
                np.multiply(y, np.uint32(factor), out=y)
            np.right_shift(y, np.uint32(16), out=t)
            np.bitwise_xor(y, t, out=y)
            out[rows, i] = np.minimum.reduceat(y, starts)
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per document and band, different between bands."""
    s = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), s.shape[:2]).copy()
    for j in range(rows):
        key ^= s[:, :, j]
        key *= np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, band keys, coordinates)."""
    schema, spark_schema = arrow({"doc_id": pa.int64(), "n_shingles": pa.int64(), "digest": pa.binary(), "bands": pa.list_(pa.int64()), "sig": pa.binary()})

    def run(batches):
        hashes = Hashes()
        for b in batches:
            ids = b.column(0).to_pylist()
            for first, texts in slices(b, 1, 2 << 20):
                sets = [shingles(t.lower().split(), hashes, size) for t in texts]
                full = [i for i, s in enumerate(sets) if len(s)]
                digest, bands, low = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    sig = signatures([sets[i] for i in full])
                    for i, keys, s in zip(full, band_keys(sig), sig):
                        digest[i], bands[i], low[i] = xxhash.xxh3_128_digest(sets[i]), keys, s.tobytes()
                yield pa.record_batch([pa.array(ids[first : first + len(sets)], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())], schema=schema)

    return docs.select("doc_id", utf8().alias("t")).mapInArrow(run, spark_schema)


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, set) of the wanted representatives. Texts are read again; only rows that pass a
    fixed-size filter of the wanted ids leave the scan."""
    bloom = docs.sparkSession.sparkContext.broadcast(Bloom.of(wanted.select(F.xxhash64("rep").alias("h")), "h", 25).words)
    schema, spark_schema = arrow({"rep": pa.int64(), "set": pa.binary()})

    def run(batches):
        hashes, filt = Hashes(), Bloom(bloom.value)
        for b in batches:
            ids = b.column(0)
            keep = pa.array(filt.has(b.column(1).to_numpy(zero_copy_only=False)))
            b = b.filter(keep)
            if not b.num_rows:
                continue
            ids = b.column(0).to_pylist()
            for first, texts in slices(b, 2):
                sets = [shingles(t.lower().split(), hashes, size).tobytes() for t in texts]
                yield pa.record_batch([pa.array(ids[first : first + len(sets)], pa.int64()), pa.array(sets, pa.binary())], schema=schema)

    read = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("doc_id").alias("h"), utf8().alias("t"))
    return read.mapInArrow(run, spark_schema).join(wanted, "rep", "left_semi").dropDuplicates(["rep"])


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * same >= percent * (small + large - same)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, members: int = 64) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold. A hot ``a`` is dealt out in groups of
    about ``members``; its set goes once to each group."""
    n = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    groups = n.select("a", F.ceil(F.col("n") / members).cast("int").alias("g"))
    left = groups.join(sets.select(F.col("rep").alias("a"), "set"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("s"), F.lit(None).cast("long").alias("b"), "set")
    dealt = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("g")).cast("int").alias("s"), "b")
    right = dealt.join(sets.select(F.col("rep").alias("b"), "set"), "b").select("a", "s", "b", "set")
    both = left.union(right).repartition("a", "s").sortWithinPartitions("a", "s", F.col("b").asc_nulls_first())
    schema, spark_schema = arrow({"a": pa.int64(), "b": pa.int64()})

    def run(batches):
        own, key = None, None
        for batch in batches:
            found = []
            for a, s, b, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x = np.frombuffer(data, np.uint64)
                if b is None:
                    own, key = x, (a, s)
                elif key == (a, s):
                    if _linked(x, own, percent):
                        found.append((a, b))
            yield pa.record_batch([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], schema=schema)

    return both.mapInArrow(run, spark_schema)


def _tiles(rows: DataFrame, tile: int) -> DataFrame:
    """``rows`` (key, n, rep, ...) dealt to all pairs (i, j) of tiles of about ``tile`` members of
    one bucket; ``own`` is the row's tile."""
    tiles = F.ceil(F.col("n") / tile).cast("int")
    dealt = rows.withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, F.col("own")).alias("i"), F.greatest(t, F.col("own")).alias("j")))
    return dealt.withColumn("p", F.explode(pairs)).select("*", "p.i", "p.j").drop("p", "tiles", "n")


def _probable(x: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (p, q) in ``x`` and agreements of the pairs between tiles i and j that lie in
    different components, share no earlier band and may reach the threshold."""
    t = percent / 100
    least = K * t - ERRORS * (K * t * (1 - t)) ** 0.5
    own, c = x["own"].to_numpy(), x["c"].to_numpy()
    sig = np.frombuffer(b"".join(x["sig"].to_pylist()), np.uint32).reshape(-1, K)
    band, i, j = (x[name][0].as_py() for name in ("band", "i", "j"))
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    found = [np.empty((0, 3), np.int64)]
    for part in np.array_split(left, -(-len(left) // 32)) if len(left) else []:
        same = sig[part][:, None, :] == sig[right][None, :, :]
        n = same.sum(2, dtype=np.int32)
        before = same[:, :, : band * ROWS].reshape(*same.shape[:2], band, ROWS).all(3).any(2)
        n[before | (c[part][:, None] == c[right][None, :])] = 0
        p, q = np.nonzero(n >= least)
        found.append(np.stack([part[p], right[q], n[p, q]], 1))
    return tuple(np.concatenate(found).T)


def _crossing(buckets: DataFrame, reps: DataFrame, labels: DataFrame, sets: DataFrame, run: Run, percent: int, tile: int = 1024) -> DataFrame:
    """Links (a, b) that join the components found in one bucket, confirmed on full sets.

    Every pair of one bucket in different components is looked at once, in its first common
    band; a pair whose components the task has joined meanwhile is left out. So a task gives
    fewer links than it has members, and after this no link between components is missing.
    """
    named = buckets.join(labels, F.col("rep") == F.col("node"), "left").select("key", "band", "rep", F.coalesce("component", "rep").alias("c"))
    mixed = named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 < c1")
    rows = run.store(named.join(mixed.select("key", "n"), "key").join(reps.select("rep", "sig"), "rep"), "mixed")
    schema, spark_schema = arrow({"key": pa.int64(), "rep": pa.int64()})

    def involved(x: pa.Table) -> pa.Table:
        p, q, _ = _probable(x, percent)
        rep = x["rep"].to_numpy()[np.unique(np.concatenate([p, q]))]
        return pa.table([pa.array([x["key"][0].as_py()] * len(rep), pa.int64()), pa.array(rep)], schema=schema)

    near = run.store(_tiles(rows, tile).groupBy("key", "i", "j").applyInArrow(involved, spark_schema).distinct(), "near")
    size = near.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    full = rows.join(near, ["key", "rep"]).join(size, "key").drop("n").withColumnRenamed("m", "n").join(sets, "rep")
    pair_schema, pair_spark = arrow({"a": pa.int64(), "b": pa.int64()})

    def confirmed(x: pa.Table) -> pa.Table:
        p, q, n = _probable(x, percent)
        rep, c = x["rep"].to_numpy(), x["c"].to_pylist()
        data = x["set"].combine_chunks()  # read in place, set by set
        parent = {v: v for v in c}

        def top(v):
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            return v

        out = [[], []]
        for k in np.argsort(-n, kind="stable"):
            a, b = int(p[k]), int(q[k])
            u, v = top(c[a]), top(c[b])
            if u != v and _linked(np.frombuffer(data[a].as_buffer(), np.uint64), np.frombuffer(data[b].as_buffer(), np.uint64), percent):
                parent[u] = v
                out[0].append(int(min(rep[a], rep[b])))
                out[1].append(int(max(rep[a], rep[b])))
        return pa.table([pa.array(o, pa.int64()) for o in out], schema=pair_schema)

    return _tiles(full, tile).groupBy("key", "i", "j").applyInArrow(confirmed, pair_spark).distinct()


def near_duplicates(docs: DataFrame, run: Run, size: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents linked by 100 · |A ∩ B| >= percent · |A ∪ B| on word shingles.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable), kept. Words are split
    at ASCII white space, A-Z in lower case; texts of fewer words than ``size`` are one shingle;
    null, empty and blank texts have no shingles and link with nothing. Repeated rows link like
    any others; rows without doc_id are returned as their own, without a class.

    Equal sets are collapsed before banding. Of each bucket only links to its smallest member
    are tried first, one per member; then what remains between components of one bucket. Every link is confirmed on full sets.
    """
    sketch = run.store(_sketches(docs, size), "sketches")
    known = sketch.filter("n_shingles > 0 and doc_id is not null")
    classes = run.store(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = run.store(
        known.join(classes, "digest").filter("doc_id = rep").dropDuplicates(["rep"]).select("rep", "bands", "sig"), "reps")
    # A doc_id whose rows have different texts stands for each of them.
    spread = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    full = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("first")).filter("n > 1")
    buckets = run.store(spread.join(full, "key").select("key", "band", "rep", "first"), "buckets")
    sets = run.store(_sets(docs, buckets.select("rep").distinct(), size), "sets")
    star = buckets.filter("rep <> first").groupBy("rep", "first").agg(F.count(F.lit(1)).alias("n"))
    star = star.groupBy("rep").agg(F.max_by("first", F.struct("n", -F.col("first"))).alias("first"))
    pairs = run.store(star.select(F.least("rep", "first").alias("a"), F.greatest("rep", "first").alias("b")).distinct(), "pairs")
    links = run.store(_verified(pairs, sets, percent), "links")
    labels = components(links, run)
    crossing = run.store(_crossing(buckets, reps, labels, sets, run, percent), "links")
    labels = components(links.union(crossing), run)
    whole = classes.join(labels, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = sketch.select("doc_id", "n_shingles", "digest").join(whole, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))

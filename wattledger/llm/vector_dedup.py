"""Near-duplicate embeddings by randomised-rotation binary codes.

A rotated unit vector is stored as its signs and one correction factor. With them the inner
product with any other rotated vector has an unbiased estimate and a confidence bound; only
pairs whose bound reaches the threshold are computed again, exactly.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import Run, arrow
from wattledger.llm.graph import components

#: Tables of BITS sign bits each, from ROTATIONS rotations: a pair at cosine 0.9 shares a
#: bucket of some table with probability 0.98, at 0.95 with 0.9999.
TABLES, BITS = 24, 12
#: Standard errors added to an estimate before a pair is left out.
ERRORS = 5.0


@lru_cache
def rotation(d: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([d, number]).standard_normal((d, d)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(x: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, their signs (1 and -1) and correction factors: the inner product
    of each with its own code."""
    r = x.astype(np.float32) @ turned
    code = np.where(r >= 0, np.float32(1), np.float32(-1))
    return r, code, np.abs(r).sum(1) / np.sqrt(x.shape[1])


def estimates(code: np.ndarray, factor: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of coded vectors with rotated ones, pair by pair, and their
    standard errors."""
    d = code.shape[1]
    value = np.einsum("nd,nd->n", code, rotated) / np.sqrt(d) / factor
    return value, np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(d - 1, 1))


def table_keys(unit: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """(vectors, tables) bucket numbers: runs of sign bits of as many rotations as they take."""
    d = unit.shape[1]
    need = -(-tables * bits // d)
    signs = np.concatenate([unit.astype(np.float32) @ rotation(d, 1 + i) >= 0 for i in range(need)], 1)[:, : tables * bits]
    key = signs.reshape(len(unit), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
    return (d << 40) + (np.arange(tables, dtype=np.int64) << 20) + key


def units(raw: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _prepared(vectors: DataFrame, id_column: str, column: str, kind: type) -> DataFrame:
    """(vec_id, digest, components as bytes, keys) of usable vectors."""
    schema, spark_schema = arrow({"vec_id": pa.int64(), "digest": pa.binary(), "raw": pa.binary(), "keys": pa.list_(pa.int64())})

    def run(batches):
        for b in batches:
            for first in range(0, b.num_rows, 2048):
                part = b.slice(first, 2048)
                groups: dict[int, list] = {}
                for i, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if i is None or not v or any(c is None for c in v):
                        continue
                    groups.setdefault(len(v), []).append((i, v))
                for got in groups.values():
                    ids, x = np.array([g[0] for g in got]), np.array([g[1] for g in got], np.float64)
                    largest = np.abs(x).max(1)
                    good = np.isfinite(largest) & (largest > 0)
                    ids, x = ids[good], x[good]
                    if not len(ids):
                        continue
                    unit = units(x)
                    raw = [v.tobytes() for v in x.astype(kind)]
                    yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([xxhash.xxh3_128_digest(u.tobytes()) for u in unit], pa.binary()), pa.array(raw, pa.binary()), pa.array(list(table_keys(unit)), pa.list_(pa.int64()))], schema=schema)

    doubles = F.col(column).cast("array<double>")
    return vectors.select(F.col(id_column).cast("long"), doubles).mapInArrow(run, spark_schema)


def near_vectors(vectors: DataFrame, run: Run, id_column: str = "vec_id", column: str = "embedding", threshold: float = 0.9, tile: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    so do vectors of different length. Vectors with one direction are collapsed; a link between
    two such classes counts for all their members. A repeated vec_id counts as one member. The
    24 tables of 12 bits are the only approximate step: whoever shares a bucket is found.

    A bucket is dealt out as pairs of tiles of ``tile`` members; a pair of vectors is looked at
    in its first common table. Tasks return counts per vector and a spanning set of links.
    """
    element = vectors.schema[column].dataType.elementType.typeName()
    kind = np.float32 if element == "float" else np.float64
    ready = run.store(_prepared(vectors, id_column, column, kind), "codes")
    classes = run.store(
        ready.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("m")), "classes")
    reps = run.store(ready.join(classes, "digest").filter("vec_id = rep").dropDuplicates(["rep", "digest"]).select("rep", "m", "raw", "keys"), "reps")
    spread = reps.select("rep", F.posexplode("keys").alias("table", "key"))
    full = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = spread.join(full, "key").join(reps.drop("keys"), "rep")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = rows.withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, F.col("own")).alias("i"), F.greatest(t, F.col("own")).alias("j")))
    dealt = rows.withColumn("p", F.explode(pairs)).select("key", "p.i", "p.j", "table", "own", "rep", "m", "raw")
    shares = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(shares, "key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    schema, spark_schema = arrow({"a": pa.int64(), "n": pa.int64(), "b": pa.int64()})

    def compared(x: pa.Table):
        """Counts and links of whole buckets of vectors of one length, sorted."""
        rep, own, m, table, i, j = (x[c].to_numpy() for c in ("rep", "own", "m", "table", "i", "j"))
        unit = units(np.frombuffer(b"".join(x["raw"].to_pylist()), kind).reshape(len(rep), -1))
        keys, d = table_keys(unit), unit.shape[1]
        rotated, code, factor = encode(unit, rotation(d, 0))
        place = np.stack([x["key"].to_numpy(), i, j])
        starts = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(0)))
        count, parent, links = np.zeros(len(rep), np.int64), np.arange(len(rep)), []

        def top(v):
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            return v

        def judge(p, q):
            value, error = estimates(code[p], factor[p], rotated[q])
            near = value + ERRORS * error + 1e-5 >= threshold
            p, q = p[near], q[near]
            first = ~((keys[p] == keys[q]) & (np.arange(TABLES) < table[p][:, None])).any(1)
            p, q = p[first], q[first]
            linked = np.einsum("nd,nd->n", unit[p], unit[q]) >= threshold
            p, q = p[linked], q[linked]
            np.add.at(count, p, m[q])
            np.add.at(count, q, m[p])
            for a, b in zip(p.tolist(), q.tolist()):
                u, v = top(a), top(b)
                if u != v:
                    parent[u] = v
                    links.append((int(rep[a]), int(rep[b])))

        held, size = [], 0
        for a, e in zip(starts, [*starts[1:], len(rep)]):
            left, right = a + np.flatnonzero(own[a:e] == i[a]), a + np.flatnonzero(own[a:e] == j[a])
            for part in np.array_split(left, -(-len(left) // 64)) if len(left) else []:
                p, q = np.repeat(part, len(right)), np.tile(right, len(part))
                if i[a] == j[a]:
                    p, q = p[p < q], q[p < q]
                held.append((p, q))
                size += len(p)
                if size >= 1 << 16:
                    judge(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            judge(*map(np.concatenate, zip(*held)))
        some = np.flatnonzero(count)
        ends = np.append(rep[some], [e[0] for e in links]).astype(np.int64)
        n = [*count[some].tolist(), *[None] * len(links)]
        b = [*[None] * len(some), *(e[1] for e in links)]
        return pa.table([pa.array(ends), pa.array(n, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    def run_buckets(batches):
        rest = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rest = new if rest is None else pa.concat_tables([rest, new])
            if rest.num_rows < 4 * tile:
                continue
            place = np.stack([rest[c].to_numpy() for c in ("key", "i", "j")])
            last = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0))
            if len(last):
                yield from by_length(rest.slice(0, last[-1] + 1))
                rest = rest.slice(last[-1] + 1)
        if rest is not None and rest.num_rows:
            yield from by_length(rest)

    def by_length(x):
        d = x["key"].to_numpy() >> 40
        for a, e in zip((cut := [0, *(np.flatnonzero(np.diff(d)) + 1), len(d)]), cut[1:]):
            yield from compared(x.slice(a, e - a).combine_chunks()).to_batches()

    found = run.store(dealt.mapInArrow(run_buckets, spark_schema), "found")
    counts = found.filter("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    labels = components(found.filter("b is not null").select("a", "b"), run)
    whole = classes.join(counts, "rep", "left").join(labels, F.col("rep") == F.col("node"), "left").select(
        "digest", (F.coalesce("others", F.lit(0)) + F.col("m") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    members = ready.select(F.col("vec_id").alias("id"), "digest").distinct().join(whole, "digest").groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    own = F.col("vec_id")
    out = vectors.select(F.col(id_column).cast("long").alias("vec_id")).join(members, own == F.col("id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(component == own, F.lit(True)).alias("kept"))

"""Document fingerprints from improbable features.

Every window of ``WINDOW`` bytes has an entropy class; classes are ranked by how few windows of
the corpus have them. A window is a feature if it is the rarest in many of the runs of windows
around it. Features go into a chain of Bloom filters of fixed size, a new one for each
``CAPACITY`` features, and fingerprints are compared by their filters' common bits, less what
chance gives.
"""

from __future__ import annotations

import base64
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import arrow, mixed, ship, slices, utf8

WINDOW, CLASSES = 24, 1000
#: Runs of windows, of the WINDOW that hold it, that a window must lead to be a feature.
LEAD = 6
#: Classes below this say little (repeats, or the zeros before a text's begin): they come last.
WEAK = 450
BITS, PROBES, CAPACITY = 2048, 5, 160
_FAR = 1 << 20

_EXACT = np.round(np.array([0.0, *(c * np.log2(c) for c in range(1, WINDOW + 1))]) * (1 << 20)).astype(np.int64)
_STEP = np.diff(_EXACT, prepend=0)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class (0 to 1000 of the largest entropy) of the WINDOW bytes from every place on.

    The sum of c log c over a window's byte counts c changes by the counts of the byte that
    leaves and the byte that enters; numbers are integers, so equal windows have equal classes.
    """
    n = len(data) - WINDOW + 1
    ahead, behind = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    sums = np.empty(n, np.int64)
    sums[0] = _EXACT[np.bincount(data[:WINDOW])].sum()
    sums[1:] = _STEP[behind[WINDOW:].astype(np.intp) + 1] - _STEP[ahead[: n - 1].astype(np.intp) + 1]
    np.cumsum(sums, out=sums)
    return CLASSES * (_EXACT[WINDOW] - sums) // _EXACT[WINDOW]


class Laid:
    """Texts laid end to end, each after WINDOW - 1 zeros, so that every byte ends a window."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.cumsum(sizes + WINDOW - 1) - (sizes + WINDOW - 1)
        pad = bytes(WINDOW - 1)
        self.data = np.frombuffer(pad + pad.join(texts), np.uint8) if texts else np.empty(0, np.uint8)
        edges = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(edges, self.begin, 1)
        np.add.at(edges, self.begin + sizes, -1)
        self.valid = np.cumsum(edges[:-1], dtype=np.int8) > 0

    def blocks(self, block: int = 1 << 21):
        """(a, b, lo, classes of the windows from lo on) of consecutive ranges of windows, each
        with the windows beside it that its runs reach."""
        n = len(self.data) - WINDOW + 1
        for a in range(0, n, block):
            b = min(a + block, n)
            lo, hi = max(0, a - WINDOW + 1), min(n, b + WINDOW - 1)
            yield a, b, lo, entropy_classes(self.data[lo : hi + WINDOW - 1])


def class_counts(documents: DataFrame) -> np.ndarray:
    """Windows of each entropy class in all texts; the driver gets one row per class."""
    schema, spark_schema = arrow({"c": pa.int32(), "n": pa.int64()})

    def run(batches):
        total = np.zeros(CLASSES + 1, np.int64)
        for b in batches:
            for _, texts in slices(b, 0):
                laid = Laid(texts)
                for a, e, lo, classes in laid.blocks():
                    own = classes[a - lo : e - lo][laid.valid[a:e]]
                    total += np.bincount(own, minlength=CLASSES + 1)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], schema=schema)

    out = np.zeros(CLASSES + 1, np.int64)
    for r in documents.select(utf8().alias("t")).mapInArrow(run, spark_schema).groupBy("c").agg(F.sum("n").alias("n")).collect():
        out[r.c] = r.n
    return out


def ranking(counts: np.ndarray) -> np.ndarray:
    """Rank of every class: the fewer windows, the earlier; weak ones last, those nearest to
    the others first."""
    order = sorted(range(CLASSES + 1), key=lambda c: (c < WEAK, -c if c < WEAK else counts[c], -c))
    out = np.empty(CLASSES + 1, np.int64)
    out[order] = np.arange(CLASSES + 1)
    return out


def features(laid: Laid, rank: np.ndarray) -> np.ndarray:
    """Ascending places of the windows that are features. Every text that isn't empty has one."""
    found = []
    for a, b, lo, classes in laid.blocks():
        hi = lo + len(classes)
        key = np.where(laid.valid[lo:hi], rank[classes], _FAR) << 32 | np.arange(len(classes))
        outside = np.full(WINDOW - 1, _FAR << 32)
        best = np.concatenate([outside[: WINDOW - 1 - (a - lo)], key, outside[: WINDOW - 1 - (hi - b)]])
        size = 1
        while size < WINDOW:  # smallest of every WINDOW neighbours, the leftmost among equals
            step = min(size, WINDOW - size)
            best = np.minimum(best[:-step], best[step:])
            size += step
        led = np.bincount(best & 0xFFFFFFFF, minlength=len(key))
        led[~laid.valid[lo:hi]] = 0
        found.append(np.flatnonzero(led[a - lo : b - lo] >= LEAD) + a)
    return np.concatenate(found) if found else np.empty(0, np.int64)


class Prints:
    """Chains of filters of many texts: ``first[i]`` to ``first[i + 1]`` are those of text i."""

    def __init__(self, texts: list[bytes], rank: np.ndarray):
        laid = Laid(texts)
        at = features(laid, rank)
        words = laid.data[at[:, None] + np.arange(WINDOW)].view(np.uint64) if len(at) else np.empty((0, WINDOW // 8), np.uint64)
        h = np.zeros(len(at), np.uint64)
        for k in range(WINDOW // 8):
            h = mixed(h ^ words[:, k] + np.uint64(k + 1))
        text = np.searchsorted(laid.begin, at, "right") - 1
        # A feature counts once in a text, where it stands first.
        order = np.lexsort((at, h, text))
        new = np.append(True, (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])) if len(at) else np.empty(0, bool)
        kept = np.sort(order[new])
        h, text = h[kept], text[kept]
        many = np.bincount(text, minlength=len(texts))
        chain = -(-many // CAPACITY)
        self.first = np.concatenate([[0], np.cumsum(chain)])
        nth = np.arange(len(h)) - np.repeat(np.cumsum(many) - many, many)
        owner = self.first[text] + nth // CAPACITY
        bits = np.zeros((self.first[-1], BITS), bool)
        for k in range(PROBES):
            bits[owner, (h >> np.uint64(11 * k)).astype(np.int64) & (BITS - 1)] = True
        self.count = np.bincount(owner, minlength=self.first[-1])
        self.filters = np.packbits(bits, axis=1)

    def own(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.first[i], self.first[i + 1]
        return self.count[a:b], self.filters[a:b]


Print = tuple[np.ndarray, np.ndarray]


def written(p: Print) -> str:
    """Features and bits of every filter of the chain, ``count:base64``, separated by ``|``."""
    return "|".join(f"{n}:{base64.b64encode(f.tobytes()).decode()}" for n, f in zip(p[0].tolist(), p[1]))


def parsed(text: str) -> Print:
    parts = [x.split(":") for x in text.split("|")] if text else []
    filters = [np.frombuffer(base64.b64decode(f), np.uint8) for _, f in parts]
    return np.array([int(n) for n, _ in parts], np.int64), np.array(filters, np.uint8).reshape(-1, BITS // 8)


def _shares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per filter of ``a`` the best overlap with one of ``b``, and the other way round: the share
    of the filter's bits that are common, from what chance gives (three standard errors above
    its mean) up to all of them, as 0 to 1."""
    x, y = a.view(np.uint64), b.view(np.uint64)
    p, q = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    best_a, best_b = np.zeros(len(p)), np.zeros(len(q))

    def scaled(common, own, other):
        chance = other / BITS
        floor = chance + 3 * np.sqrt(chance * (1 - chance) / own)
        return np.where(floor < 1, (common / own - floor) / np.where(floor < 1, 1 - floor, 1), 0)

    rows = max(1, (1 << 18) // len(q))
    for i in range(0, len(p), rows):
        part = slice(i, i + rows)
        common = np.bitwise_count(x[part, None, :] & y[None, :, :]).sum(2, dtype=np.int64)
        best_a[part] = scaled(common, p[part, None], q[None, :]).max(1)
        best_b = np.maximum(best_b, scaled(common, q[None, :], p[part, None]).max(0))
    return np.maximum(best_a, 0), best_b


def likeness(a: Print, b: Print) -> float:
    """0 to 1: the filters' best overlaps, weighted by their features, over both chains. Equal
    fingerprints have 1, also two empty ones; an empty one has 0 with any other."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    if len(a[0]) == len(b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    s, t = _shares(a[1], b[1])
    return float((s @ a[0] + t @ b[0]) / (a[0].sum() + b[0].sum()))


def fingerprints(documents: DataFrame, rank: np.ndarray) -> DataFrame:
    """The columns of ``documents`` but ``text``, and ``fingerprint``: a text of the chain, empty
    for null and empty texts. Equal texts have equal fingerprints under one ``rank``; a column
    named ``fingerprint`` is replaced."""
    ship(documents.sparkSession)
    rest = [c for c in documents.columns if c.lower() not in ("text", "fingerprint")]
    df = documents.select(*rest, utf8().alias("__utf8"))
    schema = T.StructType([*documents.select(*rest).schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for b in batches:
            at, out = b.num_columns - 1, []
            for _, texts in slices(b, at):
                prints = Prints(texts, rank)
                out += [written(prints.own(i)) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(out, pa.string())], [*b.schema.names[:at], "fingerprint"])

    return df.mapInArrow(run, schema)


def compared(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``likeness`` of the fingerprints in two columns; null where one is null."""
    ship(pairs.sparkSession)

    @F.pandas_udf("double")
    def of(a, b):
        import pandas as pd

        return pd.Series([None if x is None or y is None else likeness(parsed(x), parsed(y)) for x, y in zip(a, b)], dtype=float)

    return pairs.withColumn("likeness", of(left, right))


def _ordered(documents: DataFrame):
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("h"), "text")


def _begins(rows: DataFrame, ranges: int) -> list[tuple]:
    """The first key of each range of rows in descending order of doc_id; ``ranges`` at most."""
    schema, spark_schema = arrow({"doc_id": pa.int64(), "h": pa.int64()})

    def first(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0).slice(0, 1), b.column(1).slice(0, 1)], schema=schema)
                for _ in batches:
                    pass
                return

    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    ranged = rows.select("doc_id", "h").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return sorted(_key(r.doc_id, r.h) for r in ranged.mapInArrow(first, spark_schema).collect())


def _key(doc_id: int | None, h: int) -> tuple:
    return (1, 0, h) if doc_id is None else (0, -doc_id, h)


def edits(documents: DataFrame, rank: np.ndarray, part: int = 3, piece: int = 2 << 20) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next of every
    row: its fingerprint against that of its edited text, whose last floor(n_chars / ``part``)
    code points are the first ones of the next row, and against that of the next row.

    Rows stand in descending order of doc_id, those without doc_id last, those of one doc_id in
    order of a hash of their texts (equal rows are each other's next); after the last row comes
    the first. Null counts as empty. One range of rows is read in order by one task; the row
    that follows it is sent to it besides, so nothing else needs a neighbour's task. The keys at
    which ranges begin, two for each shuffle partition, are all that every task holds.
    """
    spark = documents.sparkSession
    ship(spark)
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _ordered(documents)
    begins = _begins(rows, 2 * shares)
    sent = spark.sparkContext.broadcast(begins)
    schema, spark_schema = arrow({"range": pa.int32(), "tail": pa.bool_(), "doc_id": pa.int64(), "h": pa.int64(), "text": pa.string()})

    def deal(batches):
        begins, told = sent.value, set()
        starts = {k: i for i, k in enumerate(begins)}
        for b in batches:
            keys = [_key(*x) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            at = [bisect_right(begins, k) - 1 for k in keys]
            new = [i for i, k in enumerate(keys) if k in starts and k not in told]
            firsts = {keys[i]: i for i in new}
            told.update(firsts)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([False] * len(at)), *b.columns], schema=schema)
            if firsts:
                more = b.take(pa.array(list(firsts.values())))
                to = [(starts[k] - 1) % len(begins) for k in firsts]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([True] * len(to)), *more.columns], schema=schema)

    dealt = rows.select("doc_id", "h", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(deal, spark_schema)
    dealt = dealt.repartition(shares, "range").sortWithinPartitions("range", "tail", F.col("doc_id").desc_nulls_last(), "h", "text")
    results = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
    out_schema, out_spark = arrow(results)

    def answer(ids, texts, following):
        """Rows ``ids`` with ``texts``; ``following`` is the text after the last of them."""
        after = [*texts[1:], following]
        edited = []
        for t, n in zip(texts, after):
            k = len(t) // part
            edited.append(t[: len(t) - k] + n[:k])
        prints = Prints([t.encode() for t in [*texts, following]], rank)
        changed = Prints([t.encode() for t in edited], rank)
        own = [prints.own(i) for i in range(len(texts) + 1)]
        said = [written(p) for p in own[:-1]]
        other = [changed.own(i) for i in range(len(edited))]
        columns = [ids, [len(t) for t in texts], edited, said, [written(p) for p in other], [likeness(p, q) for p, q in zip(own, other)], [likeness(p, q) for p, q in zip(own, own[1:])]]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, out_schema)], schema=out_schema)

    def run(batches):
        held, ids, texts, size = None, [], [], 0
        for b in batches:
            for at, tail, i, text in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if tail:
                    if at == held and texts:
                        yield answer(ids, texts, text)
                    held, ids, texts, size = None, [], [], 0  # further copies of the tail say nothing new
                    continue
                if size > piece:
                    yield answer(ids, texts, text)
                    ids, texts, size = [], [], 0
                held = at
                ids.append(i)
                texts.append(text)
                size += len(text)

    return dealt.mapInArrow(run, out_spark)

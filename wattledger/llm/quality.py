"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader updates and scored as sparse dot products."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import arrow, ship, slices, utf8

LOG2_FEATURES = 18
BUCKETS = np.uint64((1 << LOG2_FEATURES) - 1)
#: Labelled rows a model is fitted on at most, those with the smallest seeded hash of doc_id.
TRAIN_ROWS = 6_000


def _shape(word: bytes) -> bytes:
    """Kinds of characters in order, runs as one: ``THE!!`` is ``A!``."""
    out = bytearray()
    for c in word:
        k = 65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c
        if not out or out[-1] != k:
            out.append(k)
    return bytes(out)


class Words(dict):
    """Per word the hash of its lower case and, in the high half, that of its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        low = xxhash.xxh32_intdigest(word.lower())
        value = self[word] = xxhash.xxh32_intdigest(_shape(word), 7) << 32 | low
        return value


def features(texts: list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, one after the other, and where each text's begin.

    Per text: words and pairs of words in lower case; one to three shapes in a row; for each
    word whether it repeats one of the two before. Begin and end count as words, so an empty
    text has features too.
    """
    lists = [[b"\x01", *t.split(), b"\x02"] for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(map(words.__getitem__, chain.from_iterable(lists)), np.uint64, int(counts.sum()))
    low, shape = flat & np.uint64(0xFFFFFFFF), flat >> np.uint64(32)

    begins = np.cumsum(counts) - counts

    def shifted(a, by):
        """The value ``by`` words before in the same text, 0 before its begin."""
        out = np.zeros_like(a)
        out[by:] = a[:-by]
        for k in range(by):
            out[begins + k] = 0  # a text has two words at least
        return out

    m = np.uint64(0x9E3779B97F4A7C15)
    one, two = shifted(shape, 1), shifted(shape, 2)
    before = shifted(low, 1)
    again = (low == before).astype(np.uint64) + np.uint64(2) * (low == shifted(low, 2)).astype(np.uint64)
    views = [
        low * m + np.uint64(1), (low * np.uint64(31) + before) * m + np.uint64(2),
        shape * m + np.uint64(3), (shape * np.uint64(31) + one) * m + np.uint64(4),
        ((shape * np.uint64(31) + one) * np.uint64(31) + two) * m + np.uint64(5), again * m + np.uint64(6),
    ]
    grid = np.empty((len(flat), len(views)), np.uint32)
    for i, v in enumerate(views):
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        grid[:, i] = v >> np.uint64(64 - LOG2_FEATURES)
    starts = begins * len(views)
    return grid.reshape(-1), starts


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels no model may see: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, y, text as bytes) of a bounded sample of labelled rows.

    Only the sample's ids (at most ``rows``) are broadcast. A document with conflicting labels
    counts as its larger label.
    """
    known = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(rows)
    return documents.select("doc_id", utf8().alias("t")).join(F.broadcast(sample), "doc_id").select("doc_id", "y", "t")


@dataclass
class Ftrl:
    """Follow-the-proximally-regularised-leader with per-coordinate rates."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    epochs: int = 4

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 1) -> np.ndarray:
        """Weights, the bias last. rows: feature numbers and values of each document."""
        size = (1 << LOG2_FEATURES) + 1
        z, n = np.zeros(size), np.zeros(size)
        order = np.random.default_rng(seed)
        last = np.array([size - 1])
        for _ in range(self.epochs):
            for r in order.permutation(len(rows)):
                at, x = np.append(rows[r][0], last), np.append(rows[r][1], 1.0)
                g0 = z[at]
                w = -(g0 - np.sign(g0) * self.l1) / ((self.beta + np.sqrt(n[at])) / self.alpha + self.l2)
                w[np.abs(g0) <= self.l1] = 0
                p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
                g = (p - y[r]) * x
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / self.alpha
                z[at] += g - sigma * w
                n[at] += g * g
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0
        return w

    def calibrated(self, rows: list, y: np.ndarray, seed: int = 1, folds: int = 3, least: int = 5) -> np.ndarray:
        """``fit`` on all rows, with the bias moved so that a score of 0.5 parts the classes best.

        Every row is scored by a model of the other folds; the cut is the middle of the widest
        gap among the cuts whose mean share of both classes found is within 0.002 of the best.
        With fewer than ``least`` rows of a class the bias stays.
        """
        fold = np.random.default_rng(seed).permutation(len(rows)) % folds
        w = self.fit(rows, y, seed)
        if min(y.sum(), (1 - y).sum()) < least:
            return w
        z = np.empty(len(rows))
        for k in range(folds):
            others = self.fit([r for r, f in zip(rows, fold) if f != k], y[fold != k], seed)
            for i in np.flatnonzero(fold == k):
                z[i] = others[rows[i][0]] @ rows[i][1] + others[-1]
        truth = y[np.argsort(z, kind="stable")]
        z = np.sort(z)
        # Cut k leaves the scores up to k below it.
        share = (np.cumsum(truth[::-1])[::-1][1:] / truth.sum() + np.cumsum(1 - truth)[:-1] / (1 - truth).sum()) / 2
        best = np.flatnonzero(share >= share.max() - 0.002)
        k = best[np.argmax(z[best + 1] - z[best])]
        w[-1] -= (z[k] + z[k + 1]) / 2
        return w


SCALE = 8.0


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, learner: Ftrl | None = None) -> np.ndarray:
    """Weights (2^18 and a bias), fitted on a bounded labelled sample in one task.

    Without labels of both classes all weights are 0 and every score is 0.5. A document with
    several rows counts with each of them; rows without doc_id have no label.
    """
    learner = learner or Ftrl()
    ship(documents.sparkSession)
    sample = training_rows(documents, labels, label, rows)
    schema, spark_schema = arrow({"w": pa.binary()})

    def extract(batches):
        words = Words()
        for b in batches:
            ids, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            for first, texts in slices(b, 2, 2 << 20):
                f, starts = features(texts, words)
                at = []
                for part in np.split(f, starts[1:]):
                    u, c = np.unique(part, return_counts=True)
                    at.append(np.concatenate([u.astype(np.uint32), (SCALE * c / len(part)).astype(np.float32).view(np.uint32)]).tobytes())
                n = len(texts)
                yield pa.record_batch([pa.array(ids[first : first + n], pa.int64()), pa.array(ys[first : first + n], pa.int32()), pa.array(at, pa.binary())], ["doc_id", "y", "f"])

    def fit(batches):
        got = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
        got.sort()
        y = np.array([g[1] for g in got], float)
        if len(got) and 0 < y.sum() < len(y):
            found = []
            for _, _, f in got:
                a = np.frombuffer(f, np.uint32)
                found.append((a[: len(a) // 2], a[len(a) // 2 :].view(np.float32)))
            yield pa.record_batch([pa.array([learner.calibrated(found, y).astype(np.float32).tobytes()], pa.binary())], schema=schema)

    found = sample.mapInArrow(extract, "doc_id long, y int, f binary")
    for r in found.repartition(1).mapInArrow(fit, spark_schema).collect():  # one row at most
        return np.frombuffer(r.w, np.float32)
    return np.zeros((1 << LOG2_FEATURES) + 1, np.float32)


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """(row's columns, score) for each document, by a dot product over its whole text.

    Null and empty texts are scored as empty texts. Columns named ``score`` (in any case) are
    replaced. Every row is scored by itself, repeated ones and those without doc_id too.
    """
    spark = documents.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(weights.astype(np.float32))
    kept = [c for c in documents.columns if c.lower() != "score"]
    df = documents.select(*kept, utf8().alias("__utf8"))
    schema = T.StructType([*documents.select(*kept).schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        words, w = Words(), sent.value
        for b in batches:
            at = b.num_columns - 1
            out = np.empty(b.num_rows)
            for first, texts in slices(b, at, 2 << 20):
                f, starts = features(texts, words)
                sums = np.add.reduceat(w[f], starts, dtype=np.float64)
                sizes = np.diff(np.append(starts, len(f)))
                out[first : first + len(texts)] = 1 / (1 + np.exp(-np.clip(SCALE * sums / sizes + float(w[-1]), -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(out)], [*b.schema.names[:at], "score"])

    return df.mapInArrow(run, schema)

"""Toxicity by multiple-instance learning: sentences are instances, noisy-or makes them a
document, and only documents have labels."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import arrow, ship, slices, utf8
from wattledger.llm.quality import training_rows

LOG2_FEATURES = 18
#: Labelled rows a model is fitted on at most, those with the smallest seeded hash of doc_id.
TRAIN_ROWS = 8_000
ENDS = re.compile(rb"[.!?\n]+")
EDGES = b" \t\r\n.,;:!?\"'()[]{}|*#$%&<>=+-_/\\"


def word_features(word: bytes) -> tuple[int, ...]:
    """Numbers of the word in lower case and of its first four and five characters."""
    w = word.strip(EDGES).decode("utf-8", "ignore").lower()
    if not w:
        return ()
    views = {"w" + w, "4" + w[:4], "5" + w[:5]} if len(w) > 4 else {"w" + w}
    return tuple(xxhash.xxh32_intdigest(v) & (1 << LOG2_FEATURES) - 1 for v in sorted(views))


def sentence_bounds(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the sentences, in order."""
    at, out = 0, []
    for m in ENDS.finditer(text):
        if m.start() > at:
            out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


class Model:
    """Noisy-or of logistic sentence scores, fitted by adaptive gradient steps with shrinkage.

    The gradient of a document's log likelihood for the logit of sentence s is -p_s if the
    document is clean and p_s (1 - P) / P if it is toxic: clean documents lower all their
    sentences, toxic ones raise those that already look worst.
    """

    def __init__(self, epochs: int = 12, rate: float = 0.8, l1: float = 5e-4, bias: float = -6.0):
        self.epochs, self.rate, self.l1, self.bias = epochs, rate, l1, bias

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int) -> np.ndarray:
        """docs: features of all sentences and the number of features of each."""
        size = 1 << LOG2_FEATURES
        w, g2 = np.zeros(size + 1), np.ones(size + 1)
        w[size] = self.bias
        order = np.random.default_rng(seed)
        for _ in range(self.epochs):
            for r in order.permutation(len(docs)):
                f, lengths = docs[r]
                if not len(lengths):
                    continue
                of = np.repeat(np.arange(len(lengths)), lengths)
                z = np.bincount(of, w[f], len(lengths)) + w[size]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                log_clean = np.log1p(-np.minimum(p, 1 - 1e-12)).sum()
                whole = -np.expm1(log_clean)
                g = p if y[r] == 0 else -p * np.exp(log_clean) / max(whole, 1e-9)
                u, inverse = np.unique(f, return_inverse=True)
                step = np.bincount(inverse, g[of], len(u))
                g2[u] += step * step
                rate = self.rate / np.sqrt(g2[u])
                moved = w[u] - rate * step
                w[u] = np.maximum(moved - rate * self.l1, 0)
                total = g.sum()
                g2[size] += total * total
                w[size] = min(w[size] - 0.1 * self.rate / np.sqrt(g2[size]) * total, -4.0)
        return w

    def calibrated(self, docs: list, y: np.ndarray, seed: int, share: float = 0.7, least: int = 6) -> np.ndarray:
        """``fit`` on all rows, with the bias moved by what serves rows left out best.

        A model of three quarters of the rows scores the last quarter; of the shifts of the bias
        the one with the best F-measure at ``share`` is taken, the smallest among equals. With fewer than
        ``least`` toxic rows left out the bias stays.
        """
        part = np.random.default_rng(seed).permutation(len(docs)) % 4 == 0
        w = self.fit(docs, y, seed)
        if least <= y[part].sum() < part.sum() and 0 < y[~part].sum() < (~part).sum():
            half = self.fit([d for d, x in zip(docs, part) if not x], y[~part], seed)
            left_out, truth = [d for d, x in zip(docs, part) if x], y[part] == 1
            logits = [np.bincount(np.repeat(np.arange(len(n)), n), half[f], len(n)) + half[-1] for f, n in left_out]

            def quality(shift):
                toxic = np.array([-np.expm1(-np.logaddexp(0, z + shift).sum()) >= share for z in logits])
                hits = (toxic & truth).sum()
                return 2 * hits / max(1, toxic.sum() + truth.sum())

            shifts = np.arange(-8, 25) / 4
            w[-1] += max(shifts, key=lambda s: (quality(s), -abs(s)))
        return w


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, model: Model | None = None) -> np.ndarray:
    """Weights and bias, fitted on a bounded labelled sample in one task.

    Without labels of both classes there is no model: every sentence has the starting bias. A
    document with several rows counts with each of them; rows without doc_id have no label.
    """
    model = model or Model()
    ship(documents.sparkSession)
    sample = training_rows(documents, labels, label, rows)
    schema, spark_schema = arrow({"w": pa.binary()})

    def extract(batches):
        known: dict[bytes, tuple] = {}
        for b in batches:
            ids, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            for first, texts in slices(b, 2):
                fs, ls = [], []
                for text in texts:
                    f, lengths = [], []
                    for a, e in sentence_bounds(text):
                        n = len(f)
                        for word in text[a:e].split():
                            got = known.get(word)
                            if got is None:
                                if len(known) >= 200_000:
                                    known.clear()
                                got = known[word] = word_features(word)
                            f.extend(got)
                        lengths.append(len(f) - n)
                    fs.append(np.array(f, np.uint32).tobytes())
                    ls.append(np.array(lengths, np.uint32).tobytes())
                n = len(texts)
                yield pa.record_batch([pa.array(ids[first : first + n], pa.int64()), pa.array(ys[first : first + n], pa.int32()), pa.array(fs, pa.binary()), pa.array(ls, pa.binary())], ["doc_id", "y", "f", "l"])

    def fit(batches):
        got = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
        got.sort()
        y = np.array([g[1] for g in got])
        if len(got) and 0 < y.sum() < len(y):
            docs = [(np.frombuffer(f, np.uint32).astype(np.int64), np.frombuffer(n, np.uint32).astype(np.int64)) for _, _, f, n in got]
            yield pa.record_batch([pa.array([model.calibrated(docs, y, 1).astype(np.float32).tobytes()], pa.binary())], schema=schema)

    found = sample.mapInArrow(extract, "doc_id long, y int, f binary, l binary")
    for r in found.repartition(1).mapInArrow(fit, spark_schema).collect():  # one row at most
        return np.frombuffer(r.w, np.float32)
    start = np.zeros((1 << LOG2_FEATURES) + 1, np.float32)
    start[-1] = model.bias
    return start


def score(documents: DataFrame, weights: np.ndarray, sentence_share: float = 0.5) -> DataFrame:
    """The columns of ``documents`` (but ``text``), ``score``, and ``sentences``: code point
    ranges of those scored ``sentence_share`` or more. Null, empty and wordless texts score 0.
    Every row is scored by itself, repeated ones and those without doc_id too.
    """
    spark = documents.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(weights.astype(np.float32))
    rest = [c for c in documents.columns if c.lower() not in ("text", "score", "sentences")]
    df = documents.select(*rest, utf8().alias("__utf8"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    found = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
    schema = T.StructType([*documents.select(*rest).schema.fields, T.StructField("score", T.DoubleType()), T.StructField("sentences", found)])

    def run(batches):
        w = sent.value
        bias = float(w[-1])
        known: dict[bytes, float] = {}
        for b in batches:
            at = b.num_columns - 1
            scores, spans = [], []
            for _, texts in slices(b, at):
                for text in texts:
                    words = text.split()
                    for word in set(words).difference(known):
                        if len(known) > 300_000:
                            known.clear()
                        known[word] = sum(float(w[f]) for f in word_features(word))
                    # Sentences whose words have no weight at all share one score.
                    bounds = sentence_bounds(text)
                    live = {x for x in set(words) if known.get(x, 1)}
                    log_clean, own = 0.0, []
                    plain = -float(np.log1p(np.exp(bias)))
                    for a, e in bounds if live else ():
                        parts = text[a:e].split()
                        z = bias
                        for word in parts:
                            got = known.get(word)
                            if got is None:
                                got = known[word] = sum(float(w[f]) for f in word_features(word))
                            z += got
                        z = min(max(z, -30.0), 30.0)
                        log_clean -= float(np.log1p(np.exp(z)))
                        p = 1 / (1 + np.exp(-z))
                        if p >= sentence_share:
                            start = len(text[:a].decode("utf-8", "replace"))
                            own.append({"start": start, "end": start + len(text[a:e].decode("utf-8", "replace")), "score": float(p)})
                    if not live:
                        log_clean = plain * len(bounds)
                    scores.append(float(-np.expm1(log_clean)))
                    spans.append(own)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], [*b.schema.names[:at], "score", "sentences"])

    return df.mapInArrow(run, schema)

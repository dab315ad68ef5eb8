"""Benchmark decontamination by winnowing.

Training and test fingerprints (the smallest k-gram hash of every window) are joined, and each
hit is extended word by word. For a window of L words, k = (L + 1) // 2 and L - k + 1
consecutive k-grams are compared: equal windows always choose the same k-gram, so every shared
span of L words is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import ALNUM, Bloom, Hashes, Run, arrow, selected, slices, utf8, window_hashes


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


def _levels(window: int) -> dict[int, tuple[int, int]]:
    """Per length of a window: k and the number of k-grams compared."""
    return {n: ((n + 1) // 2, n + 1 - (n + 1) // 2) for n in range(1, window + 1)}


def _prints(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints for windows of ``n`` words."""
    k, w = _levels(n)[n]
    grams = window_hashes(h, k)
    at = selected(grams, w)
    return at, grams[at] ^ np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def _context(words: list[bytes], at: int, n: int) -> tuple[int, bytes]:
    """First word and text of what windows of ``n`` words with the k-gram at ``at`` can cover."""
    k, w = _levels(n)[n]
    first = max(0, at - w + 1)
    return first, b" ".join(words[first : at + k + w - 1])


def item_prints(benchmark: DataFrame, window: int) -> DataFrame:
    """(fp, n, item_id, at, context) of every item; items shorter than a window are one."""
    schema, spark_schema = arrow({"fp": pa.int64(), "n": pa.int32(), "item_id": pa.string(), "lead": pa.int32(), "context": pa.binary()})

    def run(batches):
        hashes = Hashes()
        for b in batches:
            names = b.column(0).to_pylist()
            for first, texts in slices(b, 1):
                rows = [[] for _ in range(5)]
                for name, text in zip(names[first:], texts):
                    words = words_of(text)
                    if not words:
                        continue
                    n = min(window, len(words))
                    for at, fp in zip(*_prints(hashes.array(words), n)):
                        start, context = _context(words, int(at), n)
                        for column, value in zip(rows, (int(fp.view(np.int64)), n, name, int(at) - start, context)):
                            column.append(value)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return benchmark.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), utf8().alias("t")).mapInArrow(run, spark_schema)


def _candidates(docs: DataFrame, lengths: list[int], bloom: Bloom) -> DataFrame:
    """Per document (row, doc_id, n_words, hits), where hits holds the fingerprints that pass
    the filter, with their contexts."""
    hit = pa.struct([("fp", pa.int64()), ("start", pa.int32()), ("lead", pa.int32()), ("context", pa.binary())])
    schema, spark_schema = arrow({"row": pa.int64(), "doc_id": pa.int64(), "n_words": pa.int64(), "hits": pa.list_(hit)})
    sent = docs.sparkSession.sparkContext.broadcast(bloom.words)

    def run(batches):
        hashes, filt = Hashes(), Bloom(sent.value)
        for b in batches:
            row, ids = b.column(0), b.column(1)
            for first, texts in slices(b, 2):
                lists = [words_of(t) for t in texts]
                counts = np.array([len(x) for x in lists])
                h = hashes.array([w for x in lists for w in x])
                bounds = np.concatenate([[0], np.cumsum(counts)])
                hits = [[] for _ in texts]
                for n in lengths:
                    # Over all texts of the piece at once; what spans two texts is left out, and
                    # what a border may have hidden is looked up text by text.
                    k, w = _levels(n)[n]
                    grams = window_hashes(h, k) ^ np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                    for d in np.unique(np.searchsorted(bounds, np.flatnonzero(filt.has(grams)), "right") - 1):
                        if counts[d] < n:
                            continue
                        at, fp = _prints(h[bounds[d] : bounds[d + 1]], n)
                        for i in np.flatnonzero(filt.has(fp)):
                            start, context = _context(lists[d], int(at[i]), n)
                            hits[d].append((int(fp[i].view(np.int64)), start, int(at[i]) - start, context))
                keys = ("fp", "start", "lead", "context")
                m = len(texts)
                yield pa.record_batch([row.slice(first, m), ids.slice(first, m), pa.array(counts.astype(np.int64)), pa.array([[dict(zip(keys, x)) for x in r] for r in hits], pa.list_(hit))], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", utf8().alias("t"))
    return rows.mapInArrow(run, spark_schema)


def _extended(pairs: DataFrame) -> DataFrame:
    """Word spans [a, b) of the documents that windows of items cover, by extending each joined
    fingerprint in both directions."""
    schema, spark_schema = arrow({"row": pa.int64(), "item_id": pa.string(), "a": pa.int32(), "b": pa.int32()})

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for row, item, n, start, lead, mine, lead2, other in zip(*(c.to_pylist() for c in batch.columns)):
                x, y, k = mine.split(b" "), other.split(b" "), (n + 1) // 2
                if x[lead : lead + k] != y[lead2 : lead2 + k]:
                    continue
                left = 0
                while left < lead and left < lead2 and x[lead - left - 1] == y[lead2 - left - 1]:
                    left += 1
                i, j = lead + k, lead2 + k
                while i < len(x) and j < len(y) and x[i] == y[j]:
                    i, j = i + 1, j + 1
                if i - (lead - left) >= n:
                    for column, value in zip(out, (row, item, start + lead - left, start + i)):
                        column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return pairs.select("row", "item_id", "n", "start", "lead", "context", "lead2", "context2").mapInArrow(run, spark_schema)


def contamination(docs: DataFrame, benchmark: DataFrame, run: Run, window: int = 13, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    Words are runs of 0-9, a-z (A-Z in lower case) and non-ASCII characters. A word is hit if it
    lies in an occurrence of ``window`` consecutive words of an item, or of a whole shorter item.
    Contaminated: some word is hit, and at least one in ``share``. Null and empty texts have no
    words; items without words or item_id are ignored; repeated rows are judged one by one.

    The test set's fingerprints are sent as a filter of fixed size, which only thins out the
    documents' side of the join.
    """
    prints = run.store(item_prints(benchmark, window), "prints")
    lengths = sorted(r.n for r in prints.select("n").distinct().collect())  # ``window`` at most
    found = run.store(_candidates(docs, lengths, Bloom.of(prints, "fp", 23)), "candidates")
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    # Items with one context are extended once.
    distinct = prints.withColumnsRenamed({"lead": "lead2", "context": "context2"})
    spans = run.store(_extended(hits.join(distinct, "fp")).distinct(), "spans")
    words = spans.select("row", "a", "b").distinct().groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("a", F.col("b") - 1))))).cast("long").alias("n_hit"))
    items = spans.select("row", "item_id").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    out = found.select("row", "doc_id", "n_words").join(words, "row", "left").join(items, "row", "left")
    n = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        ((n > 0) & (share * n >= F.col("n_words"))).alias("contaminated"))



"""Repeated passages by a suffix order of what can repeat, one bucket of suffixes at a time.

Only suffixes that can repeat are sorted. In every ``length`` bytes the smallest hash of a
``GRAM``-byte string is an anchor; equal strings choose the same anchor at the same distance.
Anchors that occur once are dropped. Suffixes of one anchor string form a bucket, which is
sorted on its own: by the first bytes, and where those tie, by precomputed ranks of the cover
sample, the 32-byte strings at every 32nd place counted from the anchor. Counting from the
anchor gives suffixes that can be equal the same residue, so a cover of one residue suffices.

Anchor strings with many runs are not sorted: their windows are grouped by a 128-bit hash, the
earliest of each is found by a combined minimum, and the others are joined to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.byte_bpe import spread
from wattledger.llm.common import Bloom, Run, arrow, mixed, slices, utf8

GRAM, STEP = 50, 32
#: Places for which hashes and anchors are worked out at once.
PART = 1 << 16
#: Bytes of text that a task works on at once; its arrays take some sixty times as much.
SLICE = 2 << 20


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from every place on, by doubling."""
    h, size, done, out = data.astype(np.uint64) + np.uint64(1), 1, 0, None
    while True:
        if k & size:
            n = len(data) - done - size + 1
            part = h[done : done + n]
            out = part.copy() if out is None else out[:n] * np.uint64(0xD6E8FEB86659FD93) + part
            done += size
        if done == k:
            return mixed(out)
        n = len(h) - size
        h = mixed(h[:n] * np.uint64(0x9E3779B97F4A7C15) + h[size : size + n])
        size *= 2


def anchors(h: np.ndarray, w: int) -> np.ndarray:
    """For every window of ``w`` hashes the place of its smallest, the last among equals."""
    best, at, size = h, np.zeros(len(h), np.uint8 if w <= 256 else np.int64), 1
    while size < w:
        step = min(size, w - size)
        n = len(best) - step
        later = best[step : step + n] <= best[:n]
        at = np.where(later, at[step : step + n] + at.dtype.type(step), at[:n])
        best = np.minimum(best[:n], best[step : step + n])
        size += step
    return np.arange(len(at)) + at


def hashes_and_anchors(data: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """``gram_hashes`` of ``data`` and their ``anchors``, worked out for ``PART`` places at a time,
    so that what they pass over again and again stays in a processor's cache."""
    n = len(data) - GRAM + 1
    h, at = np.empty(n, np.uint64), np.empty(n - w + 1, np.int64)
    for a in range(0, len(at), PART):
        e = min(a + PART, len(at))
        part = gram_hashes(data[a : e + w - 1 + GRAM - 1], GRAM)
        h[a : e + w - 1] = part
        at[a:e] = anchors(part, w)
        at[a:e] += a
    return h, at


class Slice:
    """Runs of windows with one anchor in a slice of documents laid end to end."""

    def __init__(self, texts: list[bytes], length: int, block: int, blocks: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.cumsum(sizes) - sizes
        empty = np.empty(0, np.int64)
        self.first = self.last = self.anchor = self.doc = empty
        self.bounds, self.fp = bounds, np.empty(0, np.uint64)
        usable = sizes >= length
        if not usable.any():
            return
        h, at = hashes_and_anchors(self.data, length - GRAM + 1)
        inside = np.zeros(len(at), bool)
        inside[spread(bounds[usable], sizes[usable] - length + 1)] = True
        starts = np.flatnonzero(inside)
        at = at[starts]
        cut = np.flatnonzero(np.append(True, (np.diff(at) != 0) | (np.diff(starts) != 1)))
        first, last = starts[cut], starts[np.append(cut[1:], len(starts)) - 1]
        anchor = at[cut]
        own = (h[anchor] >> np.uint64(40)) % np.uint64(blocks) == np.uint64(block)
        self.first, self.last, self.anchor, self.fp = first[own], last[own], anchor[own], h[anchor[own]]
        self.doc = np.searchsorted(bounds, self.first, "right") - 1


def _anchor_prints(docs: DataFrame, length: int, block: int, blocks: int) -> DataFrame:
    """(fp, n) of the anchors, summed up within slices."""
    schema, spark_schema = arrow({"fp": pa.int64(), "n": pa.int64()})

    def run(batches):
        for b in batches:
            for _, texts in slices(b, 2, SLICE):
                fp, n = np.unique(Slice(texts, length, block, blocks).fp.view(np.int64), return_counts=True)
                yield pa.record_batch([pa.array(fp), pa.array(n)], schema=schema)

    return docs.mapInArrow(run, spark_schema)


FIELDS = {"fp": pa.int64(), "doc": pa.int64(), "row": pa.int64(), "first": pa.int64(), "last": pa.int64(), "lead": pa.int32(), "context": pa.binary()}


def _member(fp: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which of ``fp`` are in the ascending ``hot``."""
    at = np.searchsorted(hot, fp)
    return (at < len(hot)) & (hot[np.minimum(at, len(hot) - 1)] == fp) if len(hot) else np.zeros(len(fp), bool)


def _contexts(docs: DataFrame, length: int, block: int, blocks: int, bloom: Bloom, hot: np.ndarray) -> DataFrame:
    """Per run of windows around an anchor that may repeat and isn't in ``hot``: its place and
    bytes. Of equal ones in a slice only the first is given out whole, the others as windows
    found to repeat (context null)."""
    sent = docs.sparkSession.sparkContext.broadcast((bloom.words, hot))
    schema, spark_schema = arrow(FIELDS)

    def run(batches):
        words, hot = sent.value
        filt = Bloom(words)
        for b in batches:
            ids, rows = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for base, texts in slices(b, 2, SLICE):
                s = Slice(texts, length, block, blocks)
                some = np.flatnonzero(filt.has(s.fp) & ~_member(s.fp.view(np.int64), hot))
                if not len(some):
                    continue
                doc, first, last, fp = s.doc[some], s.first[some], s.last[some], s.fp[some].view(np.int64)
                lead = s.anchor[some] - first
                order = np.lexsort((first, rows[base + doc], ids[base + doc]))
                whole = s.data.tobytes()
                seen: set = set()
                out = []
                for k in order:
                    context = whole[first[k] : last[k] + length]
                    key = (int(lead[k]), xxhash.xxh3_128_digest(context))
                    out.append(None if key in seen else context)
                    seen.add(key)
                place = s.bounds[doc[order]]
                yield pa.record_batch([
                    pa.array(fp[order]), pa.array(ids[base + doc[order]]), pa.array(rows[base + doc[order]]),
                    pa.array(first[order] - place), pa.array(last[order] - place), pa.array(lead[order].astype(np.int32)),
                    pa.array(out, pa.binary())], schema=schema)

    return docs.mapInArrow(run, spark_schema)


def _hot_windows(docs: DataFrame, length: int, block: int, blocks: int, hot: np.ndarray) -> DataFrame:
    """Windows around the anchors in ``hot``: of equal ones in a slice the earliest with its hash
    (h1, h2), the others as ranges of places found to repeat (h1 null)."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)
    schema, spark_schema = arrow({"h1": pa.int64(), "h2": pa.int64(), "doc": pa.int64(), "row": pa.int64(), "first": pa.int64(), "last": pa.int64()})

    def run(batches):
        for b in batches:
            ids, rows = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for base, texts in slices(b, 2, SLICE):
                s = Slice(texts, length, block, blocks)
                some = np.flatnonzero(_member(s.fp.view(np.int64), sent.value))
                if not len(some):
                    continue
                whole = s.data.tobytes()
                order = some[np.lexsort((s.first[some], rows[base + s.doc[some]], ids[base + s.doc[some]]))]
                sizes = s.last[order] - s.first[order] + 1
                digests = b"".join(
                    b"".join([xxhash.xxh3_128_digest(whole[i : i + length]) for i in range(f, f + n)])
                    for f, n in zip(s.first[order].tolist(), sizes.tolist()))
                h = np.frombuffer(digests, np.int64).reshape(-1, 2)
                at, doc = spread(s.first[order], sizes), np.repeat(s.doc[order], sizes)
                by = np.lexsort((np.arange(len(h)), h[:, 1], h[:, 0]))
                new = np.append(True, (np.diff(h[by], axis=0) != 0).any(1))
                earliest = np.zeros(len(h), bool)
                earliest[by[new]] = True
                a = np.flatnonzero(earliest)
                place = at - s.bounds[doc]
                again = np.flatnonzero(~earliest)
                cut = np.flatnonzero(np.append(True, (np.diff(at[again]) != 1) | (np.diff(doc[again]) != 0))) if len(again) else again
                e = again[np.append(cut[1:], len(again)) - 1] if len(again) else again
                f = again[cut]
                both = np.concatenate([a, f])
                known = np.arange(len(both)) >= len(a)
                yield pa.record_batch([
                    pa.array(h[both, 0], mask=known), pa.array(h[both, 1], mask=known),
                    pa.array(ids[base + doc[both]]), pa.array(rows[base + doc[both]]),
                    pa.array(place[both]), pa.array(place[np.concatenate([a, e])])], schema=schema)

    return docs.mapInArrow(run, spark_schema)


def _hot_spans(windows: DataFrame, length: int) -> DataFrame:
    """(doc, row, a, b) as of ``_spans``, from stored hot windows: the minimum is combined before the
    shuffle, and adaptive execution splits a hash that many slices have."""
    place = F.struct("doc", "row", "first")
    firsts = windows.filter("h1 is not null").groupBy("h1", "h2").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = windows.join(firsts.select("h1", "h2", "least"), ["h1", "h2"]).filter(place != F.col("least"))
    # ``least`` is the earliest of the whole block; ranges found within a slice come as they are.
    return later.select("doc", "row", "first", "last").union(windows.filter("h1 is null").select("doc", "row", "first", "last")).select(
        "doc", "row", F.col("first").alias("a"), (F.col("last") + length).alias("b"))


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them."""
    out = np.zeros(len(at), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | data[at + i].astype(np.uint64)
    return out


def _refined(kind: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that still tie after sorting by (kind, key), in that order, and their new kinds."""
    order = np.lexsort((key, kind))
    new = np.append(True, (np.diff(kind[order]) != 0) | (key[order][1:] != key[order][:-1]))
    kinds = np.cumsum(new)
    tied = ~new | ~np.append(new[1:], True)
    return order[tied], kinds[tied]


def repeated_windows(fp, doc, row, first, last, lead, contexts: list[bytes], length: int) -> np.ndarray:
    """(run, window) pairs of the windows equal to an earlier one. All runs of an anchor string
    must be present; runs stand in order of document and place."""
    sizes = last - first + 1
    data = np.frombuffer(b"".join(contexts) + bytes(STEP + 8), np.uint8)
    begin = np.cumsum(sizes + length - 1) - (sizes + length - 1)
    run = np.repeat(np.arange(len(fp)), sizes)
    nth = spread(np.zeros(len(sizes), np.int64), sizes)
    at = begin[run] + nth
    distance = lead[run] - nth
    # Cover sample: every 32nd place from the anchor on, to both sides.
    anchor = begin + lead
    low = -(lead // STEP)
    high = (sizes + length - 1 - lead - STEP) // STEP
    count = np.maximum(high - low + 1, 0)
    sample = np.repeat(anchor + low * STEP, count) + STEP * spread(np.zeros(len(count), np.int64), count)
    blocks = np.stack([_words(data, sample + 8 * i) for i in range(STEP // 8)], 1) if len(sample) else np.empty((0, 4), np.uint64)
    rank = np.zeros(len(data), np.int64)
    if len(sample):
        order = np.lexsort(blocks.T[::-1])
        rank[sample[order]] = np.cumsum(np.append(True, (np.diff(blocks[order].astype(np.int64), axis=0) != 0).any(1)))
    groups = np.unique(fp, return_inverse=True)[1]
    live, kind = _refined(groups[run], distance.astype(np.uint64))
    live_kind = (live, kind)

    def narrow(key_of):
        live, kind = live_kind
        if not len(live):
            return live_kind
        keep, kinds = _refined(kind, key_of(live))
        return live[keep], kinds

    for i in range(STEP // 8):
        live_kind = narrow(lambda x, i=i: _words(data, at[x] + 8 * i))
    # Long ties: the ranks of all sample places that surely lie inside, and the bytes behind
    # them as they are (two ranks and 40 bytes for 100).
    ranks = (length - STEP + 1) // STEP
    tail = -(-(length - STEP * ranks) // 8)
    for i in range(ranks):
        live_kind = narrow(lambda x, i=i: rank[at[x] + distance[x] % STEP + STEP * i].astype(np.uint64))
    for i in range(tail):
        live_kind = narrow(lambda x, i=i: _words(data, at[x] + length - 8 * (tail - i)))
    live, kind = live_kind
    if not len(live):
        return np.empty((0, 2), np.int64)
    order = np.lexsort((live, kind))
    later = live[order][np.append(False, np.diff(kind[order]) == 0)]
    return np.stack([run[later], nth[later]], 1)


def _spans(contexts: DataFrame, length: int, chunk: int = 4 << 20) -> DataFrame:
    """(doc, row, a, b): byte ranges whose strings of ``length`` bytes all occur earlier."""
    schema, spark_schema = arrow({"doc": pa.int64(), "row": pa.int64(), "a": pa.int64(), "b": pa.int64()})

    def bucket(table):
        # Of runs with equal bytes and one anchor place only the earliest is sorted: all windows
        # of the others are equal to its own.
        codes = table["context"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        earliest = np.zeros(len(codes), bool)
        earliest[np.unique(codes << 32 | table["lead"].to_numpy(), return_index=True)[1]] = True
        doc, row, first, last = (table[c].to_numpy() for c in ("doc", "row", "first", "last"))
        known = np.flatnonzero(~earliest)
        if len(known):
            yield pa.record_batch([pa.array(doc[known]), pa.array(row[known]), pa.array(first[known]), pa.array(last[known] + length)], schema=schema)
        table = table.filter(pa.array(earliest))
        fp, doc, row, first, last = (table[c].to_numpy() for c in ("fp", "doc", "row", "first", "last"))
        got = repeated_windows(fp, doc, row, first, last, table["lead"].to_numpy().astype(np.int64), table["context"].to_pylist(), length)
        if len(got):
            got = got[np.lexsort((got[:, 1], got[:, 0]))]
            new = np.append(True, (np.diff(got[:, 0]) != 0) | (np.diff(got[:, 1]) != 1))
            a, e = got[np.flatnonzero(new)], got[np.append(np.flatnonzero(new)[1:], len(got)) - 1]
            yield pa.record_batch([pa.array(doc[a[:, 0]]), pa.array(row[a[:, 0]]), pa.array(first[a[:, 0]] + a[:, 1]), pa.array(first[e[:, 0]] + e[:, 1] + length)], schema=schema)

    def run(batches):
        rest, size = [], 0
        for b in batches:
            t = pa.Table.from_batches([b])
            known = pa.compute.is_null(t["context"])
            done = t.filter(known)
            if done.num_rows:
                yield from pa.table([done["doc"], done["row"], done["first"], pa.compute.add(done["last"], length)], schema=schema).to_batches()
            t = t.filter(pa.compute.invert(known))
            rest.append(t)
            size += t.nbytes
            if size >= chunk and t.num_rows:
                whole = pa.concat_tables(rest)
                fp = whole["fp"].to_numpy()
                cut = int(np.searchsorted(fp, fp[-1]))
                if cut:
                    yield from bucket(whole.slice(0, cut).combine_chunks())
                    rest = [whole.slice(cut)]
                    size = rest[0].nbytes
        whole = pa.concat_tables(rest) if rest else None
        if whole is not None and whole.num_rows:
            yield from bucket(whole.combine_chunks())

    return contexts.mapInArrow(run, spark_schema)


def _distinct(rows: DataFrame, run: Run) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with each (doc, row) once, and a stored table (doc, row, copies) of those that stand
    more than once, None where none does. Only names are grouped; few texts are."""
    named = rows.groupBy("doc", "row").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    copies = run.store(named, "copies")
    if copies.isEmpty():
        return rows, None
    keys = copies.select("doc", "row")
    once = rows.join(keys, ["doc", "row"], "left_semi").dropDuplicates(["doc", "row"])
    return rows.join(keys, ["doc", "row"], "left_anti").select("doc", "row", "t").union(once.select("doc", "row", "t")), copies


def without_repeats(documents: DataFrame, run: Run, length: int = 100, block_bytes: int = 16 << 30, hot_runs: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of every row.

    A byte goes if a string of ``length`` bytes (92 at least) that covers it also starts earlier:
    in a smaller doc_id, or in the same row further left. Rows with one doc_id are in the order
    of a hash of their texts, and of equal rows one counts as the first; those without doc_id
    come first of all. Null counts as empty. A row is named by its doc_id and that hash in every
    job, so it doesn't matter how files are split in any of them.

    Anchor strings are dealt to blocks by hash, ``block_bytes`` of text to a block, and blocks
    are worked on one after the other: that bounds the filter of repeated anchors, which every
    task holds. The runs of one anchor string meet in one task if there are ``hot_runs`` at
    most, which bounds the windows that it sorts at once; the windows of the others are grouped
    by hash (of those anchors a block has one per ``hot_runs`` runs at most, so all tasks can
    hold the list).
    """
    if length < 92:
        raise ValueError("length must be 92 at least")
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), utf8().alias("t"))
    docs, copies = _distinct(rows.select("doc", F.xxhash64("t").alias("row"), "t"), run)
    total = docs.agg(F.sum(F.length("t"))).collect()[0][0] or 0
    blocks = max(1, -(-total // block_bytes))
    shares = int(run.spark.conf.get("spark.sql.shuffle.partitions"))
    spans = []
    for block in range(blocks):
        prints = run.store(_anchor_prints(docs, length, block, blocks).groupBy("fp").agg(F.sum("n").alias("n")).filter("n > 1"), "prints")
        bloom = Bloom.of(prints, "fp", 26)
        hot = np.sort(prints.filter(F.col("n") > hot_runs).select("fp").toArrow()["fp"].to_numpy())
        run.drop(prints)
        if len(hot):
            windows = run.store(_hot_windows(docs, length, block, blocks, hot), "windows")
            spans.append(run.store(_hot_spans(windows, length), "hot_spans"))
            run.drop(windows)
        contexts = _contexts(docs, length, block, blocks, bloom, hot)
        dealt = contexts.repartition(shares, F.when(F.col("context").isNull(), F.xxhash64("fp", "row")).otherwise(F.col("fp")))
        spans.append(run.store(_spans(dealt.sortWithinPartitions("fp", "doc", "row", "first"), length), "spans"))
    all_spans = spans[0]
    for s in spans[1:]:
        all_spans = all_spans.union(s)
    # Neighbouring ranges are merged per row before the texts come in.
    grouped = all_spans.groupBy("doc", "row").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))
    joined = docs.join(grouped, ["doc", "row"], "left")
    if copies is not None:  # every string of a further copy stands in the first one
        n = F.length("t").cast("long")
        whole = F.when(n >= length, F.array(F.struct(F.lit(0).cast("long").alias("a"), n.alias("b")))).otherwise(F.expr("cast(array() as array<struct<a: bigint, b: bigint>>)"))
        further = docs.join(copies, ["doc", "row"]).withColumn("k", F.explode(F.sequence(F.lit(2), "copies")))
        joined = joined.select("doc", "row", "t", "spans").union(further.select("doc", "row", "t", whole.alias("spans")))
    joined = joined.select(F.when(F.col("doc") > -(1 << 63), F.col("doc")).alias("doc_id"), "t", F.col("spans.a").alias("a"), F.col("spans.b").alias("b"))
    schema, spark_schema = arrow({"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()})

    def cut(batches):
        for batch in batches:
            for first, texts in slices(batch, 1):
                ids, a, b = (batch.column(i).slice(first, len(texts)).to_pylist() for i in (0, 2, 3))
                rows = []
                for i, text, starts, ends in zip(ids, texts, a, b):
                    kept, at, n = [], 0, 0
                    reach = None
                    for s, e in zip(starts or (), ends or ()):
                        if reach is None or s > reach:
                            if reach is not None:
                                at = reach
                            kept.append(text[at:s])
                            n += 1
                            reach = e
                        reach = max(reach, e)
                    kept = b"".join([*kept, text[reach or 0 :]])
                    rows.append((i, len(text), len(text) - len(kept), n, kept))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return joined.mapInArrow(cut, spark_schema)

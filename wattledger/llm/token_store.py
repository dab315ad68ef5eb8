"""Token ids in files for access by document: every document a zstandard frame of its own,
compressed with one dictionary that all share.

A store is a folder with

* ``dictionary``: one row (hash, bytes, width): the dictionary and the bytes per id;
* ``segments``: Parquet, one row per segment of consecutive documents, in ascending order of
  first_doc: part, dictionary_hash, first_doc, last_doc, start (ids before it in its part),
  doc_ids, offsets (documents + 1 byte places in payload), starts (ids before each document in
  its part), payload (the frames, one after the other);
* ``parts``: (part, base): ids before each part.

One document is read with the statistics of first_doc and last_doc, its offsets and one frame.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.llm.common import Run, arrow, ship, slices, spread
from wattledger.llm.pieces import Cut, Ids, Known, dealt, encoded


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct piece encoded once.

    A byte-level tokenizer never joins what stands on the two sides of a space before a word,
    so the ids of a text are those of its pieces. Texts that hold the content of an added token
    (``<|endoftext|>``) are encoded whole: the library looks for these before it splits.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.uint16 if self.width == 2 else np.uint32
        # In a byte-level vocabulary each character stands for a byte.
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.known = Known(1, self.kind, most)

    def _alone(self, texts: list[str]) -> list[Ids]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [(np.array([*chain.from_iterable(got)], self.kind), np.fromiter(map(len, got), np.int64, len(got)))]

    def _together(self, text: str, bounds: np.ndarray) -> list[Ids] | None:
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        counts = None if any(map(text.__contains__, self.added)) else dealt(ids, self.sizes, bounds)
        return None if counts is None else [(ids, counts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, ``width`` bytes each."""
        whole = [k for k, t in enumerate(texts) if any(map(t.__contains__, self.added))]
        if not whole:
            return self._by_pieces(texts)
        held = set(whole)
        rest = iter(self._by_pieces([t for k, t in enumerate(texts) if k not in held]))
        ids = (self.tokenizer.encode(texts[k], add_special_tokens=False).ids for k in whole)
        return [np.array(next(ids), self.kind).tobytes() if k in held else next(rest) for k in range(len(texts))]

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        cut = Cut(texts)
        ((table, starts, counts),) = self.known.of(cut, lambda new, led: encoded(new, led, self._together, self._alone))
        sizes = counts[cut.codes]
        ids = table[spread(starts[cut.codes], sizes)].tobytes()
        first = (np.concatenate([[0], np.cumsum(sizes)])[cut.first] * self.width).tolist()
        return [ids[a:e] for a, e in zip(first, first[1:])]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def dictionary_sample(documents: DataFrame, tokenizer: str, rows: int, piece: int) -> list[bytes]:
    """Serialised ids of the ``rows`` documents with the smallest hash of doc_id, ``piece`` bytes
    from the middle of each at most: the only bounded step, which decides on sizes, not ids."""
    chosen = documents.filter("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(41)), "doc_id").limit(rows)
    texts = documents.join(F.broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))

    def run(batches):
        encoder = encoder_of(tokenizer)
        for b in batches:
            for first, part in slices(b, 1, 1 << 20):
                raw = encoder.encode(part)
                half = [(len(r) - piece) // 2 // 4 * 4 if len(r) > piece else 0 for r in raw]
                yield pa.record_batch([b.column(0).slice(first, len(part)), pa.array([r[h : h + piece] for r, h in zip(raw, half)], pa.binary())], ["doc_id", "s"])

    return [r.s for r in texts.mapInArrow(run, "doc_id long, s binary").orderBy("doc_id", "s").collect()]


def write(documents: DataFrame, folder: str, run: Run, tokenizer: str, end_id: int = 0, dictionary_bytes: int = 64 << 10, sample_rows: int = 1000, sample_piece: int = 4096, segment_bytes: int = 1 << 20, level: int = 3) -> None:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes the store in
    ascending doc_id order; rows without doc_id come first, repeated ones in order of content.

    Only compressed frames are sorted by range, never texts.
    """
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    samples = [s for s in dictionary_sample(docs, tokenizer, sample_rows, sample_piece) if s]
    try:
        data = zstandard.train_dictionary(dictionary_bytes, samples, level=level).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples to train on
        data = b""
    width = Encoder(tokenizer).width


    digest = xxhash.xxh3_64_hexdigest(data)
    spark.createDataFrame([(digest, bytearray(data), width)], "hash string, bytes binary, width int").coalesce(1).write.parquet(f"{folder}/dictionary")
    schema, spark_schema = arrow({"doc_id": pa.int64(), "n": pa.int64(), "frame": pa.binary()})

    def compress(batches):
        encoder, shared = encoder_of(tokenizer), zstandard.ZstdCompressionDict(data) if data else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=shared)
        end = np.array([end_id], encoder.kind).tobytes()
        for b in batches:
            for first, texts in slices(b, 1, 8 << 20):
                ids = encoder.encode(texts)
                frames = [writer.compress(x + end) for x in ids]
                yield pa.record_batch([b.column(0).slice(first, len(texts)), pa.array([len(x) // width + 1 for x in ids], pa.int64()), pa.array(frames, pa.binary())], schema=schema)

    frames = run.store(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(compress, spark_schema), "frames", "none")
    seg = {"part": pa.int32(), "dictionary_hash": pa.string(), "first_doc": pa.int64(), "last_doc": pa.int64(), "start": pa.int64(), "n": pa.int64(), "doc_ids": pa.list_(pa.int64()), "offsets": pa.list_(pa.int64()), "starts": pa.list_(pa.int64()), "payload": pa.binary()}
    seg_schema, seg_spark = arrow(seg)

    def segments(batches):
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        ids, sizes, starts, held = [], [], [], []

        def row():
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            known = [i for i in ids if i is not None]
            row = [part, digest, min(known, default=None), max(known, default=None), starts[0], total - starts[0], [*ids], offsets, [*starts], b"".join(held)]
            for x in (ids, sizes, starts, held):
                x.clear()
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, seg_schema)], schema=seg_schema)

        for b in batches:
            for i, n, frame in zip(*(c.to_pylist() for c in b.columns)):
                if held and sum(sizes) + len(frame) > segment_bytes or len(held) >= 4096:
                    yield row()
                ids.append(i)
                sizes.append(len(frame))
                starts.append(total)
                held.append(frame)
                total += n
        if held:
            yield row()

    dealt = frames.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", "frame")
    # Payloads are compressed already.
    dealt.mapInArrow(segments, seg_spark).write.option("compression", "none").parquet(f"{folder}/segments")
    run.drop(frames)
    sizes = spark.read.parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per part, that is, per task of the sort.
    sizes.select("part", F.coalesce(before, F.lit(0)).alias("base")).coalesce(1).write.parquet(f"{folder}/parts")


def read(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) from the files; ids are little-endian unsigned 32-bit numbers.

    With ``doc_ids`` only segments that may hold them are read and only their frames
    decompressed. A segment written with another dictionary is an error.
    """
    ship(spark)
    table = spark.read.parquet(f"{folder}/dictionary").collect()[0]
    digest, data, width = table.hash, bytes(table.bytes), table.width
    segments = spark.read.parquet(f"{folder}/segments")
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        inside = [(F.col("first_doc") <= i) & (F.col("last_doc") >= i) for i in wanted]
        condition = F.lit(False)
        for c in inside:
            condition = condition | c
        segments = segments.filter(condition)
    parts = spark.read.parquet(f"{folder}/parts")
    schema, spark_schema = arrow({"doc_id": pa.int64(), "start": pa.int64(), "ids": pa.binary()})
    based = segments.join(parts, "part").select("dictionary_hash", "base", "doc_ids", "offsets", "starts", "payload")

    def run(batches):
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
        kind = np.uint16 if width == 2 else np.uint32
        for b in batches:
            for used, base, ids, offsets, starts, payload in zip(*(c.to_pylist() for c in b.columns)):
                if used != digest:
                    raise ValueError(f"segment of dictionary {used}, store has {digest}")
                keep = [k for k, i in enumerate(ids) if wanted is None or i in wanted]
                out = [np.frombuffer(reader.decompress(payload[offsets[k] : offsets[k + 1]]), kind).astype(np.uint32).tobytes() for k in keep]
                yield pa.record_batch([pa.array([ids[k] for k in keep], pa.int64()), pa.array([base + starts[k] for k in keep], pa.int64()), pa.array(out, pa.binary())], schema=schema)

    return based.mapInArrow(run, spark_schema)

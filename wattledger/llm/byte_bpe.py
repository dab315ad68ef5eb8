"""Byte-level BPE over a global table of distinct words, and its inverse.

Texts are cut in blocks. Each block sends every distinct pre-token once, with its number in the
block, to the task that owns the word; there each distinct word is encoded once for all blocks.
Blocks get back the ids by number and are put together by the positions they kept.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.llm.common import arrow, ship, slices, spread
from wattledger.llm.pieces import Cut, laid

PATTERN = public_tokenizers.PATTERN
#: Pieces that surely are one match of PATTERN: Latin letters behind a space or none.
LETTERS = "^ ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+$"


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoding_of(path: str) -> tiktoken.Encoding:
    """One encoding for all tasks of a worker."""
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})


class Block:
    """Distinct pre-tokens of texts and every text's sequence of their numbers."""

    def __init__(self):
        self.pattern = regex.compile(PATTERN)

    def cut(self, texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
        words, numbers, first = self.numbered(texts)
        return words.to_pylist(), [numbers[a:e] for a, e in zip(first, first[1:])]

    def numbered(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The pre-tokens, the sequences one after the other, and where each begins and the last ends."""
        cut = Cut(texts)
        pieces = cut.pieces.cast(pa.large_string())
        one = pc.match_substring_regex(pieces, LETTERS)
        # No match of the pattern reaches over the place where a piece begins.
        found = list(map(self.pattern.findall, pieces.filter(pc.invert(one)).to_pylist()))
        one = np.asarray(one)
        sizes = np.ones(len(pieces), np.int64)
        sizes[~one] = np.fromiter(map(len, found), np.int64, len(found))
        starts = np.cumsum(one) - one
        starts[~one] = one.sum() + np.cumsum(sizes[~one]) - sizes[~one]
        words = pa.concat_arrays([pieces.filter(pa.array(one)), pa.array(list(chain.from_iterable(found)), pa.large_string())]).dictionary_encode()
        counts = sizes[cut.codes]
        numbers = words.indices.to_numpy().astype(np.uint32)[spread(starts[cut.codes], counts)]
        return words.dictionary, numbers, np.concatenate([[0], np.cumsum(counts)])[cut.first]


def squeezed(data: bytes) -> bytes:
    """What goes through a shuffle: a zstandard frame."""
    return zstandard.ZstdCompressor(3).compress(data)


def expanded(data: bytes, kind: type = np.uint32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def packed(values: list[bytes]) -> tuple[bytes, bytes]:
    return squeezed(b"".join(values)), squeezed(np.fromiter(map(len, values), np.uint32, len(values)).tobytes())


def _blocks(docs: DataFrame, block_bytes: int, buckets: int | None) -> DataFrame:
    """With ``buckets``, rows of words (block, bucket, words, sizes, numbers) for each block;
    else its positions (block, rows' ids, sizes, compressed numbers)."""
    fields = {"block": pa.int64(), "bucket": pa.int32(), "data": pa.binary(), "sizes": pa.binary(), "numbers": pa.binary()}
    schema, spark_schema = arrow(fields)
    from pyspark import TaskContext

    def run(batches):
        block, state = TaskContext.get().partitionId() << 32, Block()
        for b in batches:
            for first, texts in slices(b, 2, block_bytes):
                words, numbers, places = state.numbered(texts)
                if buckets is None:
                    n = len(texts)
                    ids = np.stack([b.column(i).slice(first, n).to_numpy(zero_copy_only=False) for i in (0, 1)]).astype(np.int64)
                    sizes = np.diff(places).astype(np.uint32).tobytes()
                    rows = [(block, None, ids.tobytes(), sizes, squeezed(numbers.tobytes()))]
                else:
                    words = words.cast(pa.large_binary())
                    at = np.fromiter(map(xxhash.xxh32_intdigest, words.to_pylist()), np.int64, len(words)) % buckets
                    order = np.argsort(at, kind="stable")
                    raw, ends = laid(words.take(pa.array(order)))
                    lengths, number = np.diff(ends).astype(np.uint32), order.astype(np.uint32)
                    cuts = np.append(np.flatnonzero(np.diff(at[order], prepend=-1)), len(order)).tolist()
                    rows = [
                        (block, int(at[order[x]]), squeezed(raw[ends[x] : ends[y]]), squeezed(lengths[x:y].tobytes()), squeezed(np.diff(number[x:y], prepend=np.uint32(0)).tobytes()))
                        for x, y in zip(cuts, cuts[1:])]
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                block += 1

    return docs.mapInArrow(run, spark_schema)


def encode(documents: DataFrame, ranks_path: str, block_bytes: int = 4 << 20, decoded: bool = False) -> DataFrame:
    """(row, doc_id, ids) of every row; ids are little-endian unsigned 32-bit numbers. With
    ``decoded`` also ``bytes``, what ``decode`` makes of the ids, by the same task.

    Each match of the pattern is encoded by itself, without special tokens. Null and empty
    texts have no ids. ``row`` numbers the input's rows; a doc_id may be null or repeated.
    A task that owns words holds some of the distinct ones of its share: there are two shares for
    each partition of the input, 128 at least.
    """
    ship(documents.sparkSession)
    docs = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    docs = docs.select("row", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "t")
    buckets = max(128, 2 * documents.rdd.getNumPartitions())
    schema, spark_schema = arrow({"block": pa.int64(), "kind": pa.int32(), "data": pa.binary(), "sizes": pa.binary(), "numbers": pa.binary()})

    def words_to_ids(batches):
        encoding = encoding_of(ranks_path)
        known: dict[bytes, bytes] = {}
        for b in batches:
            out = [[] for _ in schema]
            for block, _, data, sizes, numbers in zip(*(c.to_pylist() for c in b.columns)):
                ends, data = np.cumsum(expanded(sizes)).tolist(), expanded(data, np.uint8).tobytes()
                ids = []
                for a, e in zip([0, *ends], ends):
                    word = data[a:e]
                    got = known.get(word)
                    if got is None:
                        if len(known) >= 200_000:
                            known.clear()
                        got = known[word] = np.array(encoding._encode_single_piece(word), np.uint32).tobytes()
                    ids.append(got)
                for column, value in zip(out, (block, 1, *packed(ids), numbers)):
                    column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    words = _blocks(docs, block_bytes, buckets).repartition(buckets, "bucket").mapInArrow(words_to_ids, spark_schema)
    places = _blocks(docs, block_bytes, None).select("block", F.lit(0).alias("kind"), "data", "sizes", "numbers")
    both = places.union(words).repartition("block").sortWithinPartitions("block", "kind")
    out_schema, out_spark = arrow({"row": pa.int64(), "doc_id": pa.int64(), "ids": pa.binary(), **({"bytes": pa.binary()} if decoded else {})})

    def assemble(head, parts):
        ids, sizes, data = head
        ids = np.frombuffer(ids, np.int64).reshape(2, -1)
        sequence = expanded(data).astype(np.int64)
        number = np.concatenate([np.cumsum(expanded(p[2]).astype(np.int64)) for p in parts]) if parts else np.empty(0, np.int64)
        length = np.concatenate([expanded(p[1]) for p in parts]).astype(np.int64) // 4 if parts else np.empty(0, np.int64)
        flat = np.concatenate([expanded(p[0]) for p in parts]) if parts else np.empty(0, np.uint32)
        starts, lengths = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
        starts[number], lengths[number] = np.cumsum(length) - length, length
        ends = np.cumsum(np.frombuffer(sizes, np.uint32)).astype(np.int64)
        texts = []
        for a, e in zip([0, *ends[:-1]], ends):
            x = sequence[a:e]
            texts.append(flat[spread(starts[x], lengths[x])].tobytes())
        doc = pa.array(ids[1], mask=ids[1] == -(1 << 63))
        back = [pa.array(_joined(texts, token_bytes(ranks_path)), pa.binary())] if decoded else []
        return pa.record_batch([pa.array(ids[0]), doc, pa.array(texts, pa.binary()), *back], schema=out_schema)

    def together(batches):
        head, parts, now = None, [], None
        for b in batches:
            for block, kind, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    if head is not None:
                        yield assemble(head, parts)
                    head, parts, now = rest, [], block
                else:
                    assert block == now
                    parts.append(rest)
        if head is not None:
            yield assemble(head, parts)

    return both.mapInArrow(together, out_spark)


@lru_cache(maxsize=2)
def token_bytes(ranks_path: str) -> list[bytes]:
    """Bytes of every id; ids that no token has are empty."""
    ranks = ranks_of(ranks_path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def _joined(ids: list[bytes | None], table: list[bytes]) -> list[bytes | None]:
    return [None if x is None else b"".join(map(table.__getitem__, np.frombuffer(x, np.uint32).tolist())) for x in ids]


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of ``encoded`` and ``bytes``: every id's bytes, in order, from the table of
    the vocabulary's tokens (of fixed size, read once by each worker)."""
    ship(encoded.sparkSession)
    names = [c for c in encoded.columns if c != "bytes"]
    df = encoded.select(*[c for c in names if c != "ids"], "ids")
    schema = T.StructType([*df.schema.fields, T.StructField("bytes", T.BinaryType())])

    def run(batches):
        table = token_bytes(ranks_path)
        for b in batches:
            out = _joined(b.column(b.num_columns - 1).to_pylist(), table)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "bytes"])

    return df.mapInArrow(run, schema)

"""What the operators share: run folders, text batches, word hashes, a fixed-size filter."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.session import scratch_path

#: Upper to lower case for A-Z only, anything but 0-9, a-z and non-ASCII bytes to a space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def ship(spark: SparkSession) -> None:
    """Lets Python workers find this package where nobody has installed it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


class Run:
    """Tables of one call of an operator, in one folder below the shared one.

    Stored tables cut the lineage and survive the loss of executors. ``drop`` removes those
    that nothing reads any more; what a result still reads stays until the caller expires
    ``folder``.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.folder = scratch_path(spark, name)
        self._count = 0

    def store(self, df: DataFrame, name: str, codec: str = "lz4", **options) -> DataFrame:
        self._count += 1
        path = f"{self.folder}/{self._count:03d}-{name}"
        df.write.options(compression=codec, **options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def numbered(df: DataFrame, order: list, run: Run, name: str) -> DataFrame:
    """``df`` stored in ranges of ``order`` with ``at``, the rows' numbers from 0 on in that order.

    Numbers come from places in stored partitions and the sizes of those before; only one row
    per partition is summed up in one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = run.store(ranged.withColumn("__id", F.monotonically_increasing_id()), name)
    part = F.shiftright("__id", 33)
    sizes = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    inside = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn("__part", part).join(starts, "__part").withColumn("at", F.col("__start") + inside).select(*df.columns, "at")


def utf8(column: str = "text") -> Column:
    """The text's bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[tuple[int, list]]:
    """First row and values of consecutive pieces of a binary column, about ``most`` bytes each."""
    values = batch.column(column)
    sizes = np.diff(np.frombuffer(values.buffers()[1], np.int32)[values.offset :][: len(values) + 1])
    group = np.cumsum(sizes, dtype=np.int64) // most
    bounds = [0, *(np.flatnonzero(np.diff(group)) + 1), len(values)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield int(a), values.slice(a, b - a).to_pylist()


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of the runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.empty(0, np.int64)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])


class Hashes(dict):
    """64-bit hash of each word, kept while there is room."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[i : i + n]
    return mixed(out)


def selected(h: np.ndarray, w: int) -> np.ndarray:
    """Ascending places of the smallest of every ``w`` consecutive values, the last among equals."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = h[:n].copy(), np.arange(n)
    for i in range(1, w):
        here = h[i : i + n]
        smaller = here <= best
        np.copyto(best, here, where=smaller)
        np.copyto(at, np.arange(i, i + n), where=smaller)
    return at[np.flatnonzero(np.diff(at, prepend=-1))]


class Bloom:
    """A set of 64-bit hashes in a fixed number of bits: no false negatives.

    What is broadcast has this size whatever the set's; a fuller filter only lets more rows
    through to the exact join behind it.
    """

    PROBES = 3

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def of(df: DataFrame, column: str, log2_bits: int = 24) -> "Bloom":
        """Filter of a long column; the driver gets 2^(log2_bits - 6) numbers at most."""
        mask = (1 << log2_bits) - 1
        probes = F.array(*[
            F.shiftrightunsigned(F.col(column), 20 * i).bitwiseAND(F.lit(mask)) for i in range(Bloom.PROBES)
        ])
        bits = df.filter(F.col(column).isNotNull()).select(F.explode(probes).alias("b"))
        packed = bits.groupBy(F.shiftrightunsigned("b", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")
        )
        got = packed.toArrow()
        words = np.zeros(1 << (log2_bits - 6), np.uint64)
        words[got["w"].to_numpy()] = got["v"].to_numpy().view(np.uint64)
        return Bloom(words)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h.view(np.uint64)
        mask = np.uint64(len(self.words) * 64 - 1)
        found = np.ones(len(h), bool)
        for i in range(self.PROBES):
            b = (h >> np.uint64(20 * i)) & mask
            found &= (self.words[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def arrow(fields: dict[str, pa.DataType]) -> tuple[pa.Schema, T.StructType]:
    from pyspark.sql.pandas.types import from_arrow_schema

    schema = pa.schema(list(fields.items()))
    return schema, from_arrow_schema(schema)

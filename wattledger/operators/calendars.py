"""Sets of dates as bitmaps: one 64-bit word for each 64 days that a feed has.

A feed is reduced to its words by a map-side combined ``bit_or``, so what is shuffled is a few
words per task, however many rows a day has; several feeds meet in one aggregate, and sets are
united and intersected on bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(date: str) -> Column:
    return F.unix_date(F.to_date(date)).cast("long")


def words(sources: dict[str, DataFrame], date: str = "date") -> DataFrame:
    """(w, <one column per source>): the days of word ``w`` (day number >> 6) that each source
    has, as bits; null dates are bit 0 of the word null."""
    bit = F.expr("shiftleft(1L, cast(day & 63 as int))")
    tagged = [
        df.select(_day(date).alias("day")).select(
            F.shiftright("day", 6).alias("w"),
            *[(F.coalesce(bit, F.lit(1)) if n == name else F.lit(None)).cast("long").alias(n) for n in sources],
        )
        for name, df in sources.items()
    ]
    rows = reduce(DataFrame.union, tagged)
    return rows.groupBy("w").agg(*[F.coalesce(F.bit_or(n), F.lit(0)).alias(n) for n in sources])


def days(found: DataFrame, bits: Column, *kept: Column) -> DataFrame:
    """(date, ``kept``) of every bit set in ``bits``; ``kept`` may name the bit's number ``k``."""
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.getbit(F.col("_bits"), k) == 1)
    each = found.withColumn("_bits", bits).withColumn("k", F.explode(places))
    day = F.date_from_unix_date((F.col("w") * 64 + F.col("k")).cast("int"))
    return each.select(day.alias("date"), *kept)


def intersection(*frames: DataFrame, date: str = "date") -> DataFrame:
    """Dates that all frames have."""
    names = [f"s{i}" for i in range(len(frames))]
    both = reduce(lambda a, b: a.bitwiseAND(b), [F.col(n) for n in names])
    return days(words(dict(zip(names, frames)), date), both)


def union(*frames: DataFrame, date: str = "date") -> DataFrame:
    """Dates that any frame has."""
    names = [f"s{i}" for i in range(len(frames))]
    either = reduce(lambda a, b: a.bitwiseOR(b), [F.col(n) for n in names])
    return days(words(dict(zip(names, frames)), date), either)


def flags(sources: dict[str, DataFrame], date: str = "date") -> DataFrame:
    """One row per date of any source with a 0/1 flag for each; null dates are left out."""
    found = words(sources, date).filter(F.col("w").isNotNull())
    either = reduce(lambda a, b: a.bitwiseOR(b), [F.col(n) for n in sources])
    return days(found, either, *[F.getbit(F.col(n), F.col("k")).cast("int").alias(n) for n in sources])

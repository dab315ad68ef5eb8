"""Tables kept in buckets of their date, so that joins and groups on the date move no rows.

A bucket is read by one task, which a date with a large part of all rows must not decide. So a
table has two parts: ``cool`` lies in date buckets, ``hot`` holds the rows of dates with more
than ``most`` rows in one batch, and those without date, in ordinary files. Which part a row is in
means nothing; the table is their union, and ``joins.left_join_parts`` reads it that way. Batches
are published as in ``commits``: whole or not at all, and once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattledger.settings import DATE_BUCKETS
from wattledger.sources import commits


@dataclass(frozen=True)
class ByDate:
    """The two parts of a table, with the same columns."""

    cool: DataFrame
    hot: DataFrame

    def rows(self) -> DataFrame:
        return self.cool.unionByName(self.hot)


def _settings(on: str, buckets: int) -> str:
    return json.dumps({"on": on, "buckets": buckets}, sort_keys=True)


def _moves(spark: SparkSession, staged: str, place: str, batch: str) -> list[dict]:
    parts = [n for n in commits.names(spark, staged) if n.startswith("part-")]
    return [{"source": f"{staged}/{n}", "place": f"{place}/{batch}-{n}"} for n in parts]


def append(
    df: DataFrame, folder: str, batch: str, buckets: int = DATE_BUCKETS, most: int | None = None, on: str = "date"
) -> None:
    """Add ``df`` as ``batch``; a batch that was published before is left as it is.

    Without ``most`` every row goes to its bucket, which suits tables of few rows a day. With it
    ``df`` is read three times (counts, cool, hot), so hand in a stored table. One file is written
    per bucket and batch. All batches of a table share ``on`` and ``buckets``.
    """
    spark, root = df.sparkSession, folder.rstrip("/")
    commits.recover(spark, root)
    if commits.record_of(spark, root, batch) is not None:
        return
    known = {r["settings"] for r in commits.batches(spark, root).select("settings").distinct().collect()}
    if known - {_settings(on, buckets)}:
        raise ValueError(f"{folder} is kept by {known.pop()}")
    cool, staged, moves = df, f"{root}/{commits.STAGING}/{batch}", []
    if most is not None:
        crowded = df.groupBy(on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select(on)
        dated = df.filter(F.col(on).isNotNull())
        cool = dated.join(crowded, on, "left_anti").select(*df.columns)
        hot = dated.join(crowded, on, "left_semi").select(*df.columns).union(df.filter(F.col(on).isNull()))
        hot.write.mode("overwrite").parquet(f"{staged}/hot")
        moves += _moves(spark, f"{staged}/hot", f"{root}/hot", batch)
    name = f"by_date_{uuid.uuid4().hex}"
    writer = cool.repartition(buckets, on).write.bucketBy(buckets, on).sortBy(on).format("parquet")
    writer.mode("overwrite").option("path", f"{staged}/cool").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files are the table; the name was needed to write them
    moves += _moves(spark, f"{staged}/cool", f"{root}/cool", batch)
    commits.publish(spark, root, batch, moves, settings=_settings(on, buckets))


def replace(df: DataFrame, folder: str, **layout) -> None:
    """``df`` as the only batch of the table; ``layout`` as for :func:`append`."""
    path, fs = commits.located(df.sparkSession, folder)
    fs.delete(path, True)
    append(df, folder, "whole", **layout)


def read(spark: SparkSession, folder: str, schema: StructType) -> ByDate:
    """Both parts with the columns of ``schema``; decided batches are finished first."""
    root = folder.rstrip("/")
    commits.recover(spark, root)
    found = commits.batches(spark, root).select("settings").first()
    empty = spark.createDataFrame([], schema)
    if found is None:
        return ByDate(empty, empty)
    layout = json.loads(found["settings"])
    cool = empty
    if commits.data_files(spark, f"{root}/cool"):
        name = f"by_date_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        place = f"{root}/cool".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout['on']}`) "
            f"INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
        )
        cool = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: the frame keeps reading its files
    there = commits.data_files(spark, f"{root}/hot")
    hot = spark.read.schema(schema).parquet(f"{root}/hot") if there else empty
    return ByDate(cool, hot)

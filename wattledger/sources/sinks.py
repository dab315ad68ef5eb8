"""Sinks: dated landing, training export, tables, result files and JSON summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.operators import filters


def land_raw(df: DataFrame, path: str, run_date, fmt: str = "parquet") -> None:
    """Write one feed under its run date; a repeated run replaces only that date."""
    dated = df.withColumn("run_date", F.lit(str(run_date)))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.partitionBy("run_date").format(fmt).save(path)


EXPORT_REQUIRED = [
    "total_generation_mwh",
    "avg_temperature_f",
    "oil_price_usd",
    "liquidity_need_millions",
]


def training_rows(features: DataFrame, n: int | None = None, keep_date: bool = False):
    """All complete feature days (the newest ``n``, if given), in the training column order.

    ``keep_date`` also keeps the date, which is what gives later fills their order.
    """
    columns = [*schemas.FEATURES, schemas.TARGET]
    complete = filters.require(features, EXPORT_REQUIRED)
    if n is not None:
        complete = complete.orderBy(F.col("date").desc()).limit(n)
    return complete.select(*(["date"] if keep_date else []), *columns)


def export_training(features: DataFrame, path: str, n: int | None = None) -> None:
    training_rows(features, n, keep_date=True).write.mode("overwrite").csv(path, header=True)


def create_or_replace(df: DataFrame, table: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(table)


def save_results(frames: dict[str, DataFrame], folder: str) -> list[str]:
    """CSV folder per non-empty frame; returns the names written."""
    written = []
    for name, df in frames.items():
        if not df.isEmpty():
            df.write.mode("overwrite").csv(f"{folder.rstrip('/')}/{name}", header=True)
            written.append(name)
    return written


def write_summary(df: DataFrame, path: str) -> None:
    """One-row summary as JSON."""
    df.write.mode("overwrite").json(path)


def create_tables(spark: SparkSession, location: str, prefix: str = "") -> list[str]:
    """Create the eight typed tables, empty, below ``location``."""
    names = []
    for table, schema in schemas.TABLES.items():
        spark.catalog.createTable(
            prefix + table,
            path=f"{location.rstrip('/')}/{table}",
            source="parquet",
            schema=schema,
        )
        names.append(prefix + table)
    return names


def write_clustered(df: DataFrame, path: str) -> None:
    """Date-clustered parquet, so that date filters skip files and row groups.

    Rows are ranged by date and then by a hash of the row, so a date that holds a large part
    of the table is spread over many files instead of ending in one.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    ranged = df.repartitionByRange(F.col("date"), spread)
    ranged.sortWithinPartitions("date").write.mode("overwrite").parquet(path)

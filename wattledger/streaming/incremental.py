"""Load each landed file once: file-source streams run to completion, one publication a batch.

A batch gives two outputs in one pass, the table's rows and, where wanted, what was rejected, and
both are published by one record (``sources.commits``): a repeated batch finds its record and adds
nothing, a batch that died before it is written anew.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.operators import filters
from wattledger.sources import commits, files, payloads

#: Columns of every table of rejected input: the file, why, and the record (null for a file).
REJECTED = "source_file string, error string, record string"

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

Split = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def _stream(spark: SparkSession, pattern: str, max_files, clean, archive):
    # Run dates are folders below the landing path; the pattern picks the files.
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean:
        reader = reader.option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader


def csv_stream(
    spark: SparkSession, landing: str, table: str,
    max_files: int | None = None, clean: str | None = None, archive: str | None = None,
) -> DataFrame:
    """Text records of CSV files not read before, with their file.

    ``clean`` ("delete", or "archive" into ``archive``) hands consumed files to the source's
    ``cleanSource``; by default files stay.
    """
    reader = _stream(spark, "*.csv", max_files, clean, archive)
    reader = reader.options(**files.CSV_OPTIONS, columnNameOfCorruptRecord=files._BAD)
    raw = reader.schema(files.as_text(files.load_schema(table))).csv(landing)
    return raw.withColumn("source_file", F.col("_metadata.file_path"))


def split_csv(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Typed good records in the table's shape, and the others as JSON texts."""
    schema = files.load_schema(table)
    bad = raw.filter(files.bad_record(schema)).select(
        "source_file", F.lit("Record does not fit the table").alias("error"),
        F.to_json(F.struct(*schema.names)).alias("record"),
    )
    return files.with_defaults(files.good_rows(raw, schema), table), bad


def json_stream(
    spark: SparkSession, landing: str, table: str,
    max_files: int | None = None, clean: str | None = None, archive: str | None = None,
) -> DataFrame:
    """Responses of JSON files not read before, one a file, with their file."""
    reader = _stream(spark, "*.json", max_files, clean, archive)
    raw = payloads.response_options(reader).schema(payloads.FEEDS[table].landed).json(landing)
    return raw.withColumn("source_file", F.col("_metadata.file_path"))


def split_json(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the valid responses in the table's shape; invalid responses and the records that
    give no row, each with its reason."""
    feed = payloads.FEEDS[table]
    error = feed.error()
    valid = raw.filter(error.isNull())
    required = [f.name for f in schemas.TABLES[table].fields if not f.nullable]
    rows = filters.require(feed.parse(valid), required)
    bad = raw.filter(error.isNotNull()).select(
        "source_file", error.alias("error"), F.lit(None).cast("string").alias("record"))
    return files.with_defaults(rows, table), bad.union(feed.rejected(valid))


@contextmanager
def _listed_by_few_tasks(spark: SparkSession):
    """Each batch looks up its files, by default with a task for each (up to 10,000)."""
    tasks = str(4 * spark.sparkContext.defaultParallelism)
    before = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, tasks)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(LISTING_TASKS)
        else:
            spark.conf.set(LISTING_TASKS, before)


def _load(stream: DataFrame, split: Split, target: str, rejected: str | None, checkpoint: str) -> int:
    spark = stream.sparkSession
    name = checkpoint.rstrip("/").rpartition("/")[2]
    rows: list[int] = []

    def add(batch: DataFrame, number: int) -> None:
        # A checkpoint that was thrown away starts again from batch 0 with an id of its own.
        own = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        key = f"{name}-{own[:8]}-{number:06d}"
        record = commits.record_of(spark, target, key)
        if record is not None:
            commits.finish(spark, target, record)
            rows.append(record["rows"])
            return
        if rejected is not None:  # two outputs of one read
            batch.persist()
        try:
            good, bad = split(batch)
            seen, refused = Observation(), Observation()
            moves = commits.stage(good.observe(seen, F.count(F.lit(1)).alias("n")), target, key)
            counts = {"rows": seen.get["n"]}
            if rejected is not None:
                watched = bad.observe(refused, F.count(F.lit(1)).alias("n"))
                moves = commits.stage(watched, rejected, key) + moves
                counts["rejected"] = refused.get["n"]
            commits.publish(spark, target, key, moves, **counts)
        finally:
            if rejected is not None:
                batch.unpersist()
        rows.append(counts["rows"])

    with _listed_by_few_tasks(spark):
        query = (
            stream.writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return sum(rows)


def load_new_files(
    spark: SparkSession, landing: str, table: str, target: str, checkpoint: str,
    max_files: int | None = None, clean: str | None = None, archive: str | None = None,
    rejected: str | None = None,
) -> int:
    """Append all CSV files landed since the last run to the parquet folder ``target``.

    The checkpoint records which files were read, so a second run adds nothing, and a run
    that died half way continues. Bad records go to ``rejected``, where it is given, under the
    same record as the rows. Returns the rows of the batches published.
    """
    commits.recover(spark, target)
    stream = csv_stream(spark, landing, table, max_files, clean, archive)
    return _load(stream, lambda raw: split_csv(raw, table), target, rejected, checkpoint)


def load_new_responses(
    spark: SparkSession, landing: str, table: str, target: str, checkpoint: str,
    max_files: int | None = None, clean: str | None = None, archive: str | None = None,
    rejected: str | None = None,
) -> int:
    """The same for landed JSON responses, one a file (not for prices, which have none)."""
    commits.recover(spark, target)
    stream = json_stream(spark, landing, table, max_files, clean, archive)
    return _load(stream, lambda raw: split_json(raw, table), target, rejected, checkpoint)

"""Publication of a load's files: staged, decided by one record, then moved into the table.

A batch is written below ``_staging`` of its table, which readers do not see. One record in
``_commits`` decides it: it names every staged file, its place in the table and what the batch
counted. The moves that follow can be repeated, so a run that died before the record leaves
nothing visible and one that died behind it is finished by the next. Published files lie beside
those of other writers, with the table's own columns, so every reader of the folder sees both.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STAGING, RECORDS = "_staging", "_commits"
RECORD_SCHEMA = (
    "batch string, rows long, rejected long, covers array<string>, settings string, "
    "moves array<struct<source: string, place: string>>"
)


def located(spark: SparkSession, path: str):
    """``path`` and its file system, as Hadoop has them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``; none where it does not exist."""
    path, fs = located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def data_files(spark: SparkSession, table: str) -> list[str]:
    """Names of the data files that readers of the folder ``table`` see."""
    return [n for n in names(spark, table) if not n.startswith(("_", "."))]


def _record_path(table: str, batch: str) -> str:
    return f"{table.rstrip('/')}/{RECORDS}/{batch}.json"


def record_of(spark: SparkSession, table: str, batch: str) -> dict | None:
    """The record of ``batch``, or None where it was never decided."""
    path, fs = located(spark, _record_path(table, batch))
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def stage(df: DataFrame, table: str, batch: str) -> list[dict]:
    """Write ``df`` for ``batch`` out of sight; returns the moves that would publish it."""
    root, spark = table.rstrip("/"), df.sparkSession
    folder = f"{root}/{STAGING}/{batch}"
    df.write.mode("overwrite").parquet(folder)
    parts = [n for n in names(spark, folder) if n.startswith("part-")]
    return [{"source": f"{folder}/{n}", "place": f"{root}/{batch}-{n}"} for n in parts]


def decide(
    spark: SparkSession, table: str, batch: str, moves: list[dict], covers=(), **facts
) -> dict:
    """Write the record of ``batch``: from here on it belongs to the table."""
    record = {"batch": batch, **facts, "covers": list(covers), "moves": moves}
    path, fs = located(spark, _record_path(table, batch))
    draft, _ = located(spark, f"{table.rstrip('/')}/{RECORDS}/.{batch}-{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    if fs.exists(path) or not fs.rename(draft, path):
        fs.delete(draft, False)
        raise FileExistsError(f"batch {batch} has a record in {table}")
    return record


def finish(spark: SparkSession, table: str, record: dict) -> None:
    """Move what the record names; moves that were made already are left as they are."""
    folders = {f"{table.rstrip('/')}/{STAGING}/{record['batch']}"}
    for move in record["moves"]:
        source, fs = located(spark, move["source"])
        place, _ = located(spark, move["place"])
        if fs.exists(source):
            fs.mkdirs(place.getParent())
            if not fs.rename(source, place):
                raise OSError(f"cannot move {move['source']} to {move['place']}")
        elif not fs.exists(place):
            raise FileNotFoundError(f"batch {record['batch']} lacks {move['source']}")
        folders.add(move["source"].rpartition("/")[0])
    # The table's own folder goes last: while it stands, recover() comes here again.
    for folder in sorted(folders, key=lambda f: f.startswith(f"{table.rstrip('/')}/")):
        path, fs = located(spark, folder)
        fs.delete(path, True)


def publish(spark: SparkSession, table: str, batch: str, moves: list[dict], covers=(), **facts):
    record = decide(spark, table, batch, moves, covers, **facts)
    finish(spark, table, record)
    return record


def recover(spark: SparkSession, table: str) -> list[str]:
    """Finish decided batches whose files were not all moved; returns their names. What was
    staged without a record stays out of sight until its batch is repeated."""
    done = []
    for batch in names(spark, f"{table.rstrip('/')}/{STAGING}"):
        record = record_of(spark, table, batch)
        if record is not None:
            finish(spark, table, record)
            done.append(batch)
    return done


def batches(spark: SparkSession, table: str) -> DataFrame:
    """(batch, rows, rejected, covers, settings, moves) of every decided batch."""
    folder = f"{table.rstrip('/')}/{RECORDS}"
    found = [n for n in names(spark, folder) if n.endswith(".json")]
    if not found:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).json([f"{folder}/{n}" for n in found])


def read(spark: SparkSession, table: str, schema: StructType, files=None) -> DataFrame:
    """The table's declared columns, of all its files or of ``files`` (names) only; empty where
    nothing was written yet. Decided batches are finished first."""
    recover(spark, table)
    found = data_files(spark, table) if files is None else list(files)
    if not found:
        return spark.createDataFrame([], schema)
    paths = [table] if files is None else [f"{table.rstrip('/')}/{n}" for n in found]
    return spark.read.schema(schema).parquet(*paths).select(*[F.col(n) for n in schema.names])

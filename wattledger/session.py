"""Session building and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT = "spark.checkpoint.dir"


def build_session(app: str = "wattledger", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC dates and adaptive execution; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # A table kept in date buckets is not dealt anew for a join on the date and more.
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        # Call-site capture per column expression; costs driver time on wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or, where that is unset, a
    folder of the warehouse, whatever the master."""
    folder = spark.conf.get(_CHECKPOINT, None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage where a result is read several times; the files survive the loss of
    executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

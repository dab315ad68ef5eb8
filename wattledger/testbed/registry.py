"""Query registration: a Spark builder per key and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.testbed.standins import CTES, Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Nine decimals first: engines sum in different orders, and the last bits must not decide
# on which side of a tie a value falls.
EXACT = "decimal(38,9)"
DIGITS = 4


def rounded(df: DataFrame) -> DataFrame:
    """Doubles cut to comparable digits (the SQL text does the same with ``R``)."""
    return df.select(
        *[
            F.round(F.col(c.name).try_cast(EXACT), DIGITS).cast("double").alias(c.name)
            if c.dataType.typeName() == "double"
            else c.name
            for c in df.schema.fields
        ]
    )


def R(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS {EXACT}), {DIGITS}) AS DOUBLE)"


def query(key: str, sql: str | None = None):
    """Register a builder ``Tables → DataFrame``; ``sql`` may name any stand-in table."""

    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(build(Tables(spark, folder)))

        run.__name__ = key
        assert key not in QUERIES, key
        QUERIES[key] = run
        if sql is not None:
            names = [n for n in CTES if re.search(rf"\b{n}\b", sql)]
            text = with_tables(sql, *names)
            # A body with its own WITH continues the list of table expressions.
            ORACLES[key] = text.replace(")\nWITH ", "),\n", 1)
        return build

    return add

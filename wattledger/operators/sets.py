"""Set operations, ordered reads and top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.scalars import as_date
from wattledger.operators import calendars, filters


def current_status(features: DataFrame, predictions: DataFrame, as_of) -> DataFrame:
    """Latest data, data volume and prediction coverage as three rows."""
    day = as_date(as_of)
    latest = features.agg(F.max("date").alias("latest_date")).select(
        F.lit("Latest Data").alias("metric_category"),
        "latest_date",
        F.lit(None).cast("long").alias("metric_value"),
        F.datediff(day, F.col("latest_date")).alias("days_behind"),
    )

    def volume(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("metric_value")).select(
            F.lit(label).alias("metric_category"),
            F.lit(None).cast("date").alias("latest_date"),
            "metric_value",
            F.lit(None).cast("int").alias("days_behind"),
        )

    return (
        latest.unionByName(volume(filters.look_back(features, as_of, 30), "Data Volume"))
        .unionByName(volume(filters.look_back(predictions, as_of, 7), "Prediction Coverage"))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, record_count), one row per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("record_count")).select(
                F.lit(name).alias("table_name"), "record_count"
            )
            for name, df in tables.items()
        ],
    )


def concat(frames: list[DataFrame], like: DataFrame | None = None) -> DataFrame | None:
    """Rows of all frames; ``like`` (emptied) when there are none."""
    if not frames:
        return None if like is None else like.limit(0)
    return reduce(DataFrame.unionByName, frames)


def date_intersection(*frames: DataFrame) -> DataFrame:
    """Dates in all frames; each feed is reduced to a bitmap of its days before they meet."""
    return calendars.intersection(*frames)


def date_union(*frames: DataFrame) -> DataFrame:
    """Dates in any frame."""
    return calendars.union(*frames)


def newest_first(df: DataFrame, *then: str) -> DataFrame:
    return df.orderBy(F.col("date").desc(), *then)


def next_prediction(predictions: DataFrame, as_of) -> DataFrame:
    """The nearest prediction dated ``as_of`` or later, lowest version on a tie."""
    return (
        filters.from_date(predictions, as_of)
        .orderBy("date", "model_version")
        .select(
            F.col("date").alias("prediction_date"),
            "predicted_liquidity_millions",
            "model_version",
        )
        .limit(1)
    )


def newest_rows(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.col("date").desc()).limit(n)


def last_dates(df: DataFrame, n: int = 14) -> DataFrame:
    return df.select("date").distinct().orderBy(F.col("date").desc()).limit(n)


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_labels(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """Rows of the first ``n`` labels by name (the label set has exactly n rows)."""
    labels = df.select(column).distinct().orderBy(column).limit(n)
    return df.join(labels, column, "left_semi")

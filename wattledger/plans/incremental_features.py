"""The feature table kept up by files: only new raw files and touched months are worked on.

Every feed has a table of mergeable partial states, one row per date and group of files (sums,
counts, smallest values). Files that no state covers yet are reduced to new states; the months
of their dates are then built from states alone and replace their partitions of the features.
States and features are published with records of what they cover, so a run that died anywhere
is continued, and a repeated run does nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.plans import features as feats
from wattledger.settings import INDICATOR_COLUMNS
from wattledger.sources import commits


@dataclass(frozen=True)
class Feed:
    """Partial states of a feed: how rows give them, how they merge, what a merged one means."""

    partial: dict[str, Callable[[], Column]]
    merge: Callable[[str], Column]
    daily: dict[str, Callable[[], Column]]

    def states(self, rows: DataFrame) -> DataFrame:
        dated = rows.filter(F.col("date").isNotNull())
        return dated.groupBy("date").agg(*[c().alias(n) for n, c in self.partial.items()])

    def merged(self, states: DataFrame) -> DataFrame:
        whole = states.groupBy("date").agg(*[self.merge(n).alias(n) for n in self.partial])
        return whole.select("date", *[c().alias(n) for n, c in self.daily.items()])


def _mean(total: str, n: str, decimal: str | None = None) -> Column:
    """Mean of a sum and a count; of decimals with the digits that an average of them has."""
    if decimal is None:
        return F.try_divide(F.col(total).cast("double"), F.col(n))
    return F.try_divide(F.col(total), F.col(n).cast("decimal(20,0)")).cast(decimal).cast("double")


def _smallest(indicator: str) -> Callable[[], Column]:
    return lambda: F.min(F.when(F.col("indicator") == indicator, F.col("value")))


FEEDS: dict[str, Feed] = {
    "raw_eia_data": Feed(
        {"total": lambda: F.sum("generation_mwh").cast("decimal(38,2)")},
        F.sum,
        {"total_generation_mwh": lambda: F.coalesce(F.col("total").cast("double"), F.lit(0.0))},
    ),
    "raw_weather_data": Feed(
        {"total": lambda: F.sum("temperature_f"), "n": lambda: F.count("temperature_f")},
        F.sum,
        {"avg_temperature_f": lambda: _mean("total", "n")},
    ),
    "raw_economic_data": Feed(
        {v: _smallest(k) for k, v in INDICATOR_COLUMNS.items()},
        F.min,
        {v: (lambda v=v: F.col(v).cast("double")) for v in INDICATOR_COLUMNS.values()},
    ),
    "raw_price_data": Feed(
        {"total": lambda: F.sum("price_per_mwh").cast("decimal(38,2)"), "n": lambda: F.count("price_per_mwh")},
        F.sum,
        {"avg_electricity_price": lambda: _mean("total", "n", "decimal(14,6)")},
    ),
}


def _folder(store: str, name: str) -> str:
    return f"{store.rstrip('/')}/_states/{name}"


def _covered(spark: SparkSession, folder: str) -> set[str]:
    return {c for r in commits.batches(spark, folder).select("covers").collect() for c in r["covers"]}


def _state_schema(spark: SparkSession, name: str):
    return FEEDS[name].states(spark.createDataFrame([], schemas.TABLES[name])).schema


def update_states(spark: SparkSession, store: str, name: str) -> list[str]:
    """Reduce the files that no state of the feed covers; returns their names.

    Where a covered file is gone (the table was replaced), the states are built anew from all.
    """
    folder, table = _folder(store, name), f"{store.rstrip('/')}/{name}"
    commits.recover(spark, table)
    commits.recover(spark, folder)
    there, covered = set(commits.data_files(spark, table)), _covered(spark, folder)
    if covered - there:
        for gone in (folder, _folder(store, "ml_features")):
            path, fs = commits.located(spark, gone)
            fs.delete(path, True)
        covered = set()
    new = sorted(there - covered)
    if new:
        rows = commits.read(spark, table, schemas.TABLES[name], new)
        batch = f"states-{uuid.uuid4().hex[:12]}"
        moves = commits.stage(FEEDS[name].states(rows), folder, batch)
        commits.publish(spark, folder, batch, moves, covers=new)
    return new


def _states(spark: SparkSession, store: str, name: str, files=None) -> DataFrame:
    return commits.read(spark, _folder(store, name), _state_schema(spark, name), files)


def _month() -> Column:
    return F.trunc("date", "month").alias("month")


def refresh(spark: SparkSession, store: str, **weights) -> list:
    """Bring ``ml_features`` up to date; returns the months (first days) that were replaced.

    ``weights`` as for ``features.ml_features``; with other ones than before every month is built
    again, from states. The list of months is bounded by the calendar.
    """
    target, folder = f"{store.rstrip('/')}/ml_features", _folder(store, "ml_features")
    for name in FEEDS:
        update_states(spark, store, name)
    settings = json.dumps({k: str(v) for k, v in weights.items()}, sort_keys=True)
    known = commits.batches(spark, folder).select("covers", "settings").collect()
    whole = not known or any(r["settings"] != settings for r in known)
    applied = set() if whole else {c for r in known for c in r["covers"]}
    fresh = {n: [f for f in commits.data_files(spark, _folder(store, n)) if f"{n}/{f}" not in applied] for n in FEEDS}
    if not any(fresh.values()) and not whole:
        return []
    if whole:
        months = None
    else:
        touched = None
        for name, files in fresh.items():
            dates = _states(spark, store, name, files).select("date")
            touched = dates if touched is None else touched.union(dates)
        months = sorted(r["month"] for r in touched.select(_month()).distinct().collect())
    parts = []
    for name, feed in FEEDS.items():
        states = _states(spark, store, name)
        if months:
            # The range reaches the scan; the list keeps what lies between two touched months out.
            end = F.last_day(F.lit(months[-1]))
            states = states.filter(F.col("date").between(F.lit(months[0]), end) & F.trunc("date", "month").isin(months))
        parts.append(feed.merged(states))
    built = schemas.select_typed(feats.assembled(*parts, **weights), "ml_features")
    writer = built.withColumn("month", F.trunc("date", "month")).repartition("month").sortWithinPartitions("date")
    mode = "static" if whole else "dynamic"
    writer.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("month").parquet(target)
    if whole:  # earlier records speak of other settings
        path, fs = commits.located(spark, folder)
        fs.delete(path, True)
    covers = [f"{n}/{f}" for n in FEEDS for f in commits.data_files(spark, _folder(store, n))]
    commits.publish(spark, folder, f"features-{uuid.uuid4().hex[:12]}", [], covers=covers, settings=settings)
    if months is None:
        folders = [n.partition("=") for n in commits.names(spark, target)]
        months = [dt.date.fromisoformat(m) for name, _, m in folders if name == "month"]
    return months

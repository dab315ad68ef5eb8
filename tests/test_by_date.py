"""Tables in date buckets: joins without a shuffle, hot dates apart, batches once."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattledger.operators import joins
from wattledger.plans import views
from wattledger.sources import by_date, commits

from .conftest import rows

DAY = dt.date(2024, 1, 1)


def days(spark, n):
    return spark.range(n).select(
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("load"))


def feed(spark, n, seed):
    """Rows of which a third lie on one date, some have none, and some lie outside the days."""
    r = random.Random(seed)
    made = [(DAY if i % 3 == 0 else None if i % 50 == 1 else DAY + dt.timedelta(r.randrange(1, 60)), i) for i in range(n)]
    return spark.createDataFrame(made, "date date, obs int")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_are_the_table(spark, folder):
    first, second = feed(spark, 900, 1), feed(spark, 300, 2)
    for batch, df in (("a", first), ("b", second), ("a", second)):  # a repeated batch adds nothing
        by_date.append(df, f"{folder}/t", batch, 4, most=50)
    kept = by_date.read(spark, f"{folder}/t", first.schema)
    assert rows(kept.rows()) == rows(first.union(second))
    assert rows(kept.hot.select("date").distinct()) == [(None,), (DAY,)]
    assert kept.cool.filter(F.col("date").isNull() | (F.col("date") == DAY)).count() == 0
    # One file per bucket and batch at most, nothing left over from staging.
    assert len(commits.data_files(spark, f"{folder}/t/cool")) <= 8
    assert commits.names(spark, f"{folder}/t/_staging") == []
    with pytest.raises(ValueError):
        by_date.append(first, f"{folder}/t", "c", 8, most=50)


def test_left_join_of_parts(spark, folder, no_broadcast):
    daily, rest = days(spark, 40), feed(spark, 900, 3)
    by_date.append(daily, f"{folder}/days", "all", 4)
    by_date.append(rest, f"{folder}/feed", "all", 4, most=50)
    kept = by_date.read(spark, f"{folder}/feed", rest.schema)
    left = by_date.read(spark, f"{folder}/days", daily.schema).cool
    want = rows(daily.join(rest, "date", "left"), "date", "load", "obs")
    assert rows(joins.left_join_parts(left, kept.cool, kept.hot), "date", "load", "obs") == want
    # The part in buckets needs no exchange, neither for the matched nor for the other days.
    assert "Exchange" not in plan_of(joins.left_join_parts(left, kept.cool))


def test_empty_and_absent_tables(spark, folder):
    daily, none = days(spark, 5), feed(spark, 10, 4).limit(0)
    absent = by_date.read(spark, f"{folder}/none", none.schema)
    assert absent.rows().count() == 0
    by_date.append(none, f"{folder}/empty", "a", 4, most=50)
    empty = by_date.read(spark, f"{folder}/empty", none.schema)
    assert empty.rows().count() == 0
    got = joins.left_join_parts(daily, empty.cool, empty.hot)
    assert rows(got, "date", "load", "obs") == rows(daily.withColumn("obs", F.lit(None).cast("int")))


def test_a_run_that_died(spark, folder, monkeypatch):
    df = feed(spark, 200, 5)
    with monkeypatch.context() as m:
        m.setattr(commits, "decide", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            by_date.append(df, f"{folder}/t", "a", 4, most=20)
    assert by_date.read(spark, f"{folder}/t", df.schema).rows().count() == 0
    with monkeypatch.context() as m:
        m.setattr(commits, "finish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            by_date.append(df, f"{folder}/t", "a", 4, most=20)
    assert rows(by_date.read(spark, f"{folder}/t", df.schema).rows()) == rows(df)  # the reader finishes it
    by_date.replace(df.limit(3), f"{folder}/t", buckets=2)
    assert by_date.read(spark, f"{folder}/t", df.schema).rows().count() == 3


def test_dashboard_moves_no_row(spark, folder, no_broadcast):
    features = days(spark, 40).select(
        "date", F.col("load").alias("total_generation_mwh"), F.lit(60.0).alias("avg_temperature_f"),
        F.lit(30.0).alias("avg_electricity_price"), F.col("load").alias("liquidity_need_millions"))
    stamp = F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")).cast("timestamp")
    versions = spark.createDataFrame([("v1", 0), ("v2", 1), ("v3", 2)], "model_version string, k int")
    predictions = days(spark, 60).filter("load % 4 <> 1").join(versions, F.expr("load % 3 >= k")).select(
        "date", (F.col("load") + 12 * F.col("k")).alias("predicted_liquidity_millions"), "model_version",
        F.when(F.col("k") < 2, stamp + F.make_interval(hours=F.col("k"))).alias("prediction_timestamp"))
    want = rows(views.daily_energy_dashboard(features, predictions))
    kept = []
    for name, df in (("f", features), ("p", predictions)):
        by_date.append(df, f"{folder}/{name}", "all", 4)
        kept.append(by_date.read(spark, f"{folder}/{name}", df.schema).cool)
    view = views.daily_energy_dashboard(*kept)
    assert rows(view) == want and len(want) == 40
    assert "Exchange" not in plan_of(view) and "SortMergeJoin" in plan_of(view)

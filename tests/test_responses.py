"""Landed responses: their files and names, how many tasks write them, what reading them costs."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from wattledger.sources import commits, payloads
from wattledger.streaming import incremental
from wattledger.testbed import q_sources
from wattledger.testbed.standins import Tables

from .conftest import rows
from .test_sources import record, write


def orders(spark, folder, n=4000):
    frame = spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.lit(5.0).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
        F.to_timestamp(F.lit("2001-01-05")).alias("o_orderdate"))
    frame.coalesce(1).write.parquet(f"{folder}/orders.parquet")


def written_by(spark, below):
    """Tasks that wrote a response, from the names of the files before they are renamed."""
    found = [n for _, _, files in os.walk(below) for n in files if n.startswith("part-")]
    return {re.match(r"part-(\d+)-", n).group(1) for n in found}


def test_small_responses_are_written_by_many_tasks(spark, folder, monkeypatch):
    orders(spark, folder)
    tasks, path = set(), f"{folder}/responses"
    real = commits.located

    def watched(session, place):  # called once the responses are written
        for name in os.listdir(folder):
            tasks.update(written_by(session, f"{folder}/{name}"))
        return real(session, place)

    monkeypatch.setattr(q_sources, "scratch_path", lambda spark, name: f"{folder}/{name}")
    monkeypatch.setattr(commits, "located", watched)
    got = entry_point.queries()["src7_validate_files"](spark, folder)
    assert rows(got, "page", "is_valid") == [(p, p % 4 == 3) for p in range(16)]
    assert len(tasks) > 1
    kept = sorted(n for n in os.listdir(path) if not n.startswith("."))
    assert kept == sorted(f"{p}_0.json" for p in range(16))  # and no folder left to list


def test_generation_responses_hold_every_reading_twice(spark, folder):
    frame = spark.range(5000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 20).alias("l_suppkey"), (F.col("id") % 50 + 0.5).alias("l_quantity"),
        F.lit("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), F.to_timestamp(F.lit("2001-01-05")).alias("l_shipdate"))
    frame.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    t = Tables(spark, folder)
    responses = q_sources.generation_responses(t)
    assert responses.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    data = responses.select(F.explode("response.data").alias("r")).select("r.*")
    assert data.count() == 10_000 and data.filter("value = 'n/a'").count() == 5000
    assert rows(payloads.parse_generation(responses, True)) == rows(t.readings.select("date", "fuel_type", "generation_mwh", "respondent"))


def test_series_of_a_file_is_worked_out_before_its_records(spark, folder):
    obs = [{"date": "2025-05-01", "value": "1.5"}, {"date": "2025-04-01", "value": "."}]
    for name in ("INDPRO_2.json", "-x y_INDPRO.json", "OTHER.json"):
        write(folder, f"a/{name}", {"observations": obs})
    for read, column in ((payloads.read_series, "indicator"), (payloads.read_series_described, "series_id")):
        got = read(spark, f"{folder}/a")
        want = ["OTHER", "industrial_production_index" if column == "indicator" else "INDPRO", "x"]
        assert sorted(r[column] for r in got.collect()) == sorted(want)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract" not in plan[: plan.index("Generate explode")]


def test_a_batch_without_rejects_is_not_kept_in_memory(spark, folder, monkeypatch):
    write(folder, "landing/a.json", {"response": {"data": [record("2025-05-23", "NG", "1")]}})
    kept, real = [], commits.stage

    def watched(df, table, batch):
        kept.append(df.sparkSession._jsparkSession.sharedState().cacheManager().isEmpty())
        return real(df, table, batch)

    monkeypatch.setattr(commits, "stage", watched)
    places = {"landing": f"{folder}/landing", "table": "raw_eia_data"}
    assert incremental.load_new_responses(spark, **places, target=f"{folder}/t1", checkpoint=f"{folder}/m1") == 1
    assert kept == [True]
    assert incremental.load_new_responses(
        spark, **places, target=f"{folder}/t2", checkpoint=f"{folder}/m2", rejected=f"{folder}/bad") == 1
    assert kept == [True, False, False]


def test_files_of_a_batch_are_listed_by_few_tasks(spark, folder):
    for i in range(100):
        write(folder, f"landing/{i}.json", {"response": {"data": [record("2025-05-23", "NG", "1")]}})
    before = spark.conf.get(incremental.LISTING_TASKS)
    places = {"landing": f"{folder}/landing", "table": "raw_eia_data", "target": f"{folder}/t", "checkpoint": f"{folder}/m"}
    tracker = spark.sparkContext.statusTracker()
    assert incremental.load_new_responses(spark, **places) == 100 and incremental.load_new_responses(spark, **places) == 0
    stages = [tracker.getStageInfo(s) for s in range(10_000)]
    listings = [s.numTasks for s in stages if s and s.name.startswith("start at")]
    assert listings and max(listings) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(incremental.LISTING_TASKS) == before

"""Publication of loads: several writers, crashes, repeated batches, JSON responses, rejects."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.plans import daily_run
from wattledger.sources import commits
from wattledger.streaming import incremental

from .conftest import rows
from .test_sources import CSV, D22, D23, record, write

TABLE = "raw_eia_data"


@pytest.fixture
def places(folder):
    return {n: f"{folder}/{n}" for n in ("landing", "table", "marks", "rejected")}


def load(spark, p, **options):
    return incremental.load_new_files(spark, p["landing"], TABLE, p["table"], p["marks"], rejected=p["rejected"], **options)


def written_directly(spark, p, n=2):
    day = F.to_date(F.lit("2025-05-20"))
    frame = spark.range(n).select(day.alias("date"), F.lit("WAT").alias("fuel_type"), F.lit(1.0).alias("generation_mwh"))
    schemas.select_typed(frame, TABLE).write.mode("append").parquet(p["table"])


def test_other_writers_stay_readable_in_both_orders(spark, places):
    write(places["landing"], "run_date=2025-05-23/a.csv", CSV)
    written_directly(spark, places)
    assert load(spark, places) == 3
    written_directly(spark, places, 4)
    assert load(spark, places) == 0
    plain = spark.read.parquet(places["table"])
    assert plain.columns == schemas.TABLES[TABLE].names and plain.count() == 2 + 3 + 4
    whole = commits.read(spark, places["table"], schemas.TABLES[TABLE])
    assert whole.schema.names == schemas.TABLES[TABLE].names and whole.count() == 9


def test_rejected_in_the_same_batch(spark, places):
    write(places["landing"], "run_date=2025-05-23/a.csv", CSV)
    write(places["landing"], "run_date=2025-05-24/b.csv", CSV)
    assert load(spark, places, max_files=1) == 6
    got = rows(commits.batches(spark, places["table"]), "rows", "rejected")
    assert got == [(3, 4), (3, 4)]  # together all 14 landed records
    bad = spark.read.parquet(places["rejected"])
    assert bad.columns == ["source_file", "error", "record"] and bad.count() == 8
    assert bad.filter(F.col("source_file").endswith("b.csv")).count() == 4
    assert json.loads(bad.filter(F.col("record").contains("many")).first()["record"])["fuel_type"] == "NG"


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["decide", "finish", "move"])
def test_a_crash_shows_all_of_a_batch_or_nothing(spark, places, monkeypatch, step):
    write(places["landing"], "run_date=2025-05-23/a.csv", CSV)
    real = getattr(commits, "finish" if step == "move" else step)

    def dies(*args, **named):
        if step == "move":  # the first file moved, the others not
            some = dict(args[2], moves=args[2]["moves"][:1])
            for move in some["moves"]:
                path, fs = commits.located(spark, move["source"])
                place, _ = commits.located(spark, move["place"])
                fs.mkdirs(place.getParent())
                fs.rename(path, place)
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(commits, "finish" if step == "move" else step, dies)
        with pytest.raises(Exception, match="Crash"):
            load(spark, places)
    if step == "decide":
        assert commits.data_files(spark, places["table"]) == []
    else:  # decided: a reader finishes it
        assert commits.read(spark, places["table"], schemas.TABLES[TABLE]).count() == 3
    assert getattr(commits, "finish" if step == "move" else step) is real
    assert load(spark, places) == 3  # the repeated batch adds its rows once
    assert spark.read.parquet(places["table"]).count() == 3
    assert spark.read.parquet(places["rejected"]).count() == 4
    assert commits.names(spark, f"{places['table']}/{commits.STAGING}") == []


def test_a_new_checkpoint_never_meets_old_records(spark, places, folder):
    write(places["landing"], "run_date=2025-05-23/a.csv", CSV)
    load(spark, places)
    load(spark, places | {"marks": f"{folder}/other/marks"})
    assert spark.read.parquet(places["table"]).count() == 6


def test_consumed_files_can_be_removed(spark, places):
    path = write(places["landing"], "run_date=2025-05-23/a.csv", CSV)
    load(spark, places, clean="delete")
    write(places["landing"], "run_date=2025-05-24/b.csv", CSV)
    load(spark, places, clean="delete")
    assert not os.path.exists(path) and spark.read.parquet(places["table"]).count() == 6


def test_responses(spark, places):
    def responses(table, p):
        return incremental.load_new_responses(spark, p["landing"], table, p["table"], p["marks"], rejected=p["rejected"])

    data = [record("2025-05-23", "NG", "25000"), record("2025-05-22", "WND", "n/a"), record(None, "NG", 1)]
    write(places["landing"], "run_date=1/a.json", {"response": {"data": data}})
    write(places["landing"], "run_date=1/b.json", {"error": "x"})
    write(places["landing"], "run_date=1/c.json", {"response": {"data": []}})
    write(places["landing"], "run_date=1/d.json", '{"response": {"data": [')
    assert responses(TABLE, places) == 1 and responses(TABLE, places) == 0
    write(places["landing"], "run_date=2/e.json", json.dumps({"response": {"data": [record("2025-05-22", "SUN", 3)]}}, indent=2))
    assert responses(TABLE, places) == 1
    got = spark.read.parquet(places["table"])
    assert got.columns == schemas.TABLES[TABLE].names
    assert rows(got, "date", "fuel_type", "data_source") == [(D22, "SUN", "EIA"), (D23, "NG", "EIA")]
    bad = spark.read.parquet(places["rejected"]).withColumn("f", F.regexp_extract("source_file", "[^/]+$", 0))
    assert rows(bad, "f", "error") == [
        ("a.json", "Unusable record"), ("a.json", "Unusable record"), ("b.json", "Missing 'response' key in API data"),
        ("c.json", "No data found in API response"), ("d.json", "Malformed JSON")]


def test_daily_ingest_of_both_formats(spark, folder):
    landing, store = f"{folder}/landing", f"{folder}/store"
    for name in daily_run.RAW:
        os.makedirs(f"{landing}/{name}")
    write(f"{landing}/{TABLE}", "run_date=2025-05-23/a.csv", CSV)
    write(f"{landing}/{TABLE}", "run_date=2025-05-23/a.json", {"response": {"data": [record("2025-05-23", "NG", 7)]}})
    obs = [{"date": "2025-05-01", "value": "101.5"}, {"date": "2025-04-01", "value": "."}, {"date": "never", "value": "1"}]
    write(f"{landing}/raw_economic_data", "run_date=2025-05-23/INDPRO.json", {"observations": obs})
    periods = [{"startTime": "2025-05-23T06:00:00-07:00", "temperature": 72, "windSpeed": "9 to 14 mph"}, {"startTime": "2025-05-23T18:00:00-07:00"}]
    write(f"{landing}/raw_weather_data", "f.json", {"properties": {"periods": periods}})
    write(f"{landing}/raw_weather_data", "g.json", {"properties": {}})
    for _ in range(2):
        daily_run.ingest(spark, landing, store)
    assert {t: daily_run.table(spark, store, t).count() for t in daily_run.RAW} == {
        "raw_eia_data": 4, "raw_weather_data": 2, "raw_economic_data": 1, "raw_price_data": 0}
    assert rows(daily_run.table(spark, store, "raw_economic_data"), "indicator") == [("industrial_production_index",)]
    counts = daily_run.load_counts(spark, store).groupBy("table_name").agg(F.sum("rows").alias("n"), F.sum("rejected").alias("m"))
    assert rows(counts) == [("raw_economic_data", 1, 1), ("raw_eia_data", 4, 4), ("raw_weather_data", 2, 1)]
    assert rows(daily_run.rejected(spark, store, "raw_weather_data"), "error") == [("Missing 'periods' key in response",)]
    assert daily_run.rejected(spark, store, "raw_price_data").count() == 0

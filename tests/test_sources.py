"""Payload readers, CSV loads, sinks and the incremental loader on real files."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.plans import features as feats
from wattledger.sources import files, payloads, sinks
from wattledger.streaming import incremental

from .conftest import rows


def write(folder, name, value):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(value if isinstance(value, str) else json.dumps(value))
    return path


D22, D23 = dt.date(2025, 5, 22), dt.date(2025, 5, 23)


def record(day, fuel, value):
    return {"period": day, "fueltype": fuel, "value": value, "respondent": "CAL"}


def test_generation_payload(spark, folder):
    data = [record("2025-05-23", "NG", "25000"), record("2025-05-23", "SUN", 15000.5),
            record("2025-05-22", "WND", "n/a"), record("2025-05-22", None, "5"),
            record("2025-05-22", "NG", 26000)]
    write(folder, "a.json", {"response": {"data": data}})
    df = payloads.read_generation(spark, folder)
    assert df.dtypes == [("date", "date"), ("fuel_type", "string"),
                         ("generation_mwh", "double"), ("data_source", "string")]
    assert rows(df) == [(D22, "NG", 26000.0, "EIA"), (D23, "NG", 25000.0, "EIA"),
                        (D23, "SUN", 15000.5, "EIA")]
    research = payloads.read_generation(spark, folder, with_respondent=True)
    assert research.columns[-1] == "respondent" and research.count() == 3
    asked = payloads.feed_filter(research, D23, D23, fuels=["NG"], limit=5)
    assert rows(asked, "fuel_type", "generation_mwh") == [("NG", 25000.0)]


def test_large_generation_payload(spark, folder):
    fuels = ["NG", "SUN", "WAT", "WND"]
    data = [record(str(dt.date(2025, 1, 1) + dt.timedelta(i // 4)), fuels[i % 4],
                   str(10000 + i * 100)) for i in range(400)]
    write(folder, "big.json", {"response": {"data": data}})
    assert payloads.read_generation(spark, folder).count() == 400


def test_validation(spark, folder):
    write(folder, "1.json", {"error": "x"})
    write(folder, "2.json", {"response": {"total": 1}})
    write(folder, "3.json", {"response": {"data": []}})
    write(folder, "4.json", {"response": {"data": [record("2025-05-22", "NG", "1")]}})
    got = {os.path.basename(r["source_file"]): (r["is_valid"], r["error"])
           for r in payloads.validate_files(spark, folder).collect()}
    assert got["1.json"] == (False, "Missing 'response' key in API data")
    assert got["2.json"] == (False, "Missing 'data' key in response")
    assert got["3.json"] == (False, "No data found in API response")
    assert got["4.json"] == (True, None)


def test_forecast_payload(spark, folder):
    periods = [
        {"name": "Today", "startTime": "2025-05-23T06:00:00-07:00", "temperature": 72,
         "windSpeed": "9 to 14 mph", "windDirection": "SW", "shortForecast": "Sunny " * 20},
        {"name": "Tonight", "startTime": "2025-05-23T18:00:00-07:00", "windSpeed": "10 mph"},
        {"name": "Next", "startTime": "2025-05-24T06:00:00-07:00", "temperature": 60},
    ]
    write(folder, "f.json", {"properties": {"periods": periods}})
    first = payloads.read_forecast(spark, folder)
    assert dict(first.dtypes)["temperature_f"] == "int" and dict(first.dtypes)["wind_speed"] == "int"
    got = first.orderBy("date", F.col("temperature_f").desc()).collect()
    assert [(r["temperature_f"], r["wind_speed"]) for r in got] == [(72, 9), (0, 10), (60, 0)]
    assert got[0]["forecast"] == "Sunny " * 20 and got[1]["forecast"] == ""
    digits = payloads.read_forecast(spark, folder, wind="digits")
    assert sorted(r["wind_speed"] for r in digits.collect()) == [0, 10, 914]
    wide = payloads.read_forecast_wide(spark, folder).orderBy("period_name").collect()
    assert wide[0]["wind_direction"] == "Unknown" and wide[1]["wind_speed"] == "9 to 14 mph"


def test_series_payload(spark, folder):
    obs = [{"date": "2025-05-01", "value": "101.5"}, {"date": "2025-04-01", "value": "."}]
    write(folder, "INDPRO.json", {"observations": obs})
    write(folder, "XYZ_1.json", {"observations": obs})
    assert rows(payloads.read_series(spark, folder), "indicator", "value") == [
        ("XYZ", 101.5), ("industrial_production_index", 101.5)]
    assert rows(payloads.read_series_described(spark, folder),
                "series_id", "indicator_name", "units") == [
        ("INDPRO", "Industrial Production Index", "Index 2017=100"), ("XYZ", "XYZ", "Units")]


def test_historical_weather(spark, folder):
    daily = {"time": ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04"],
             "temperature_2m_max": [60.5, None, 0.0, 61.3], "temperature_2m_min": [50.0, 40.0, -5.0, 50.0],
             "temperature_2m_mean": [55.0, 47.7, 0.0, 1.0], "windspeed_10m_max": [10.0, 11.0, 12.0, 13.0],
             "precipitation_sum": [0.0, 0.1, None, 0.0], "weathercode": [0, 95, 7, None]}
    write(folder, "h.json", {"daily": daily})
    got = payloads.read_historical_weather(spark, folder).orderBy("date").collect()
    assert [r["temperature_f"] for r in got] == [
        round((60.5 + 50) / 2, 1), 47.7, None, round((61.3 + 50) / 2, 1)]
    assert [r["forecast"] for r in got] == ["Clear sky", "Thunderstorm", "Weather code 7",
                                            "Weather code None"]


CSV = ('date,fuel_type,generation_mwh,data_source\n'
       '2025-05-22,NG,100.5,EIA\n'
       '2025-05-22,"SUN, roof",NULL,null\n'
       '2025-05-22 00:16:47.4,WND,,\n'
       'not a date,NG,1,EIA\n'
       '2025-05-22,NG,many,EIA\n'
       '2025-05-22,NG\n'
       '2025-05-22,NULL,3,EIA\n')


def test_load_skips_bad_records(spark, folder):
    write(folder, "run_date=2025-05-23/part.csv", CSV)
    write(folder, "run_date=2025-05-24/part.csv", CSV)
    good = files.load_raw(spark, folder, "raw_eia_data", "2025-05-23")
    assert good.schema.names == schemas.TABLES["raw_eia_data"].names
    assert [(f.name, f.dataType) for f in good.schema] == [
        (f.name, f.dataType) for f in schemas.TABLES["raw_eia_data"]]
    got = rows(good.withColumn("generation_mwh", F.col("generation_mwh").cast("double")),
               "fuel_type", "generation_mwh", "data_source")
    assert got == [("NG", 100.5, "EIA"), ("SUN, roof", None, "EIA"), ("WND", None, "EIA")]
    bad = files.rejected(spark, folder, "raw_eia_data", "2025-05-23")
    assert bad.count() == 4


def test_incremental_load_reads_each_file_once(spark, folder):
    landing, target, marks = (f"{folder}/{n}" for n in ("landing", "table", "marks"))
    write(landing, "run_date=2025-05-23/a.csv", CSV)
    incremental.load_new_files(spark, landing, "raw_eia_data", target, marks)
    assert spark.read.parquet(target).count() == 3
    incremental.load_new_files(spark, landing, "raw_eia_data", target, marks)
    assert spark.read.parquet(target).count() == 3
    write(landing, "run_date=2025-05-24/b.csv", CSV)
    incremental.load_new_files(spark, landing, "raw_eia_data", target, marks)
    assert spark.read.parquet(target).count() == 6


def test_landing_replaces_only_its_date(spark, folder):
    df = spark.sql("SELECT DATE '2025-05-22' AS date, 'NG' AS fuel_type, 1.0D AS generation_mwh")
    for run in ("2025-05-23", "2025-05-24", "2025-05-24"):
        sinks.land_raw(df, folder, run)
    assert spark.read.parquet(folder).count() == 2


def test_training_file_checks(spark, folder):
    write(folder, "few.csv", "total_generation_mwh,avg_temperature_f\n1,2\n")
    with pytest.raises(ValueError, match="Missing required feature columns"):
        files.read_training(spark, f"{folder}/few.csv")
    write(folder, "no_target.csv", ",".join(schemas.FEATURES) + "\n1,2,3,4,5\n")
    with pytest.raises(ValueError, match="Missing target column"):
        files.read_training(spark, f"{folder}/no_target.csv")
    names = [schemas.TARGET, *reversed(schemas.FEATURES)]
    write(folder, "full.csv", ",".join(names) + "\n9,5,4,,2,1\n")
    (got,) = files.read_training(spark, f"{folder}/full.csv").collect()
    assert got["liquidity_need_millions"] == 9.0 and got["oil_price_usd"] is None


def test_saved_generation_and_weather_features(spark, folder):
    write(folder, "gen.csv", "date,fuel_type,generation_mwh,respondent\n"
                             "2025-05-11 00:16:47.415921,NG,30325.5,CAL\n")
    assert rows(files.load_saved_generation(spark, f"{folder}/gen.csv")) == [
        (dt.date(2025, 5, 11), "NG", 30325.5, "CAL")]
    wx = spark.createDataFrame(
        [(D22, 50, "10 mph", "Partly Cloudy"), (D22, 66, "9 to 14 mph", "Mostly Sunny"),
         (D23, 52, "8 to 14 mph", "Mostly Cloudy"), (D23, 101, None, "Fog")],
        "date date, temperature_f int, wind_speed string, forecast string")
    got = rows(feats.weather_export(wx))
    assert got == [
        (D22, 50.0, 10.0, 0.0, 15.0, 0.7, 0.4, "Partly Cloudy"),
        (D22, 66.0, 9.0, 1.0, 0.0, 1.0, 0.36, "Clear"),
        (D23, 52.0, 8.0, 0.0, 13.0, 0.7, 0.32, "Partly Cloudy"),
        (D23, 101.0, None, 36.0, 0.0, 0.1, None, "Other")]
    assert rows(feats.energy_factors(wx), "wind_potential", "demand_factor")[0][0] in ("Low", "Medium")


def test_results_and_tables(spark, folder):
    df = spark.range(3)
    assert sinks.save_results({"a": df, "b": df.limit(0)}, folder) == ["a"]
    names = sinks.create_tables(spark, f"{folder}/tables", "t_")
    assert len(names) == 8
    for table in schemas.TABLES:
        assert [(f.name, f.dataType) for f in spark.table("t_" + table).schema] == [
            (f.name, f.dataType) for f in schemas.TABLES[table]]

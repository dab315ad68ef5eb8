"""Column functions: null and edge values of every scalar and bucketing."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger.functions import buckets as bk
from wattledger.functions import rounding
from wattledger.functions import scalars as sc


def apply(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize("build", [sc.clean_number, sc.coerce_number])
def test_clean_number(spark, build):
    texts = ["123.45", ".", "", None, " 7 ", "1e3", "12d", "0x1p3", "abc", "-.5", "5.", "1,000"]
    want = [123.45, None, None, None, 7.0, 1000.0, None, None, None, -0.5, 5.0, None]
    assert apply(spark, texts, "string", build) == want
    assert math.isnan(apply(spark, ["nan"], "string", build)[0])
    assert apply(spark, ["-inf"], "string", build) == [-math.inf]


def test_wind_texts(spark):
    texts = ["9 to 14 mph", "10 mph", "calm", "", None]
    assert apply(spark, texts, "string", sc.digits_number) == [914, 10, 0, 0, 0]
    assert apply(spark, texts, "string", sc.first_number) == [9.0, 10.0, None, None, None]


def test_dates(spark):
    texts = ["2025-05-11 00:05:27.941783", "2025-05-11T06:00:00-07:00", "2025-05-11", "x", None]
    day = dt.date(2025, 5, 11)
    assert apply(spark, texts, "string", sc.text_date) == [day, day, day, None, None]
    days = [dt.date(1999, 1, 25), dt.date(1999, 1, 30), dt.date(1999, 1, 31)]
    assert apply(spark, days, "date", sc.week_start) == [dt.date(1999, 1, 25)] * 3
    assert apply(spark, days, "date", sc.weekday) == [0, 5, 6]
    assert apply(spark, days, "date", sc.is_weekend) == [False, True, True]
    assert apply(spark, days, "date", sc.day_name) == ["Monday", "Saturday", "Sunday"]
    assert apply(spark, days[:1], "date", sc.version_tag) == ["v19990125"]
    assert apply(spark, days[:1], "date", lambda c: sc.calendar(c, F.date_add(c, 2))) == [
        [dt.date(1999, 1, 25), dt.date(1999, 1, 26), dt.date(1999, 1, 27)]
    ]


def test_degree_days_and_indexes_keep_nulls(spark):
    t = [None, 50.0, 65.0, 80.0]
    assert apply(spark, t, "double", sc.cooling_degree_days) == [None, 0.0, 0.0, 15.0]
    assert apply(spark, t, "double", sc.heating_degree_days) == [None, 15.0, 0.0, 0.0]
    w = [None, 0.0, 10.0, 40.0]
    assert apply(spark, w, "double", sc.wind_potential_index) == [None, 0.0, 0.4, 1.0]


def test_zero_actual_gives_null_percentage(spark):
    got = apply(spark, [0.0, 100.0, None], "double", lambda c: sc.percentage_error(c, F.lit(90.0)))
    assert got == [None, 10.0, None]


def test_noise_is_repeatable_and_bounded(spark):
    days = [dt.date(1999, 1, 1) + dt.timedelta(i) for i in range(400)]
    a = apply(spark, days, "date", sc.noise_from_date)
    assert a == apply(spark, days, "date", sc.noise_from_date)
    assert min(a) >= 50 and max(a) <= 200
    drawn = apply(spark, days, "date", lambda c: sc.noise_random(50, 200, 1))
    assert min(drawn) >= 50 and max(drawn) <= 200


def test_seasonal_factor(spark):
    day = dt.date(2025, 4, 1)
    got = apply(spark, [day], "date", sc.seasonal_factor)[0]
    assert got == pytest.approx(1 + 0.2 * math.sin(2 * math.pi * 91 / 365))


def test_rounding_matches_python_and_numpy(spark):
    r = random.Random(7)
    values = [r.randrange(-4000, 4000) / 40 for _ in range(500)]
    values += [r.uniform(-200, 200) for _ in range(500)]
    values += [60.25, 60.35, 60.45, 0.05, 0.15, -0.25, -0.35, 0.0, 1e6 + 0.05, None]
    got = apply(spark, values, "double", lambda c: rounding.round_exact(c, 1))
    assert got == [None if v is None else round(v, 1) + 0.0 for v in values]
    known = values[:-1]
    got = apply(spark, known, "double", lambda c: rounding.round_product(c, 2))
    assert got == list(np.round(np.array(known), 2))


LADDERS = [
    (bk.risk_level, [None, 100.0, 100.01, 200.0, 201.0],
     ["High Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk"]),
    (bk.performance_status, [None, 10.0, 25.0, 50.0, 50.1],
     ["Needs Attention", "Excellent", "Good", "Acceptable", "Needs Attention"]),
    (bk.temperature_category, [None, 60.0, 75.0, 85.0, 86.0],
     ["Hot (>85°F)", "Cool (≤60°F)", "Mild (61-75°F)", "Warm (76-85°F)", "Hot (>85°F)"]),
    (bk.generation_level, [None, 50000.0, 100000.0, 100000.5],
     ["High Generation", "Low Generation", "Medium Generation", "High Generation"]),
    (bk.oil_price_category, [None, 60.0, 80.0, 81.0],
     ["High Oil Price", "Low Oil Price", "Medium Oil Price", "High Oil Price"]),
    (bk.unemployment_category, [None, 4.0, 6.0, 6.1],
     ["High Unemployment", "Low Unemployment", "Medium Unemployment", "High Unemployment"]),
    (bk.performance_rating, [None, 15.0, 30.0, 50.0, 51.0],
     ["Poor", "Excellent", "Good", "Acceptable", "Poor"]),
    (bk.performance_grade, [None, 15.0, 30.0, 50.0, 51.0],
     ["Needs Improvement", "Excellent", "Good", "Acceptable", "Needs Improvement"]),
    (bk.wind_potential, [None, 7.9, 8.0, 15.0], ["Low", "Low", "Medium", "High"]),
    (bk.demand_factor, [None, 60.0, 61.0, 80.0],
     ["Moderate", "High Heating", "Moderate", "High Cooling"]),
    (bk.temp_bin, [None, 0.0, 0.5, 60.0, 60.5, 85.0, 100.0, 100.5],
     [None, None, "Cold", "Cold", "Mild", "Warm", "Hot", None]),
    (bk.wind_bin, [None, 0.0, 5.0, 15.0, 25.0, 50.0, 51.0],
     [None, None, "Calm", "Light", "Moderate", "Strong", None]),
]


@pytest.mark.parametrize("build, values, want", LADDERS, ids=lambda x: getattr(x, "__name__", ""))
def test_ladders(spark, build, values, want):
    assert apply(spark, values, "double", build) == want


def test_prediction_labels(spark):
    df = spark.createDataFrame(
        [(0, None, None), (1, 1.0, 10.0), (2, 1.0, 25.0), (3, 1.0, 26.0), (4, 1.0, None)],
        "i int, p double, e double",
    )
    got = df.orderBy("i").select(
        bk.prediction_quality(F.col("p"), F.col("e")).alias("q"),
        bk.accuracy_category(F.col("p"), F.col("e")).alias("a"),
    ).collect()
    assert [r["q"] for r in got] == ["No Prediction", "Accurate", "Acceptable", "Poor", "Poor"]
    assert [r["a"] for r in got] == [
        "No Prediction", "High Accuracy", "Medium Accuracy", "Low Accuracy", "Low Accuracy",
    ]


def test_forecast_words(spark):
    texts = ["Mostly Sunny", "Mostly Clear", "Mostly Cloudy", "Partly Cloudy", "Cloudy",
             "Rain Showers", "Thunderstorms", "Fog", None]
    simple = ["Clear", "Clear", "Partly Cloudy", "Partly Cloudy", "Cloudy",
              "Rainy", "Rainy", "Other", "Other"]
    assert apply(spark, texts, "string", bk.weather_simple) == simple
    index = apply(
        spark, texts, "string", lambda c: bk.solar_potential_index(bk.weather_simple(c))
    )
    assert index == [1.0, 1.0, 0.7, 0.7, 0.3, 0.1, 0.1, 0.1, 0.1]
    assert apply(spark, texts, "string", bk.solar_potential) == [
        "High", "High", "Low", "Medium", "Low", "Low", "Low", "Low", "Low",
    ]


def test_risk_flags_and_score(spark):
    df = spark.createDataFrame(
        [(201.0, 51.0, 81.0, 49999.0), (100.0, 5.0, 50.0, 60000.0), (201.0, None, None, None)],
        "l double, e double, o double, g double",
    )
    flags = bk.risk_flags(F.col("l"), F.col("e"), F.col("o"), F.col("g"))
    score = sum(flags.values(), F.lit(0))
    got = df.select(score.alias("s"), bk.overall_risk(score).alias("r")).collect()
    assert [tuple(r) for r in got] == [(4, "High Risk"), (0, "Low Risk"), (1, "Medium Risk")]


def test_map_lookup_default(spark):
    got = apply(spark, [1, 2, None], "int", lambda c: sc.map_lookup(c, {1: "a"}, F.lit("?")))
    assert got == ["a", "?", "?"]

"""Model training, the exact split, saved models, forecasts and the daily run."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.operators import quantiles
from wattledger.plans import daily_run
from wattledger.plans import model as ml
from wattledger.sources import sinks

from .conftest import rows


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(42)
    data = []
    for i in range(60):
        x = [75000 + r.normal(0, 5000), 65 + r.normal(0, 10), 70 + r.normal(0, 5),
             101 + 0.1 * i, 45 + r.normal(0, 4)]
        y = x[0] * 0.002 + x[2] * 1.5 + x[1] * 0.5 + r.normal(0, 10)
        data.append((dt.date(2025, 3, 1) + dt.timedelta(i), *map(float, x), float(y)))
    kinds = ", ".join(f"{c} double" for c in [*schemas.FEATURES, schemas.TARGET])
    return spark.createDataFrame(data, f"date date, {kinds}").cache()


def arrays(df):
    got = df.orderBy("date").collect()
    x = np.array([[r[c] for c in schemas.FEATURES] for r in got])
    return x, np.array([r[schemas.TARGET] for r in got])


def test_unknown_model_type():
    with pytest.raises(ValueError, match="Unknown model type"):
        ml.LiquidityModel("linear-regression")


def test_predict_before_training(frame):
    with pytest.raises(ValueError, match="not trained"):
        ml.LiquidityModel().predict(frame)


@pytest.mark.parametrize("n, share", [(1, 0.2), (5, 0.2), (7, 0.3), (60, 0.2)])
def test_split_is_exact_and_repeatable(frame, n, share):
    part = frame.orderBy("date").limit(n)
    got = rows(ml.split(part, share=share), "date", "is_validation")
    assert sum(v for _, v in got) == int(np.ceil(n * share))
    assert got == rows(ml.split(part.repartition(5), share=share), "date", "is_validation")
    if n == 60:
        assert got != rows(ml.split(part, share=share, seed=7), "date", "is_validation")


def test_hash_threshold_against_sorting(spark):
    keys = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    ticket = F.xxhash64("k")
    ordered = sorted(r[0] for r in keys.select(ticket).collect())
    for k in (1, 17, 2500, 5000):
        got = quantiles.hash_threshold(keys, ticket, lambda n, k=k: F.lit(k))
        assert rows(got) == [(ordered[k - 1],)]
    assert rows(quantiles.hash_threshold(keys, ticket, lambda n: n * 0)) == []


def closed_form(x, y, alpha):
    s = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(s.T @ s + alpha * np.eye(x.shape[1]), s.T @ (y - y.mean()))
    return w, y.mean()


@pytest.mark.parametrize("kind, alpha", [("linear_regression", 0.0), ("ridge", 1.0)])
def test_weights_match_closed_form(frame, kind, alpha):
    x, y = arrays(frame)
    w, b = ml.LiquidityModel(kind).fit(frame).coefficients()
    want_w, want_b = closed_form(x, y, alpha)
    assert w == pytest.approx(list(want_w), rel=1e-6)
    assert b == pytest.approx(want_b, rel=1e-9)


def test_standardize_uses_training_statistics(frame):
    train = frame.limit(30)
    x, _ = arrays(train)
    got, _ = arrays(ml.standardize(train, train))
    assert got == pytest.approx((x - x.mean(0)) / x.std(0))
    flat = train.withColumn("oil_price_usd", F.lit(3.0))
    assert set(rows(ml.standardize(flat, flat), "oil_price_usd")) == {(0.0,)}


@pytest.mark.parametrize("kind", ml.MODEL_TYPES)
def test_train_metrics_and_saved_model(spark, frame, folder, kind):
    params = {"trees": 10, "depth": 4} if kind == "random_forest" else {}
    model = ml.LiquidityModel(kind, params=params).train(frame)
    assert model.metrics["n_train_samples"] == 48 and model.metrics["n_val_samples"] == 12
    for part in ("train", "validation"):
        m = model.metrics[part]
        assert m["mae"] >= 0 and m["rmse"] >= m["mae"] and m["mape"] >= 0 and m["r2"] <= 1
    model.save(spark, folder)
    back = ml.LiquidityModel.load(spark, folder)
    assert back.metrics == model.metrics and back.model_type == kind
    assert rows(back.predict(frame), "date", "prediction") == rows(
        model.predict(frame), "date", "prediction")
    if kind == "random_forest":
        top = model.importances(spark).collect()
        assert len(top) == 5 and sum(r["importance"] for r in top) == pytest.approx(1.0)


def test_same_seed_same_scores(frame):
    a, b = (ml.LiquidityModel().train(frame).metrics["validation"]["r2"] for _ in range(2))
    assert a == pytest.approx(b, abs=1e-9)


def test_prepare_fills_then_drops(spark, frame):
    holes = frame.withColumn(
        "oil_price_usd", F.when(F.dayofmonth("date") > 5, F.col("oil_price_usd"))
    ).withColumn(schemas.TARGET, F.when(F.dayofmonth("date") != 9, F.col(schemas.TARGET)))
    got = ml.prepare(holes)
    assert got.filter(F.col("oil_price_usd").isNull()).count() == 0
    assert got.count() == 58
    first = {r["date"]: r["oil_price_usd"] for r in got.collect()}
    assert first[dt.date(2025, 4, 3)] == first[dt.date(2025, 4, 6)]  # filled from the later day
    keyed = spark.sql("SELECT 'a' AS k, DATE '2025-01-01' AS date, 4.0D AS v UNION ALL "
                      "SELECT 'a', DATE '2025-01-02', 8.0D UNION ALL SELECT 'b', DATE '2025-01-01', NULL")
    assert rows(ml.impute(keyed, ["v"], by=["k"]), "k", "v") == [("a", 4.0), ("a", 8.0), ("b", 6.0)]


def test_forecast(frame):
    model = ml.LiquidityModel().train(frame)
    got = ml.forecast(model, frame, dt.date(2025, 4, 29)).orderBy("date").collect()
    assert [r["date"] for r in got] == [dt.date(2025, 4, 30) + dt.timedelta(i) for i in range(7)]
    assert {r["model_version"] for r in got} == {"v20250429"}
    r = got[0]
    assert r["confidence_interval_upper"] - r["confidence_interval_lower"] == pytest.approx(
        2 * 1.96 * model.metrics["validation"]["rmse"], abs=0.02)


def test_daily_run(spark, folder):
    landing, store = f"{folder}/landing", f"{folder}/store"
    days = spark.range(60).select(F.date_add(F.lit(dt.date(2025, 3, 1)), F.col("id").cast("int")).alias("date"), "id")
    fuels = F.explode(F.array(*[F.lit(f) for f in ("NG", "SUN", "WAT", "WND")])).alias("fuel_type")
    gen = days.select("date", fuels, (F.col("id") * 10 + 10000).alias("generation_mwh"), F.lit("EIA").alias("data_source"))
    wx = days.select("date", (F.col("id") % 40 + 50).alias("temperature_f"), (F.col("id") % 20).alias("wind_speed"), F.lit("Sunny").alias("forecast"), F.lit("NOAA").alias("data_source"))
    ec = days.select("date", F.explode(F.array(F.lit("crude_oil_price_wti"), F.lit("industrial_production_index"))).alias("indicator"), (F.col("id") % 7 + 60).alias("value"), F.lit("FRED").alias("data_source"))
    pr = days.select("date", F.lit("wholesale_electricity").alias("price_type"), (F.col("id") % 5 + 40).alias("price_per_mwh"), F.lit("CAISO").alias("market"), F.lit("SIMULATED").alias("data_source"))
    for table, df in zip(daily_run.RAW, (gen, wx, ec, pr)):
        sinks.land_raw(df, f"{landing}/{table}", "2025-04-29", "csv")
    as_of = dt.date(2025, 4, 29)
    for _ in range(2):  # the second run loads nothing twice
        model, published = daily_run.run(spark, landing, store, as_of)
    features = spark.read.parquet(f"{store}/ml_features")
    assert features.count() == 60
    assert features.agg(F.max("total_generation_mwh")).first()[0] == 4 * 10590.0
    assert model.metrics["n_train_samples"] == 48
    assert daily_run.table(spark, store, "ml_predictions").count() == 7
    assert published["executive_kpis"].count() == 1
    assert published["daily_generation_by_fuel"].count() == 240
    assert published["current_status"].count() == 3
    dashboard = rows(published["daily_energy_dashboard"])
    for _ in range(2):  # a repeated run replaces the copies in buckets
        _, kept = daily_run.run(spark, landing, store, as_of, buckets=4)
        assert rows(kept["daily_energy_dashboard"]) == dashboard and len(dashboard) == 60

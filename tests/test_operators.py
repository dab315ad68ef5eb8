"""Joins, windows, quantiles, aggregates, set operations and quality checks on small frames."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattledger.operators import aggregates as ag
from wattledger.operators import filters as fl
from wattledger.operators import joins as jn
from wattledger.operators import metrics, quality, quantiles, sets, windows
from wattledger.plans import features as feats
from wattledger.plans import views

from .conftest import rows

DAY = dt.date(2025, 5, 1)


def day(i):
    return DAY + dt.timedelta(i)


def hot_feed(spark, n=6000):
    """A feed with a third of all rows on one date, and days the daily table lacks."""
    spread = F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 40).cast("int"))
    return spark.range(n).select(
        F.date_add(F.lit(DAY), spread.cast("int")).alias("date"), F.col("id").alias("v")
    )


def daily(spark, n=60):
    return spark.range(n).select(
        F.date_add(F.lit(DAY), (F.col("id") - 10).cast("int")).alias("date"),
        (F.col("id") * 10.0).alias("total"),
    )


def test_left_join_feed_equals_left_join(spark):
    d, feed = daily(spark), hot_feed(spark)
    assert rows(jn.left_join_feed(d, feed), "date", "total", "v") == rows(
        d.join(feed, "date", "left"), "date", "total", "v"
    )


def test_left_join_feed_keeps_null_keys_and_empty_feeds(spark):
    d = daily(spark, 3).unionByName(
        spark.sql("SELECT CAST(NULL AS DATE) AS date, CAST(1 AS DOUBLE) AS total")
    )
    empty = hot_feed(spark).limit(0)
    assert len(rows(jn.left_join_feed(d, empty))) == 4
    assert rows(jn.left_join_feed(d, hot_feed(spark)), "date", "total", "v") == rows(
        d.join(hot_feed(spark), "date", "left"), "date", "total", "v"
    )


PRED_SCHEMA = (
    "date date, model_version string, prediction_timestamp timestamp, "
    "predicted_liquidity_millions double"
)


def predictions(spark):
    noon = dt.datetime(2025, 5, 1, 12)
    later = dt.datetime(2025, 5, 1, 13)
    return spark.createDataFrame(
        [
            (day(0), "v1", noon, 100.0),
            (day(0), "v2", later, 110.0),
            (day(1), "v1", noon, 100.0),  # equal timestamps: the higher version wins
            (day(1), "v2", noon, 120.0),
            (day(2), "v1", None, 130.0),  # a null timestamp counts as newest
            (day(2), "v2", later, 140.0),
            (day(3), "v2", later, 150.0),  # a repeated key keeps both rows
            (day(3), "v2", noon, 151.0),
            (day(4), None, later, 160.0),  # newest version unknown: nothing matches
            (day(4), "v1", noon, 161.0),
        ],
        PRED_SCHEMA,
    )


def liquidity(spark, n=6):
    return spark.createDataFrame(
        [(day(i), 100.0 + 10 * i, 40000.0 + 20000 * i, None if i == 5 else 60.0 + 10 * i,
          70.0, 5.0, 30.0, 3.0 + i) for i in range(n)],
        "date date, liquidity_need_millions double, total_generation_mwh double, "
        "oil_price_usd double, avg_temperature_f double, avg_electricity_price double, "
        "industrial_production_index double, ca_unemployment_rate double",
    )


def test_latest_prediction(spark):
    got = rows(
        jn.join_latest_prediction(liquidity(spark), predictions(spark)),
        "date", "model_version", "predicted_liquidity_millions",
    )
    assert got == [
        (day(0), "v2", 110.0), (day(1), "v2", 120.0), (day(2), "v1", 130.0),
        (day(3), "v2", 150.0), (day(3), "v2", 151.0), (day(4), None, None), (day(5), None, None),
    ]
    one = windows.latest_per_key(
        predictions(spark), ["date"], "prediction_timestamp", "model_version"
    )
    assert rows(one, "date", "predicted_liquidity_millions") == [
        (day(0), 110.0), (day(1), 120.0), (day(2), 130.0), (day(3), 150.0), (day(4), 160.0)
    ]


def test_latest_model_prefers_null_timestamp(spark):
    assert rows(jn.latest_model(predictions(spark))) == [("v1",)]
    kept = rows(jn.restrict_to_latest_model(predictions(spark)), "model_version")
    assert set(kept) == {("v1",)} and len(kept) == 4


def test_attach_single_rows(spark):
    base = spark.sql("SELECT 1 AS a UNION ALL SELECT 2")
    one, none = spark.sql("SELECT 3 AS b, CAST(NULL AS INT) AS c"), spark.sql("SELECT 4 AS d WHERE 1 = 0")
    assert rows(jn.attach_single_rows(base, one)) == [(1, 3, None), (2, 3, None)]
    assert rows(jn.attach_single_rows(base, one, none)) == []


def raw_frames(spark, seed=3, n_days=12):
    """Raw feeds with duplicates, gaps and nulls."""
    r = np.random.default_rng(seed)
    def days(n):
        return [day(int(i)) for i in r.integers(0, n_days, n)]
    gen = [(d, f, None if i % 17 == 0 else float(v)) for i, (d, f, v) in enumerate(
        zip(days(80), r.choice(["NG", "SUN", "WAT", "WND"], 80), r.integers(100, 900, 80)))]
    wx = [(d, int(t), int(w), "Sunny") for d, t, w in zip(
        days(14), r.integers(40, 100, 14), r.integers(0, 40, 14))]
    names = ["crude_oil_price_wti", "industrial_production_index",
             "california_unemployment_rate", "gasoline_price_regular"]
    ec = [(d, n, float(v)) for d, n, v in zip(
        days(20), r.choice(names, 20), r.integers(1, 100, 20))]
    pr = [(d, "wholesale_electricity", float(v), "M") for d, v in zip(
        days(10), r.integers(20, 90, 10))]
    return (
        spark.createDataFrame(gen, "date date, fuel_type string, generation_mwh double"),
        spark.createDataFrame(wx, "date date, temperature_f int, wind_speed int, forecast string"),
        spark.createDataFrame(ec, "date date, indicator string, value double"),
        spark.createDataFrame(pr, "date date, price_type string, price_per_mwh double, market string"),
    )


def test_fan_out_equals_row_by_row_join(spark):
    gen, wx, ec, pr = raw_frames(spark)
    gen.createOrReplaceTempView("e")
    wx.createOrReplaceTempView("w")
    ec.createOrReplaceTempView("ec")
    pr.createOrReplaceTempView("p")
    want = spark.sql("""
      SELECT e.date, sum(e.generation_mwh) AS total, avg(w.temperature_f) AS t,
        max(CASE WHEN ec.indicator = 'crude_oil_price_wti' THEN ec.value END) AS oil,
        avg(p.price_per_mwh) AS price
      FROM e LEFT JOIN w ON e.date = w.date LEFT JOIN ec ON e.date = ec.date
      LEFT JOIN p ON e.date = p.date
      WHERE e.date IS NOT NULL AND e.generation_mwh IS NOT NULL GROUP BY e.date
      HAVING sum(e.generation_mwh) > 0""")
    got = feats.ml_features_fan_out(gen, wx, ec, pr, noise=F.lit(0))
    a, b = rows(want), rows(
        got, "date", "total_generation_mwh", "avg_temperature_f", "oil_price_usd",
        "avg_electricity_price",
    )
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[0] == y[0] and x[1:4] == pytest.approx(y[1:4]) and x[4] == pytest.approx(y[4])


def test_features_deterministic_sums(spark):
    d0, d1 = dt.date(2025, 5, 22), dt.date(2025, 5, 23)
    gen = spark.createDataFrame(
        [(d1, "NG", 25000.0), (d1, "SUN", 15000.0), (d0, "NG", 26000.0), (d0, "SUN", 14000.0)],
        "date date, fuel_type string, generation_mwh double",
    )
    wx = spark.createDataFrame(
        [(d1, 72, 10), (d1, 62, 10), (d0, 68, 8)], "date date, temperature_f int, wind_speed int"
    )
    ec = spark.createDataFrame(
        [(d1, "crude_oil_price_wti", 70.5)], "date date, indicator string, value double"
    )
    pr = spark.createDataFrame([(d1, 45.0), (d0, 47.0)], "date date, price_per_mwh double")
    got = rows(feats.ml_features(gen, wx, ec, pr, noise=F.lit(100)))
    assert got == [
        (d0, 40000.0, 68.0, None, None, None, 47.0, 40000 * 0.05 + 500.0 + 100),
        (d1, 40000.0, 67.0, 70.5, None, None, 45.0, 40000 * 0.05 + 705.0 + 100),
    ]
    doubled = rows(feats.ml_features_fan_out(gen, wx, ec, pr, noise=F.lit(0)),
                   "date", "total_generation_mwh")
    assert doubled == [(d0, 40000.0), (d1, 80000.0)]


def test_volume_of_400_records(spark):
    gen = spark.range(400).select(
        F.date_add(F.lit(DAY), (F.col("id") / 4).cast("int")).alias("date"),
        F.element_at(F.array(*[F.lit(f) for f in ("NG", "SUN", "WAT", "WND")]),
                     (F.col("id") % 4 + 1).cast("int")).alias("fuel_type"),
        (F.col("id") * 25.0 + 10000).alias("generation_mwh"),
    )
    wide = feats.generation_features(gen)
    assert wide.count() == 100
    off = wide.filter(F.abs(
        F.col("generation_ng_mwh") + F.col("generation_sun_mwh") + F.col("generation_wat_mwh")
        + F.col("generation_wnd_mwh") - F.col("total_generation_mwh")) > 1e-6)
    assert off.count() == 0
    shares = views.daily_generation_by_fuel(gen, day(0)).groupBy("date").agg(
        F.sum("generation_percentage").alias("s"))
    assert shares.filter(F.abs(F.col("s") - 100) > 1e-9).count() == 0


def test_synchronize_and_fallback(spark):
    def on(*days):
        return spark.createDataFrame([(day(i), 1.0) for i in days], "date date, x double")
    parts = jn.synchronize(on(0, 1, 1, 2), on(1, 2, 3), on(1, 5))
    assert rows(parts["common_dates"]) == [(day(1),)]
    assert parts["generation"].count() == 2 and parts["economic"].count() == 1
    parts = jn.synchronize(on(0, 1), on(2), on(3))
    assert rows(parts["common_dates"]) == [(day(0),), (day(1),)]
    assert parts["generation"].count() == 2 and parts["weather"].count() == 0
    empty = on(0).limit(0)
    assert rows(jn.common_dates(empty, on(4), on(5))) == [(day(4),)]
    assert rows(jn.common_dates(empty, empty, on(5))) == [(day(5),)]
    assert rows(jn.common_dates(empty, empty, empty)) == []
    assert rows(jn.availability(on(0, 1), on(1), on(2)), "date", "generation", "weather",
                "economic") == [(day(0), 1, 0, 0), (day(1), 1, 1, 0), (day(2), 0, 0, 1)]


def test_quantiles_against_numpy(spark):
    r = np.random.default_rng(5)
    hot = np.where(r.random(3000) < 0.34, 7.0, r.normal(50, 20, 3000).round(1))
    frame = pd.DataFrame({"g": r.choice(["a", "b"], 3000, p=[0.9, 0.1]), "x": hot,
                          "y": r.integers(0, 5, 3000).astype(float)})
    frame.loc[::97, "x"] = None
    df = spark.createDataFrame([tuple(None if v != v else v for v in t) for t in
                                frame.itertuples(index=False)], "g string, x double, y double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    for r_ in quantiles.exact_quantiles(df, ["x", "y"], probs).collect():
        want = np.quantile(frame[r_["column"]].dropna(), r_["prob"])
        assert r_["value"] == pytest.approx(want, abs=1e-9), r_
    grouped = quantiles.exact_quantiles(df, ["x"], (0.5,), ["g"]).collect()
    assert len(grouped) == 2
    for r_ in grouped:
        assert r_["value"] == pytest.approx(frame[frame.g == r_["g"]].x.median())
    one = quantiles.exact_quantiles(df.limit(1).select(F.lit(4.0).alias("x")), ["x"], (0.25,))
    assert rows(one, "value") == [(4.0,)]
    assert rows(quantiles.exact_quantiles(df.limit(0), ["x"], (0.5,))) == []
    same = quantiles.daily_quantiles(df, ["x", "y"], probs)
    assert rows(same, "column", "prob") == rows(
        quantiles.exact_quantiles(df, ["x", "y"], probs), "column", "prob")


@pytest.mark.parametrize("descending", [False, True])
def test_fills_against_pandas(spark, descending):
    r = np.random.default_rng(11)
    n = 150
    x = pd.Series(np.where(r.random(n) < 0.8, np.nan, r.integers(0, 100, n).astype(float)))
    x[:40] = np.nan  # a whole month without a value
    df = spark.createDataFrame(
        [(day(i), None if np.isnan(v) else float(v)) for i, v in enumerate(x)],
        "date date, x double")
    s = x[::-1] if descending else x
    for build, want in ((windows.forward_fill, s.ffill()), (windows.backward_fill, s.bfill())):
        got = [r[1] for r in rows(build(df, ["x"], "date", descending), "date", "x")]
        expected = [None if np.isnan(v) else v for v in want.sort_index()]
        assert got == expected
    both = windows.fill_in_order(df, ["x"], "date", descending, True, True)
    assert [r[1] for r in rows(both, "date", "x")] == list(s.ffill().bfill().sort_index())


def test_fill_by_key(spark):
    df = spark.createDataFrame(
        [("a", day(0), 1.0), ("a", day(40), None), ("b", day(1), None), ("b", day(50), 5.0)],
        "k string, date date, x double")
    assert rows(windows.forward_fill(df, ["x"], by=["k"])) == [
        ("a", day(0), 1.0), ("a", day(40), 1.0), ("b", day(1), None), ("b", day(50), 5.0)]


def test_histogram(spark):
    values = [0.0, 1.0, 1.0, 14.9, 15.0, 7.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    counts, edges = np.histogram(values, bins=15)
    got = rows(ag.histogram(df, "x"), "bin", "lower", "n")
    assert [g[2] for g in got] == list(counts)
    assert [g[1] for g in got] == pytest.approx(list(edges[:-1]))
    flat = ag.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4)
    assert [g[0] for g in rows(flat, "n", "bin")] == [0, 0, 0, 2]


def test_iqr_both_ways(spark):
    values = [float(i) for i in range(1, 40)] + [500.0, -400.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    for daily_table in (True, False):
        got = rows(quality.iqr_outliers(df, daily=daily_table))
        assert got == [("x", low, high, 2)]


def test_quality_rows(spark):
    f = liquidity(spark)
    assert rows(quality.row_count(f, day(5)), "metric_value", "status") == [(6.0, "FAIL")]
    assert rows(quality.row_count(f, day(5), minimum=5, maximum=10), "status") == [("PASS",)]
    assert rows(quality.freshness(f, day(7)), "metric_value", "status") == [(2.0, "PASS")]
    assert rows(quality.freshness(f, day(8)), "status") == [("FAIL",)]
    got = dict(rows(quality.completeness(f, day(5)), "metric_name", "status"))
    assert got["completeness_oil_price_usd"] == "FAIL" and got["completeness_date"] == "PASS"
    nulls = {r[0]: r[1:] for r in rows(quality.null_profile(f))}
    assert nulls["oil_price_usd"] == (1, pytest.approx(100 / 6))
    assert rows(quality.negatives(spark.sql("SELECT -1 AS a, 2.0D AS b UNION ALL SELECT -2, 0"))) == [
        ("a", 2), ("b", 0)]
    dup = spark.sql("SELECT 1 AS k, 'a' AS s UNION ALL SELECT 1, 'a' UNION ALL SELECT NULL, 'b' "
                    "UNION ALL SELECT 2, 'c'")
    assert rows(quality.key_violations(dup, ["k", "s"])) == [(None, "b", 1), (1, "a", 2)]
    checks = rows(quality.monitoring(f, predictions(spark), hot_feed(spark), day(5)),
                  "metric_name", "status")
    assert [c[0] for c in checks] == ["mae_millions", "min_daily_records", "r_squared"]


def test_metrics(spark):
    y, p = [100.0, 110.0, 120.0, 130.0, 140.0], [105.0, 105.0, 125.0, 125.0, 145.0]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    (got,) = metrics.regression_metrics(df, "y", "p").collect()
    ya, pa = np.array(y), np.array(p)
    assert got["mae"] == pytest.approx(5.0) and got["rmse"] == pytest.approx(5.0)
    assert got["r2"] == pytest.approx(1 - ((ya - pa) ** 2).sum() / ((ya - ya.mean()) ** 2).sum())
    assert got["mape"] == pytest.approx(np.mean(np.abs((ya - pa) / ya)) * 100)
    flat = metrics.regression_metrics(df.withColumn("y", F.lit(0.0)), "y", "p").collect()[0]
    assert flat["r2"] is None and flat["mape"] is None


def test_views_null_branches(spark):
    f, p = liquidity(spark), predictions(spark)
    board = {r["date"]: r for r in views.daily_energy_dashboard(f, p).collect()}
    assert board[day(5)]["prediction_quality"] == "No Prediction"
    assert board[day(0)]["prediction_quality"] == "Accurate"
    series = views.liquidity_time_series(f, p, day(5)).collect()
    assert len(series) == 11
    impact = rows(views.economic_indicators_impact(f, day(5)), "date", "oil_price_category")
    assert [i[0] for i in impact] == [day(i) for i in range(5)]
    assert rows(views.executive_kpis(f, p, day(50))) == []  # no prediction ahead, no row
    (kpi,) = views.executive_kpis(f, p, day(4)).collect()
    assert kpi["current_model_version"] is None and kpi["total_records_30d"] == 6
    none = views.executive_kpis(f.filter("1 = 0"), p, day(4)).collect()[0]
    assert none["model_performance_status"] == "Needs Attention"
    status = {r["metric_category"]: r for r in views.current_status(f, p, day(6)).collect()}
    assert status["Latest Data"]["days_behind"] == 1
    assert status["Prediction Coverage"]["metric_value"] == 10
    risk = views.risk_analysis(f, p, day(5), max_liquidity=100, max_error=5, max_oil=70,
                               min_generation=50000)
    assert {r[0] for r in rows(risk, "overall_risk_level")} <= {"Low Risk", "Medium Risk", "High Risk"}
    assert rows(risk.filter(F.col("date") == day(0)), "total_risk_score") == [(1,), (2,)]


def test_pattern_needs_three_days(spark):
    gen, wx, *_ = raw_frames(spark)
    two = fl.restrict_to_dates(gen, spark.createDataFrame([(day(1),), (day(2),)], "date date"))
    assert rows(views.energy_weather_patterns(two, wx), "correlation") == [(None,)]


def test_sets(spark):
    a = spark.createDataFrame([(day(0),), (day(1),), (day(1),)], "date date")
    b = spark.createDataFrame([(day(1),), (day(2),)], "date date")
    assert rows(sets.date_intersection(a, b)) == [(day(1),)]
    assert rows(sets.date_union(a, b)) == [(day(0),), (day(1),), (day(2),)]
    assert rows(sets.concat([], like=a)) == [] and sets.concat([]) is None
    assert [r[0] for r in sets.last_dates(a.union(b), 2).collect()] == [day(2), day(1)]


def test_month_to_date_is_a_range(spark):
    df = spark.createDataFrame(
        [(dt.date(2025, 4, 30),), (dt.date(2025, 5, 1),), (dt.date(2025, 5, 31),),
         (dt.date(2025, 6, 1),), (None,)], "date date")
    assert rows(fl.month_of(df, dt.date(2025, 5, 15))) == [
        (dt.date(2025, 5, 1),), (dt.date(2025, 5, 31),)]


def test_weather_summary_and_lookup(spark):
    _, wx, *_ = raw_frames(spark)
    (got,) = ag.weather_summary(feats.weather_features(wx)).collect()
    assert got["total_periods"] == 14 and got["weather_conditions"] == {"Clear": 14}
    named = jn.lookup(wx.select("forecast").limit(2), "forecast", {"Rain": "wet"}, "label",
                      F.lit("other"))
    assert rows(named, "label") == [("other",), ("other",)]

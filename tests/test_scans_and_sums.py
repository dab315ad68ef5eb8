"""Fills of any feed by a prefix scan, and regressions from sums that merge."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from wattledger.operators import normal_equations as ne
from wattledger.operators import windows


def plain_fill(rows, forward, backward):
    out = [r["v"] for r in rows]
    if forward:
        last = None
        for i, v in enumerate(out):
            last = v if v is not None else last
            out[i] = last
    if backward:
        last = None
        for i in range(len(out) - 1, -1, -1):
            last = out[i] if out[i] is not None else last
            out[i] = last
    return out


@pytest.mark.parametrize("forward, backward", [(True, False), (False, True), (True, True)])
@pytest.mark.parametrize("keyed", [False, True])
def test_scan_fill(spark, forward, backward, keyed):
    r = np.random.default_rng(5)
    start = dt.date(2025, 1, 1)
    data = []
    for i in range(3000):  # one date and one key hold most rows; some dates and keys are null
        day = None if i % 97 == 0 else start + dt.timedelta(int(r.integers(0, 40)) if i % 3 else 7)
        key = None if i % 50 == 0 else "hot" if i % 4 else str(i % 7)
        data.append((i, day, key, float(i) if r.random() < 0.02 else None))
    frame = spark.createDataFrame(data, "n int, date date, k string, v double").repartition(5)
    got = windows.scan_fill(frame, ["v"], ["date", "n"], ["k"] if keyed else [], forward, backward)
    assert got.columns == frame.columns
    want = {}
    keys = {d[2] for d in data} if keyed else {None}
    for key in keys:
        own = [dict(zip(("n", "date", "k", "v"), d)) for d in data if not keyed or d[2] == key]
        own.sort(key=lambda x: (x["date"] is not None, x["date"] or start, x["n"]))
        want |= dict(zip((x["n"] for x in own), plain_fill(own, forward, backward)))
    assert {x["n"]: x["v"] for x in got.collect()} == want


def test_scan_fill_of_ties_and_ranges(spark, monkeypatch):
    sizes = []
    real = windows.materialize

    def stored(df, name):
        out = real(df, name)
        sizes.extend(x["n"] for x in out.groupBy(F.shiftright("_id", 33)).agg(F.count("*").alias("n")).collect())
        return out

    monkeypatch.setattr(windows, "materialize", stored)
    # All rows have one date: ties are ordered by the row, so any layout gives the same.
    frame = spark.range(20_000).select(
        F.lit(dt.date(2025, 1, 1)).alias("date"), "id", F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a, b = (windows.scan_fill(f, ["v"], ["date"]).collect() for f in (frame, frame.repartition(13)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(a) == sorted(b) and len(a) == 20_000
    assert max(sizes) < 20_000 / 8 * 1.8  # the one date is spread over all ranges
    empty = windows.scan_fill(frame.limit(0), ["v"], ["date"], backward=True)
    assert empty.count() == 0


@pytest.fixture(scope="module")
def sample(spark):
    r = np.random.default_rng(7)
    x = np.column_stack([75_000 + r.normal(0, 5_000, 400), 65 + r.normal(0, 10, 400), r.normal(0, 1e-3, 400)])
    y = x @ [0.002, 0.5, 300.0] + r.normal(0, 3, 400)
    rows = [(int(i % 9), *map(float, x[i]), float(y[i])) for i in range(400)] + [(0, None, 1.0, 1.0, 1.0), (1, 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "day int, a double, b double, c double, y double")


@pytest.mark.parametrize("alpha", [0.0, 2.5])
def test_merged_sums_give_the_fit(spark, sample, alpha):
    names = ["a", "b", "c"]
    whole = ne.fit(sample, names, "y", alpha)
    origin = {"a": 75_000.0, "b": 60.0, "y": 100.0}
    by_day = ne.moments(sample, names, "y", ["day"], origin)
    row = ne.merged(by_day).first().asDict()
    parts = ne.solve(row, names, "y", alpha, origin)
    assert row["n"] == 400
    assert np.allclose(parts.weights, whole.weights, rtol=1e-9) and parts.intercept == pytest.approx(whole.intercept, rel=1e-12)
    # Spark ML on the same standardised features.
    full = sample.dropna()
    scaled = full.select("y", *[((F.col(c) - float(m)) / float(s)).alias(c) for c, m, s in zip(names, whole.means, whole.deviations)])
    dev = full.agg(F.stddev_pop("y")).first()[0]
    model = LinearRegression(
        labelCol="y", featuresCol="x", regParam=alpha * dev / 400, elasticNetParam=0.0, standardization=False, solver="normal"
    ).fit(VectorAssembler(inputCols=names, outputCol="x").transform(scaled))
    assert np.allclose(model.coefficients.toArray(), whole.weights, rtol=1e-8, atol=1e-8 * max(abs(whole.weights)))
    got = full.select(whole.predicted().alias("p")).toPandas()["p"].to_numpy()
    x = full.select(*names).toPandas().to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    y = full.select("y").toPandas()["y"].to_numpy()
    w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(got, y.mean() + z @ w, rtol=1e-9)


def test_new_days_only_add(spark, sample):
    names = ["a", "b", "c"]
    old, new = sample.filter("day < 6"), sample.filter("day >= 6")
    kept = ne.moments(old, names, "y", ["day"]).union(ne.moments(new, names, "y", ["day"]))
    a = ne.solve(ne.merged(kept).first().asDict(), names, "y")
    b = ne.solve(ne.moments(sample, names, "y").first().asDict(), names, "y")
    assert np.allclose(a.weights, b.weights, rtol=1e-6)


def test_constant_feature_and_no_rows(spark):
    frame = spark.range(50).select(F.lit(3.3).alias("k"), F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("y"))
    found = ne.fit(frame, ["k", "a"], "y")
    assert found.weights[0] == 0 and frame.select(F.max(F.abs(found.predicted() - F.col("y")))).first()[0] < 1e-9
    with pytest.raises(ValueError, match="no complete rows"):
        ne.fit(frame.limit(0), ["k", "a"], "y")

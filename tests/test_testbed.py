"""The stand-in tables cover all rows of their sources."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from wattledger.testbed.standins import AS_OF, EVENT_SHIFT_DAYS, ORDER_SHIFT_DAYS, Tables

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_features_hold_all_line_items(spark):
    t = Tables(spark, FOLDER)
    want = t.source("lineitem").agg(F.sum(F.col("l_quantity") * 100)).collect()[0][0]
    got = t.features.agg(F.sum("total_generation_mwh"), F.max("date")).collect()[0]
    assert abs(got[0] - float(want)) < 1e-3 * float(want) / 1e6 and str(got[1]) == AS_OF


def test_economic_holds_all_orders(spark):
    t = Tables(spark, FOLDER)
    o = t.source("orders")
    days = o.select(F.col("o_orderdate").cast("date"), F.substring("o_orderpriority", 1, 1)).distinct()
    assert t.economic.count() == days.count()
    assert t.economic.filter("indicator is null").count() == 0


def test_drop_incomplete_covers_every_feature(spark, folder):
    day = dt.datetime(2001, 10, 30)
    priced = day + dt.timedelta(days=1)  # has both prices, but no weather
    ordered = [(i, float(1000 * i), d - dt.timedelta(days=ORDER_SHIFT_DAYS), f"{p}-X", "O")
               for i, (d, p) in enumerate([(day, 1), (day, 2), (day, 3), (priced, 1)], 1)]
    lines = [(i, i, 5.0, "N", "F", d) for i, d in enumerate([day, priced, priced + dt.timedelta(days=1)], 1)]
    seen = [(1, day + dt.timedelta(days=EVENT_SHIFT_DAYS, hours=9), 61.0, "view")]
    for name, made, columns in (
        ("orders", ordered, "o_orderkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string, o_orderstatus string"),
        ("lineitem", lines, "l_orderkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        ("events", seen, "event_id long, ts timestamp, value double, event_type string"),
    ):
        spark.createDataFrame(made, columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    got = entry_point.queries()["flt5_drop_incomplete"](spark, folder)
    assert set(Tables(spark, folder).features.columns) <= set(got.columns)
    assert sorted((r.required, str(r.date), None in tuple(r)) for r in got.collect()) == [
        ("all", "2001-10-30", False), ("prices", "2001-10-30", True), ("prices", "2001-10-31", True)]

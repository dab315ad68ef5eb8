"""Dates as bitmaps against plain sets, and checks that cost no scan of their own."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from wattledger.operators import calendars, joins, quality, sets

from .conftest import rows


def feeds(spark):
    r = random.Random(11)
    whole = [dt.date(1960, 1, 1) + dt.timedelta(i) for i in range(0, 40_000, 3)] + [dt.date(1969, 12, 31), dt.date(1970, 1, 1)]
    own = [[*r.sample(whole, 3000), None], [*r.sample(whole, 5000), None], [*r.sample(whole, 4000), None]]
    hot = whole[5]
    frames = [spark.createDataFrame([(d,) for d in [*o, *[hot] * 500]], "date date") for o in own]
    return [set(o) | {hot} for o in own], frames


def test_sets_of_dates(spark):
    own, frames = feeds(spark)
    got = sets.date_intersection(*frames).collect()
    assert len(got) == len(own[0] & own[1] & own[2]) and {x.date for x in got} == own[0] & own[1] & own[2]
    got = sets.date_union(*frames).collect()
    assert len(got) == len(own[0] | own[1] | own[2]) and {x.date for x in got} == own[0] | own[1] | own[2]
    found = joins.source_flags(dict(zip("abc", frames))).collect()
    want = {d: tuple(int(d in o) for o in own) for d in (own[0] | own[1] | own[2]) - {None}}
    assert {x.date: (x.a, x.b, x.c) for x in found} == want and len(found) == len(want)
    empty = frames[0].limit(0)
    assert sets.date_intersection(frames[0], empty).count() == 0 and calendars.union(empty).count() == 0


def test_one_small_aggregate(spark):
    _, frames = feeds(spark)
    plan = sets.date_intersection(*frames)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_watch_gives_the_rows_of_the_checks(spark, folder):
    day = F.date_sub(F.lit(dt.date(2025, 5, 23)), F.expr("cast(id as int)"))
    table = spark.range(50).select(
        day.alias("date"), F.when(F.col("id") % 3 > 0, F.col("id") - 20).alias("a"),
        F.when(F.col("id") % 20 > 0, F.col("id") * 1.5).cast("decimal(8,2)").alias("b"), F.lit("x").alias("word"))
    watch = quality.Watch(table, "2025-05-24")
    watch.frame.write.csv(f"{folder}/out")
    for name in ("row_count", "freshness", "completeness"):
        assert rows(getattr(watch, name)()) == rows(getattr(quality, name)(table, "2025-05-24")), name
    for name in ("null_profile", "negatives", "value_ranges"):
        one, other = getattr(watch, name)(), getattr(quality, name)(table)
        assert one.columns == other.columns and rows(one) == rows(other), name
    none = quality.Watch(table.limit(0), "2025-05-24")
    none.frame.write.csv(f"{folder}/none")
    assert rows(none.completeness()) == rows(quality.completeness(table.limit(0), "2025-05-24"))
    assert rows(none.freshness()) == rows(quality.freshness(table.limit(0), "2025-05-24"))

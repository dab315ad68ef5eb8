"""Features kept up by files: equal to a full rebuild, and reading no more than they must."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.plans import daily_run
from wattledger.plans import incremental_features as inc
from wattledger.sources import commits

from .conftest import rows

START = dt.date(2025, 1, 1)


def land(spark, store, first, days, salt=0):
    """Files of ``days`` dates from day ``first`` on in the four raw tables, several rows a date,
    some values null."""
    base = spark.range(first * 3, (first + days) * 3).select(
        F.date_add(F.lit(START), F.expr("cast(id div 3 as int)")).alias("date"), "id")
    odd = F.when(F.col("id") % 11 != salt, F.col("id") * 7 % 89 + salt)
    frames = {
        "raw_eia_data": base.select("date", F.lit("NG").alias("fuel_type"), (odd + 0.25).alias("generation_mwh")),
        "raw_weather_data": base.select("date", odd.cast("int").alias("temperature_f")),
        "raw_economic_data": base.select("date", F.when(F.col("id") % 2 == 0, "crude_oil_price_wti").otherwise("industrial_production_index").alias("indicator"), (odd * 1.01).alias("value")),
        "raw_price_data": base.select("date", F.lit("w").alias("price_type"), (odd / 3).alias("price_per_mwh")),
    }
    for name, frame in frames.items():
        schemas.select_typed(frame, name).coalesce(1).write.mode("append").parquet(f"{store}/{name}")


def same_as_rebuilt(spark, store, **weights):
    stored = daily_run.table(spark, store, "ml_features").drop("created_at")
    return rows(stored) == rows(daily_run.rebuild_features(spark, store, **weights).drop("created_at")) != []


@pytest.fixture
def reads(monkeypatch):
    """Names of the raw files read for states."""
    seen, real = [], commits.read

    def read(spark, table, schema, files=None):
        if "_states" not in table:
            seen.extend(files or ["all"])
        return real(spark, table, schema, files)

    monkeypatch.setattr(inc.commits, "read", read)
    return seen


def test_later_landings(spark, folder, reads):
    land(spark, folder, 0, 100)
    assert len(inc.refresh(spark, folder)) == 4 and len(reads) == 4
    assert same_as_rebuilt(spark, folder)
    old = {m: commits.names(spark, f"{folder}/ml_features/month=2025-0{m}-01") for m in (1, 2, 3, 4)}
    del reads[:]
    land(spark, folder, 35, 3, salt=5)  # more rows of known days in February
    land(spark, folder, 150, 2)
    assert inc.refresh(spark, folder) == [dt.date(2025, 2, 1), dt.date(2025, 5, 1), dt.date(2025, 6, 1)][: 2 + (START + dt.timedelta(151)).month - 5]
    assert len(reads) == 8 and "all" not in reads  # two new files a feed, none of the old ones
    new = {m: commits.names(spark, f"{folder}/ml_features/month=2025-0{m}-01") for m in old}
    assert [m for m in old if old[m] != new[m]] == [2]
    assert same_as_rebuilt(spark, folder)
    del reads[:]
    assert inc.refresh(spark, folder) == [] and reads == []


def test_other_weights_and_a_replaced_table(spark, folder, reads):
    land(spark, folder, 0, 40)
    inc.refresh(spark, folder)
    del reads[:]
    assert len(inc.refresh(spark, folder, oil_weight=9.0)) == 2 and reads == []  # from states alone
    assert same_as_rebuilt(spark, folder, oil_weight=9.0)
    kept = daily_run.table(spark, folder, "raw_weather_data").filter(F.col("date") < F.lit(dt.date(2025, 1, 10))).toArrow()
    spark.createDataFrame(kept).select(*[F.col(f.name).cast(f.dataType) for f in schemas.TABLES["raw_weather_data"]]).write.mode("overwrite").parquet(f"{folder}/raw_weather_data")
    inc.refresh(spark, folder, oil_weight=9.0)
    assert same_as_rebuilt(spark, folder, oil_weight=9.0)


@pytest.mark.parametrize("dies", ["decide", "finish"])
@pytest.mark.parametrize("call", [1, 3, 5])
def test_a_run_that_died_is_continued(spark, folder, monkeypatch, dies, call):
    land(spark, folder, 0, 3)
    inc.refresh(spark, folder)
    land(spark, folder, 40, 2)
    real, calls = getattr(commits, dies), []

    def crash(*args, **named):
        calls.append(1)
        if len(calls) == call:
            raise RuntimeError("crash")
        return real(*args, **named)

    with monkeypatch.context() as m:
        m.setattr(commits, dies, crash)
        with pytest.raises(RuntimeError, match="crash"):
            inc.refresh(spark, folder)
    inc.refresh(spark, folder)
    assert same_as_rebuilt(spark, folder)
    assert inc.refresh(spark, folder) == []

"""Queries over tables kept in date buckets; the same SQL as the plain ones."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattledger.operators import aggregates as ag
from wattledger.operators import joins as jn
from wattledger.plans import views
from wattledger.session import scratch_path
from wattledger.sources import by_date
from wattledger.testbed.q_aggregates import DASHBOARD_SQL
from wattledger.testbed.q_tables import CHAIN_SQL
from wattledger.testbed.registry import R, query

# At the smallest scale as well some dates of the events have more rows and some fewer.
BUCKETS, MOST = 8, 40


def kept(df: DataFrame, most: int | None = None) -> by_date.ByDate:
    folder = scratch_path(df.sparkSession, "by-date")
    by_date.append(df, folder, "all", BUCKETS, most)
    return by_date.read(df.sparkSession, folder, df.schema)


@query("vw1_dashboard_by_date", DASHBOARD_SQL)
def _(t):
    return views.daily_energy_dashboard(kept(t.features).cool, kept(t.predictions).cool)


@query("jn2_left_chain_by_date", CHAIN_SQL)
def _(t):
    daily = [
        ag.daily_generation(t.generation),
        ag.daily_weather(t.weather).drop("avg_wind_speed"),
        ag.daily_price(t.price),
    ]
    return jn.left_chain(*[kept(d).cool for d in daily])


@query(
    "jn8_feature_observations_by_date",
    f"SELECT date, {R('total_generation_mwh')} AS total_generation_mwh, obs_id, wind_speed, forecast "
    "FROM feat LEFT JOIN obs USING (date)",
)
def _(t):
    feed = kept(t.observations.select("date", "obs_id", "wind_speed", "forecast"), MOST)
    daily = kept(t.features.select("date", "total_generation_mwh")).cool
    return jn.left_join_parts(daily, feed.cool, feed.hot)

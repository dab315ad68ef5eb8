"""The domain's tables, derived from the generic order/event tables.

Values are integers or hundredths computed in whole numbers, so that any engine gets the
same doubles. Every table covers all rows of its source.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import scalars
from wattledger.plans import features as feats
from wattledger.session import materialize

# Last day of the data. Events and orders are moved by whole days so that they end there too.
AS_OF = "2001-11-04"
EVENT_SHIFT_DAYS = 8122
ORDER_SHIFT_DAYS = 95
GENERATION_WEIGHT = 0.0005
OIL_WEIGHT = 0.5

FORECASTS = {
    "view": "Sunny",
    "click": "Partly Cloudy",
    "purchase": "Cloudy",
    "signup": "Rain Showers",
    "error": "Fog",
}
SERIES_OF_PRIORITY = {"1": "DCOILWTICO", "2": "INDPRO", "3": "CAUR", "4": "GASREGW"}
# The fifth priority stands for a series that the pivots do not know.
INDICATOR_OF_PRIORITY = {
    "1": "crude_oil_price_wti",
    "2": "industrial_production_index",
    "3": "california_unemployment_rate",
    "4": "gasoline_price_regular",
    "5": "housing_starts",
}
# Hundredths at zero and order value (in hundredths of a dollar) per hundredth, by priority.
INDICATOR_SCALE = {
    "1": (4000, 10000),
    "2": (9000, 25000),
    "3": (200, 80000),
    "4": (200, 250000),
    "5": (100, 50000),
}


def choose(c: Column, table: dict[str, str]) -> Column:
    chain = None
    for key, value in table.items():
        chain = F.when(c == key, value) if chain is None else chain.when(c == key, value)
    return chain


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


class Tables:
    """Lazy stand-in tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    @cached_property
    def readings(self) -> DataFrame:
        """One generation reading per line item."""
        li = self.source("lineitem")
        ret, status = F.col("l_returnflag"), F.col("l_linestatus")
        fuel = (
            F.when((ret == "N") & (status == "F"), "WAT")
            .when((ret == "N") & (status == "O"), "WND")
            .when(status == "F", "NG")
            .otherwise("SUN")
        )
        return li.select(
            F.col("l_shipdate").cast("date").alias("date"),
            fuel.alias("fuel_type"),
            (F.col("l_quantity") * 100).alias("generation_mwh"),
            F.when(F.col("l_suppkey") % 10 == 0, "TEX").otherwise("CAL").alias("respondent"),
        )

    @cached_property
    def generation(self) -> DataFrame:
        return self.readings.groupBy("date", "fuel_type").agg(
            F.sum("generation_mwh").alias("generation_mwh")
        )

    @cached_property
    def observations(self) -> DataFrame:
        """One weather observation per event."""
        e = self.source("events")
        day = F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT_DAYS)
        return e.select(
            F.col("event_id").alias("obs_id"),
            day.alias("date"),
            F.when(F.hour("ts") < 12, "Day").otherwise("Night").alias("period"),
            F.col("value").alias("temperature_f"),
            (F.col("event_id") % 60).cast("int").alias("wind_speed"),
            choose(F.col("event_type"), FORECASTS).alias("forecast"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """Two forecast periods a day."""
        grouped = self.observations.groupBy("date", "period").agg(
            F.sum(cents(F.col("temperature_f"))).alias("s"),
            F.count(F.lit(1)).alias("n"),
            F.max("obs_id").alias("last_id"),
            F.max_by("forecast", "obs_id").alias("forecast"),
        )
        base = F.lit(30.0) + F.col("s").cast("double") / (F.col("n") * 200)
        warm = F.when(F.col("period") == "Day", 10).otherwise(0)
        return grouped.select(
            "date",
            "period",
            F.floor(base + (F.dayofmonth("date") % 7) * 5 + warm + F.lit(0.5))
            .cast("int")
            .alias("temperature_f"),
            (F.col("last_id") % 31).cast("int").alias("wind_speed"),
            "forecast",
        )

    @cached_property
    def economic(self) -> DataFrame:
        grouped = self.source("orders").groupBy(
            F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT_DAYS).alias("date"),
            F.substring("o_orderpriority", 1, 1).alias("p"),
        ).agg(F.max(cents(F.col("o_totalprice"))).alias("v"))
        value = None
        for p, (zero, step) in INDICATOR_SCALE.items():
            hundredths = F.lit(zero) + F.floor(F.col("v") / step)
            cond = F.col("p") == p
            value = F.when(cond, hundredths) if value is None else value.when(cond, hundredths)
        return grouped.select(
            "date",
            choose(F.col("p"), INDICATOR_OF_PRIORITY).alias("indicator"),
            (value.cast("double") / 100).alias("value"),
        )

    @cached_property
    def price(self) -> DataFrame:
        grouped = self.source("orders").groupBy(
            F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT_DAYS).alias("date"),
            F.concat(F.lit("M"), "o_orderstatus").alias("market"),
        ).agg(F.sum(cents(F.col("o_totalprice"))).alias("s"), F.count(F.lit(1)).alias("n"))
        return grouped.select(
            "date",
            F.lit("wholesale_electricity").alias("price_type"),
            (F.floor(F.col("s") / (F.col("n") * 5000)).cast("double") / 100).alias(
                "price_per_mwh"
            ),
            "market",
        )

    @property
    def raw(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.generation, self.weather, self.economic, self.price

    def _features(self, build) -> DataFrame:
        return build(
            *self.raw,
            noise=scalars.noise_from_date(F.col("date"), 0, 150),
            generation_weight=GENERATION_WEIGHT,
            oil_weight=OIL_WEIGHT,
        )

    @cached_property
    def features(self) -> DataFrame:
        return self._features(feats.ml_features)

    def with_stored_features(self) -> Tables:
        """The same tables with the features written first, as the daily run has them."""
        other = Tables(self.spark, self.folder)
        other.features = materialize(self.features, "features")
        return other

    @cached_property
    def features_fan_out(self) -> DataFrame:
        return self._features(feats.ml_features_fan_out)

    @cached_property
    def predictions(self) -> DataFrame:
        """Two model versions over the past, one over the seven days ahead."""
        ed = scalars.epoch_day(F.col("date"))
        actual = F.col("liquidity_need_millions")

        def version(name, keep, value, hour):
            return F.when(
                keep,
                F.struct(
                    value.alias("predicted_liquidity_millions"),
                    F.lit(name).alias("model_version"),
                    (
                        F.col("date").cast("timestamp") + F.expr(f"interval {hour} hours")
                    ).alias("prediction_timestamp"),
                ),
            )

        versions = F.array(
            version("v1", ed % 7 != 0, actual + ((ed * 31) % 121 - 60), 6),
            version("v2", ed % 2 == 0, actual + ((ed * 17) % 41 - 20), 7),
        )
        past = (
            self.features.select("date", F.explode(versions).alias("p"))
            .filter(F.col("p").isNotNull())
            .select("date", "p.*")
        )
        day = scalars.as_date(AS_OF)
        ahead = (
            self.spark.range(1, 8)
            .select(F.date_add(day, F.col("id").cast("int")).alias("date"))
            .select(
                "date",
                (F.lit(150) + (ed % 41 - 20)).cast("double").alias("predicted_liquidity_millions"),
                F.lit("v2").alias("model_version"),
                (day.cast("timestamp") + F.expr("interval 8 hours")).alias(
                    "prediction_timestamp"
                ),
            )
        )
        return past.unionByName(ahead)


# The same tables as common table expressions, in dependency order.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": (
        (),
        """SELECT CAST(l_shipdate AS DATE) AS date,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'WAT'
       WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'WND'
       WHEN l_linestatus = 'F' THEN 'NG' ELSE 'SUN' END AS fuel_type,
  l_quantity * 100 AS generation_mwh,
  CASE WHEN l_suppkey % 10 = 0 THEN 'TEX' ELSE 'CAL' END AS respondent
FROM lineitem""",
    ),
    "gen": (
        ("readings",),
        "SELECT date, fuel_type, sum(generation_mwh) AS generation_mwh FROM readings "
        "GROUP BY date, fuel_type",
    ),
    "obs": (
        (),
        f"""SELECT event_id AS obs_id, CAST(ts AS DATE) - {EVENT_SHIFT_DAYS} AS date,
  CASE WHEN hour(ts) < 12 THEN 'Day' ELSE 'Night' END AS period,
  value AS temperature_f, CAST(event_id % 60 AS INTEGER) AS wind_speed,
  CASE event_type WHEN 'view' THEN 'Sunny' WHEN 'click' THEN 'Partly Cloudy'
    WHEN 'purchase' THEN 'Cloudy' WHEN 'signup' THEN 'Rain Showers'
    WHEN 'error' THEN 'Fog' END AS forecast
FROM events""",
    ),
    "wx": (
        ("obs",),
        """SELECT date, period,
  CAST(floor(CAST(30 AS DOUBLE) + CAST(s AS DOUBLE) / (n * 200) + (day(date) % 7) * 5
    + CASE WHEN period = 'Day' THEN 10 ELSE 0 END + CAST(0.5 AS DOUBLE)) AS INTEGER)
    AS temperature_f,
  CAST(last_id % 31 AS INTEGER) AS wind_speed, forecast
FROM (SELECT date, period,
        CAST(sum(CAST(round(temperature_f * 100) AS BIGINT)) AS BIGINT) AS s,
        count(*) AS n, max(obs_id) AS last_id, arg_max(forecast, obs_id) AS forecast
      FROM obs GROUP BY date, period)""",
    ),
    "econ": (
        (),
        f"""SELECT date,
  CASE p WHEN '1' THEN 'crude_oil_price_wti' WHEN '2' THEN 'industrial_production_index'
    WHEN '3' THEN 'california_unemployment_rate' WHEN '4' THEN 'gasoline_price_regular'
    WHEN '5' THEN 'housing_starts' END
    AS indicator,
  CAST(CASE p WHEN '1' THEN 4000 + v // 10000 WHEN '2' THEN 9000 + v // 25000
    WHEN '3' THEN 200 + v // 80000 WHEN '4' THEN 200 + v // 250000
    WHEN '5' THEN 100 + v // 50000 END AS DOUBLE) / 100
    AS value
FROM (SELECT CAST(o_orderdate AS DATE) + {ORDER_SHIFT_DAYS} AS date,
        substr(o_orderpriority, 1, 1) AS p,
        max(CAST(round(o_totalprice * 100) AS BIGINT)) AS v
      FROM orders GROUP BY ALL)""",
    ),
    "price": (
        (),
        f"""SELECT date, 'wholesale_electricity' AS price_type,
  CAST(s // (n * 5000) AS DOUBLE) / 100 AS price_per_mwh, market
FROM (SELECT CAST(o_orderdate AS DATE) + {ORDER_SHIFT_DAYS} AS date, 'M' || o_orderstatus AS market,
        CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS s, count(*) AS n
      FROM orders GROUP BY ALL)""",
    ),
    "feat": (
        ("gen", "wx", "econ", "price"),
        """SELECT g.date, g.total_generation_mwh, w.avg_temperature_f, e.oil_price_usd,
  e.industrial_production_index, e.ca_unemployment_rate, p.avg_electricity_price,
  g.total_generation_mwh * 5e-4 + coalesce(e.oil_price_usd, 50) * 5e-1
    + (date_diff('day', DATE '1970-01-01', g.date) * 7919) % 151 AS liquidity_need_millions
FROM (SELECT date, sum(generation_mwh) AS total_generation_mwh FROM gen GROUP BY date) g
LEFT JOIN (SELECT date, avg(temperature_f) AS avg_temperature_f FROM wx GROUP BY date) w
  ON g.date = w.date
LEFT JOIN (SELECT date,
    max(CASE WHEN indicator = 'crude_oil_price_wti' THEN value END) AS oil_price_usd,
    max(CASE WHEN indicator = 'industrial_production_index' THEN value END)
      AS industrial_production_index,
    max(CASE WHEN indicator = 'california_unemployment_rate' THEN value END)
      AS ca_unemployment_rate
  FROM econ GROUP BY date) e ON g.date = e.date
LEFT JOIN (SELECT date, avg(price_per_mwh) AS avg_electricity_price FROM price GROUP BY date) p
  ON g.date = p.date""",
    ),
    "pred": (
        ("feat",),
        f"""SELECT date, liquidity_need_millions + ((ed * 31) % 121 - 60)
    AS predicted_liquidity_millions, 'v1' AS model_version,
  CAST(date AS TIMESTAMP) + INTERVAL 6 HOUR AS prediction_timestamp
FROM (SELECT *, date_diff('day', DATE '1970-01-01', date) AS ed FROM feat) WHERE ed % 7 <> 0
UNION ALL
SELECT date, liquidity_need_millions + ((ed * 17) % 41 - 20), 'v2',
  CAST(date AS TIMESTAMP) + INTERVAL 7 HOUR
FROM (SELECT *, date_diff('day', DATE '1970-01-01', date) AS ed FROM feat) WHERE ed % 2 = 0
UNION ALL
SELECT date, CAST(150 + (date_diff('day', DATE '1970-01-01', date) % 41 - 20) AS DOUBLE), 'v2',
  CAST(DATE '{AS_OF}' AS TIMESTAMP) + INTERVAL 8 HOUR
FROM (SELECT DATE '{AS_OF}' + CAST(i AS INTEGER) AS date FROM range(1, 8) r(i))""",
    ),
}


def with_tables(body: str, *needed: str) -> str:
    """``body`` prefixed by the table expressions it needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {head}\n{body}"

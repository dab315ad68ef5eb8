"""Feature tables built from the raw feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger import settings as cfg
from wattledger.functions import buckets, scalars
from wattledger.operators import aggregates, joins

ML_COLUMNS = [
    "date",
    "total_generation_mwh",
    "avg_temperature_f",
    "oil_price_usd",
    "industrial_production_index",
    "ca_unemployment_rate",
    "avg_electricity_price",
    "liquidity_need_millions",
]


def _with_target(
    df: DataFrame,
    noise: Column | None,
    generation_weight: float,
    oil_weight: float,
    default_oil: float,
) -> DataFrame:
    drawn = noise if noise is not None else scalars.noise_from_date(
        F.col("date"), cfg.NOISE_LOW, cfg.NOISE_HIGH
    )
    target = scalars.liquidity_need(
        F.col("total_generation_mwh"),
        F.col("oil_price_usd"),
        drawn,
        generation_weight,
        oil_weight,
        default_oil,
    )
    return df.withColumn("liquidity_need_millions", target).select(*ML_COLUMNS)


def ml_features(
    generation: DataFrame,
    weather: DataFrame,
    economic: DataFrame,
    price: DataFrame,
    noise: Column | None = None,
    generation_weight: float = cfg.GENERATION_WEIGHT,
    oil_weight: float = cfg.OIL_WEIGHT,
    default_oil: float = cfg.DEFAULT_OIL_PRICE,
    positive_only: bool = False,
) -> DataFrame:
    """One row per generation date, every source aggregated before the joins (default).

    ``noise`` defaults to a repeatable function of the date; pass
    ``scalars.noise_random(…)`` for a draw. ``positive_only`` also drops days without any
    generation, as the warehouse statement does.
    """
    gen = aggregates.daily_generation(generation.filter(F.col("date").isNotNull()))
    if positive_only:
        gen = gen.filter(F.col("total_generation_mwh") > 0)
    return assembled(
        gen,
        aggregates.daily_weather(weather).select("date", "avg_temperature_f"),
        aggregates.indicators_first(economic),
        aggregates.daily_price(price),
        noise,
        generation_weight,
        oil_weight,
        default_oil,
    )


def assembled(
    generation: DataFrame,
    weather: DataFrame,
    indicators: DataFrame,
    price: DataFrame,
    noise: Column | None = None,
    generation_weight: float = cfg.GENERATION_WEIGHT,
    oil_weight: float = cfg.OIL_WEIGHT,
    default_oil: float = cfg.DEFAULT_OIL_PRICE,
) -> DataFrame:
    """Feature rows of daily tables (one row per date each), for every date with generation."""
    joined = joins.left_chain(generation, weather, indicators, price)
    return _with_target(joined, noise, generation_weight, oil_weight, default_oil)


def ml_features_fan_out(
    generation: DataFrame,
    weather: DataFrame,
    economic: DataFrame,
    price: DataFrame,
    noise: Column | None = None,
    generation_weight: float = cfg.GENERATION_WEIGHT,
    oil_weight: float = cfg.OIL_WEIGHT,
    default_oil: float = cfg.DEFAULT_OIL_PRICE,
) -> DataFrame:
    """Feature table as the warehouse statement defines it: raw rows joined before SUM.

    The generation total is therefore multiplied by the weather × indicator × price rows of
    its date. Kept for fidelity; :func:`ml_features` has the plain totals.
    """
    joined = joins.fan_out_join(generation, weather, economic, price)
    total = (F.col("generation_mwh") * F.col("copies")).alias("total_generation_mwh")
    wide = joined.select(
        "date",
        total,
        "avg_temperature_f",
        *cfg.INDICATOR_COLUMNS.values(),
        "avg_electricity_price",
    ).filter(F.col("total_generation_mwh") > 0)
    return _with_target(wide, noise, generation_weight, oil_weight, default_oil)


def generation_features(
    generation: DataFrame,
    fuels: Sequence[str] = tuple(cfg.FUELS),
    renewable: Sequence[str] = tuple(cfg.RENEWABLE_FUELS),
) -> DataFrame:
    """Total, one column per fuel and renewable percentage per date, in one aggregate."""
    part = F.sum(F.when(F.col("fuel_type").isin(*renewable), F.col("generation_mwh")))
    wide = generation.groupBy("date").agg(
        F.sum("generation_mwh").cast("double").alias("total_generation_mwh"),
        *aggregates.fuel_sums(fuels),
        F.coalesce(part.cast("double"), F.lit(0.0)).alias("_renewable"),
    )
    return wide.withColumn(
        "renewable_percentage",
        scalars.share_pct(F.col("_renewable"), F.col("total_generation_mwh")),
    ).drop("_renewable")


def weather_features(weather: DataFrame) -> DataFrame:
    """Adds categories, degree days and potential indexes to forecast rows.

    ``wind_speed`` may be a number or a text such as "9 to 14 mph".
    """
    wind = F.col("wind_speed")
    if weather.schema["wind_speed"].dataType.typeName() == "string":
        wind = scalars.first_number(wind)
    t = F.col("temperature_f")
    return (
        weather.withColumn("temperature_f", t.cast("double"))
        .withColumn("wind_speed_mph", wind.cast("double"))
        .withColumns(
            {
                "temp_category": buckets.temp_bin(t),
                "wind_category": buckets.wind_bin(F.col("wind_speed_mph")),
                "weather_simple": buckets.weather_simple(F.col("forecast")),
                "cooling_degree_days": scalars.cooling_degree_days(t),
                "heating_degree_days": scalars.heating_degree_days(t),
                "wind_potential_index": scalars.wind_potential_index(F.col("wind_speed_mph")),
            }
        )
        .withColumn("solar_potential_index", buckets.solar_potential_index(F.col("weather_simple")))
    )


WEATHER_EXPORT = [
    "date",
    "temperature_f",
    "wind_speed_mph",
    "cooling_degree_days",
    "heating_degree_days",
    "solar_potential_index",
    "wind_potential_index",
    "weather_simple",
]


def weather_export(weather: DataFrame) -> DataFrame:
    return weather_features(weather).select(*WEATHER_EXPORT)


def energy_factors(weather: DataFrame) -> DataFrame:
    """Adds solar potential, wind potential and demand factor."""
    wind = F.col("wind_speed")
    if weather.schema["wind_speed"].dataType.typeName() == "string":
        wind = scalars.first_number(wind)
    return weather.withColumns(
        {
            "solar_potential": buckets.solar_potential(F.col("forecast")),
            "wind_potential": buckets.wind_potential(wind),
            "demand_factor": buckets.demand_factor(F.col("temperature_f")),
        }
    )


def synchronized_training_data(
    generation: DataFrame, weather: DataFrame, economic: DataFrame
) -> dict[str, DataFrame]:
    return joins.synchronize(generation, weather, economic)

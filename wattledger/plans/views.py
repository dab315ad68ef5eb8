"""Reporting views. Each is a lazy DataFrame; sort at read time with ``sets.newest_first``.

``as_of`` stands for today. Cuts and windows are parameters with the reporting defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions import buckets, scalars
from wattledger.operators import aggregates, filters, joins, sets, windows

LIQ = "liquidity_need_millions"
PRED = "predicted_liquidity_millions"


def _error():
    return scalars.absolute_error(F.col(LIQ), F.col(PRED))


def daily_energy_dashboard(features: DataFrame, predictions: DataFrame, cuts=(10, 25)) -> DataFrame:
    """Feature days with the newest prediction of the day, its error and quality label."""
    joined = joins.join_latest_prediction(features, predictions)
    return joined.select(
        "date",
        "total_generation_mwh",
        "avg_temperature_f",
        "avg_electricity_price",
        F.col(LIQ).alias("actual_liquidity"),
        PRED,
        _error().alias("prediction_error_millions"),
        buckets.prediction_quality(F.col(PRED), _error(), cuts).alias("prediction_quality"),
    )


def weekly_summary(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Weekly means over the dashboard days that have a prediction.

    Only those days count, so the dashboard's unmatched part is not needed and the join to
    the newest prediction is a plain inner one.
    """
    latest = joins.latest_version_per_date(predictions)
    current = predictions.join(latest, ["date", "model_version"], "left_semi")
    days = features.join(current, "date", "inner").filter(F.col(PRED).isNotNull())
    return aggregates.weekly_summary(days.withColumnRenamed(LIQ, "actual_liquidity"))


def current_status(features: DataFrame, predictions: DataFrame, as_of) -> DataFrame:
    return sets.current_status(features, predictions, as_of)


def executive_kpis(features: DataFrame, predictions: DataFrame, as_of) -> DataFrame:
    """One row of headline figures; no row when there is no prediction from ``as_of`` on."""
    base = sets.next_prediction(predictions, as_of).select(
        "prediction_date",
        F.col(PRED).alias("next_day_liquidity_forecast"),
        F.col("model_version").alias("current_model_version"),
    )
    accuracy = aggregates.recent_accuracy(features, predictions, as_of).select(
        F.col("avg_error").alias("recent_prediction_error_millions"),
        F.col("prediction_count").alias("recent_predictions_evaluated"),
    )
    row = joins.attach_single_rows(base, aggregates.latest_and_volume(features, as_of), accuracy)
    return row.select(
        "latest_data_date",
        "total_records_30d",
        "prediction_date",
        "next_day_liquidity_forecast",
        "current_model_version",
        "recent_prediction_error_millions",
        "recent_predictions_evaluated",
        buckets.performance_status(F.col("recent_prediction_error_millions")).alias(
            "model_performance_status"
        ),
    )


def liquidity_time_series(
    features: DataFrame, predictions: DataFrame, as_of, days: int = 90, cuts=(100, 200)
) -> DataFrame:
    """Actual against every model version's prediction, with accuracy and risk labels."""
    joined = joins.join_all_predictions(filters.look_back(features, as_of, days), predictions)
    return joined.select(
        "date",
        F.col(LIQ).alias("actual_liquidity"),
        F.col(PRED).alias("predicted_liquidity"),
        _error().alias("prediction_error"),
        "total_generation_mwh",
        "avg_temperature_f",
        "oil_price_usd",
        "avg_electricity_price",
        "model_version",
        buckets.accuracy_category(F.col(PRED), _error()).alias("accuracy_category"),
        buckets.risk_level(F.col(LIQ), cuts).alias("risk_level"),
    )


def daily_generation_by_fuel(generation: DataFrame, as_of, days: int = 60) -> DataFrame:
    recent = filters.look_back(generation, as_of, days)
    return windows.share_of_day(
        recent, "fuel_type", "generation_mwh", "total_generation_mwh", "generation_percentage"
    )


def weather_energy_correlation(
    features: DataFrame, weather: DataFrame, as_of, days: int = 60
) -> DataFrame:
    """Feature days × their forecast periods, with temperature and generation labels."""
    periods = weather.select("date", "wind_speed", "forecast")
    joined = joins.left_join_feed(filters.look_back(features, as_of, days), periods)
    return joined.select(
        "date",
        "avg_temperature_f",
        "total_generation_mwh",
        LIQ,
        "wind_speed",
        "forecast",
        buckets.temperature_category(F.col("avg_temperature_f")).alias("temperature_category"),
        buckets.generation_level(F.col("total_generation_mwh")).alias("generation_level"),
    )


def economic_indicators_impact(features: DataFrame, as_of, days: int = 90) -> DataFrame:
    recent = filters.require(
        filters.look_back(features, as_of, days), ["oil_price_usd", "ca_unemployment_rate"]
    )
    return recent.select(
        "date",
        LIQ,
        "oil_price_usd",
        "industrial_production_index",
        "ca_unemployment_rate",
        buckets.oil_price_category(F.col("oil_price_usd")).alias("oil_price_category"),
        buckets.unemployment_category(F.col("ca_unemployment_rate")).alias(
            "unemployment_category"
        ),
    )


def daily_errors(features: DataFrame, predictions: DataFrame, as_of, days: int = 60) -> DataFrame:
    joined = joins.join_evaluated(filters.look_back(features, as_of, days), predictions)
    return joined.select(
        "date",
        "model_version",
        _error().alias("absolute_error"),
        scalars.percentage_error(F.col(LIQ), F.col(PRED)).alias("percentage_error"),
        F.col(LIQ).alias("actual_value"),
        F.col(PRED).alias("predicted_value"),
    )


def model_performance_trend(
    features: DataFrame, predictions: DataFrame, as_of, days: int = 60
) -> DataFrame:
    weekly = aggregates.weekly_model_errors(daily_errors(features, predictions, as_of, days))
    return weekly.withColumn(
        "performance_rating", buckets.performance_rating(F.col("avg_mae"))
    )


def risk_analysis(
    features: DataFrame, predictions: DataFrame, as_of, days: int = 90, **limits
) -> DataFrame:
    """Four risk flags per evaluated prediction, their sum and an overall level.

    Reads the evaluated rows only, so it starts from the inner join.
    """
    joined = joins.join_evaluated(filters.look_back(features, as_of, days), predictions)
    flags = buckets.risk_flags(
        F.col(LIQ), F.col("prediction_error"), F.col("oil_price_usd"),
        F.col("total_generation_mwh"), **limits,
    )
    flagged = (
        joined.filter(F.col(PRED).isNotNull())
        .withColumn("prediction_error", _error())
        .withColumns(flags)
    )
    score = F.lit(0)
    for name in flags:
        score = score + F.col(name)
    return flagged.withColumn("total_risk_score", score).select(
        "date",
        LIQ,
        PRED,
        "prediction_error",
        "total_risk_score",
        buckets.overall_risk(F.col("total_risk_score")).alias("overall_risk_level"),
        *flags,
    )


def current_month_summary(features: DataFrame, as_of) -> DataFrame:
    return aggregates.month_summary(features, as_of)


def current_model_performance(features: DataFrame, predictions: DataFrame) -> DataFrame:
    current = joins.restrict_to_latest_model(predictions)
    return aggregates.model_stats(features, current).withColumn(
        "performance_grade", buckets.performance_grade(F.col("mae"))
    )


def energy_weather_patterns(generation: DataFrame, weather: DataFrame, least: int = 3) -> DataFrame:
    """One row: joined days and their correlation, null below ``least`` days."""
    days = F.count(F.lit(1))
    return joins.join_daily_weather(generation, weather).agg(
        days.alias("days"),
        F.when(days >= least, F.corr("generation_mwh", "temperature_f")).alias("correlation"),
    )

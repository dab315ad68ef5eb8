"""Labelled bucketings. Unless stated, null values take the last (``otherwise``) label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.functions.scalars import contains_any
from wattledger.settings import RENEWABLE_FUELS

# The labels and cuts below are those that reports and results are compared by.


def ladder(value: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for the first cut with value ≤ cuts[i], else the last label."""
    chain = None
    for cut, label in zip(cuts, labels):
        cond = value <= F.lit(cut)
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    return chain.otherwise(labels[len(cuts)])


def bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals (edges[i], edges[i+1]]; null outside all of them."""
    chain = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        cond = (value > F.lit(lo)) & (value <= F.lit(hi))
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    return chain


def prediction_quality(predicted: Column, error: Column, cuts=(10, 25)) -> Column:
    return F.when(predicted.isNull(), "No Prediction").otherwise(
        ladder(error, cuts, ["Accurate", "Acceptable", "Poor"])
    )


def accuracy_category(predicted: Column, error: Column, cuts=(10, 25)) -> Column:
    return F.when(predicted.isNull(), "No Prediction").otherwise(
        ladder(error, cuts, ["High Accuracy", "Medium Accuracy", "Low Accuracy"])
    )


def risk_level(liquidity: Column, cuts=(100, 200)) -> Column:
    return ladder(liquidity, cuts, ["Low Risk", "Medium Risk", "High Risk"])


def performance_status(avg_error: Column, cuts=(10, 25, 50)) -> Column:
    return ladder(avg_error, cuts, ["Excellent", "Good", "Acceptable", "Needs Attention"])


def temperature_category(t: Column, cuts=(60, 75, 85)) -> Column:
    labels = ["Cool (≤60°F)", "Mild (61-75°F)", "Warm (76-85°F)", "Hot (>85°F)"]
    return ladder(t, cuts, labels)


def generation_level(g: Column, cuts=(50000, 100000)) -> Column:
    return ladder(g, cuts, ["Low Generation", "Medium Generation", "High Generation"])


def oil_price_category(p: Column, cuts=(60, 80)) -> Column:
    return ladder(p, cuts, ["Low Oil Price", "Medium Oil Price", "High Oil Price"])


def unemployment_category(u: Column, cuts=(4, 6)) -> Column:
    return ladder(u, cuts, ["Low Unemployment", "Medium Unemployment", "High Unemployment"])


def performance_rating(mae: Column, cuts=(15, 30, 50)) -> Column:
    return ladder(mae, cuts, ["Excellent", "Good", "Acceptable", "Poor"])


def performance_grade(mae: Column, cuts=(15, 30, 50)) -> Column:
    return ladder(mae, cuts, ["Excellent", "Good", "Acceptable", "Needs Improvement"])


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(cond, 1).otherwise(0)


def risk_flags(
    liquidity: Column,
    error: Column,
    oil: Column,
    generation: Column,
    max_liquidity=200,
    max_error=50,
    max_oil=80,
    min_generation=50000,
) -> dict[str, Column]:
    return {
        "high_liquidity_risk": flag(liquidity > max_liquidity),
        "high_prediction_risk": flag(error > max_error),
        "oil_price_risk": flag(oil > max_oil),
        "low_generation_risk": flag(generation < min_generation),
    }


def overall_risk(score: Column) -> Column:
    return F.when(score == 0, "Low Risk").when(score <= 2, "Medium Risk").otherwise("High Risk")


def pass_fail(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def renewable_class(fuel: Column, renewable: Sequence[str] = tuple(RENEWABLE_FUELS)) -> Column:
    return F.when(fuel.isin(*renewable), "Renewable").otherwise("Non-Renewable")


def solar_potential(forecast: Column) -> Column:
    low = F.lower(forecast)
    return (
        F.when(contains_any(forecast, ["sunny", "clear"]), "High")
        .when(low.contains("partly") & low.contains("cloud"), "Medium")
        .otherwise("Low")
    )


def wind_potential(w: Column) -> Column:
    return F.when(w >= 15, "High").when(w >= 8, "Medium").otherwise("Low")


def demand_factor(t: Column) -> Column:
    return F.when(t >= 80, "High Cooling").when(t <= 60, "High Heating").otherwise("Moderate")


def temp_bin(t: Column) -> Column:
    return bins(t, [0, 60, 75, 85, 100], ["Cold", "Mild", "Warm", "Hot"])


def wind_bin(w: Column) -> Column:
    return bins(w, [0, 5, 15, 25, 50], ["Calm", "Light", "Moderate", "Strong"])


def weather_simple(forecast: Column) -> Column:
    """First matching word group wins, so "Mostly Cloudy" reads Partly Cloudy."""
    return (
        F.when(contains_any(forecast, ["sunny", "clear"]), "Clear")
        .when(contains_any(forecast, ["partly", "mostly"]), "Partly Cloudy")
        .when(contains_any(forecast, ["cloud"]), "Cloudy")
        .when(contains_any(forecast, ["rain", "shower", "storm"]), "Rainy")
        .otherwise("Other")
    )


def solar_potential_index(simple: Column) -> Column:
    return (
        F.when(simple == "Clear", 1.0)
        .when(simple == "Partly Cloudy", 0.7)
        .when(simple == "Cloudy", 0.3)
        .otherwise(0.1)
    )

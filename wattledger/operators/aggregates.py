"""Grouped and global aggregates over the energy, weather, economic and feature tables.

Pivots are written as conditional aggregates over a fixed label list: one shuffle, map-side
combined, and the output schema does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import buckets, scalars
from wattledger.functions.rounding import round_product
from wattledger.operators import filters, joins, quantiles
from wattledger.settings import DAY_NAMES, FUELS, INDICATOR_COLUMNS, RENEWABLE_FUELS

GEN = "generation_mwh"


def _count() -> Column:
    return F.count(F.lit(1))


def _dbl(c: Column, name: str) -> Column:
    return c.cast("double").alias(name)


def daily_generation(generation: DataFrame) -> DataFrame:
    """Total per date; a date without any known value totals 0."""
    total = F.coalesce(F.sum(GEN).cast("double"), F.lit(0.0))
    return generation.groupBy("date").agg(total.alias("total_generation_mwh"))


def daily_weather(weather: DataFrame) -> DataFrame:
    return weather.groupBy("date").agg(
        _dbl(F.avg("temperature_f"), "avg_temperature_f"),
        _dbl(F.avg("wind_speed"), "avg_wind_speed"),
    )


def daily_price(price: DataFrame) -> DataFrame:
    return price.groupBy("date").agg(_dbl(F.avg("price_per_mwh"), "avg_electricity_price"))


def indicators_max(economic: DataFrame, names: dict[str, str] = INDICATOR_COLUMNS) -> DataFrame:
    """Indicator rows → columns, the largest value of the date."""
    return economic.groupBy("date").agg(*joins.indicator_columns(names))


def indicators_first(
    economic: DataFrame, names: dict[str, str] = INDICATOR_COLUMNS, order: str = "value"
) -> DataFrame:
    """Indicator rows → columns, the first value in ``order`` (keys are declared unique)."""
    return economic.groupBy("date").agg(
        *[
            _dbl(
                F.min_by(
                    F.when(F.col("indicator") == k, F.col("value")),
                    F.when(
                        (F.col("indicator") == k) & F.col("value").isNotNull(), F.col(order)
                    ),
                ),
                v,
            )
            for k, v in names.items()
        ]
    )


def fuel_sums(fuels: Sequence[str] = tuple(FUELS), fill: float | None = 0.0) -> list[Column]:
    """One conditional sum per fuel, named ``generation_<fuel>_mwh``."""
    out = []
    for fuel in fuels:
        total = F.sum(F.when(F.col("fuel_type") == fuel, F.col(GEN))).cast("double")
        if fill is not None:
            total = F.coalesce(total, F.lit(fill))
        out.append(total.alias(f"generation_{fuel.lower()}_mwh"))
    return out


def pivot_fuels(
    generation: DataFrame, fuels: Sequence[str] = tuple(FUELS), fill: float | None = 0.0
) -> DataFrame:
    return generation.groupBy("date").agg(*fuel_sums(fuels, fill))


def weekly_summary(daily: DataFrame) -> DataFrame:
    """Per week (Monday start): days and mean generation, temperature, liquidity and error."""
    return daily.groupBy(scalars.week_start(F.col("date")).alias("week_start")).agg(
        _count().alias("days_in_week"),
        F.avg("total_generation_mwh").alias("avg_daily_generation"),
        F.avg("avg_temperature_f").alias("avg_temperature"),
        F.avg("actual_liquidity").alias("avg_liquidity_need"),
        F.avg("predicted_liquidity_millions").alias("avg_predicted_liquidity"),
        F.avg(
            scalars.absolute_error(
                F.col("actual_liquidity"), F.col("predicted_liquidity_millions")
            )
        ).alias("avg_prediction_error"),
    )


def weekly_model_errors(errors: DataFrame) -> DataFrame:
    """Per week and model version: MAE, RMSE, MAPE, count and actual range."""
    return errors.groupBy(
        scalars.week_start(F.col("date")).alias("week_start"), "model_version"
    ).agg(
        F.avg("absolute_error").alias("avg_mae"),
        F.sqrt(F.avg(F.col("absolute_error") * F.col("absolute_error"))).alias("rmse"),
        F.avg(F.abs("percentage_error")).alias("avg_mape"),
        _count().alias("prediction_count"),
        F.min("actual_value").alias("min_actual"),
        F.max("actual_value").alias("max_actual"),
    )


def month_summary(features: DataFrame, as_of) -> DataFrame:
    liq = "liquidity_need_millions"
    return filters.month_of(features, as_of).agg(
        _count().alias("days_this_month"),
        F.avg(liq).alias("avg_liquidity_need"),
        F.max(liq).alias("max_liquidity_need"),
        F.min(liq).alias("min_liquidity_need"),
        F.avg("total_generation_mwh").alias("avg_generation"),
        F.avg("avg_temperature_f").alias("avg_temperature"),
        F.avg("oil_price_usd").alias("avg_oil_price"),
    )


def model_stats(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per model version: evaluated predictions, MAE, RMSE and correlation with the actual."""
    actual, predicted = F.col("liquidity_need_millions"), F.col("predicted_liquidity_millions")
    return (
        joins.join_evaluated(features, predictions)
        .groupBy("model_version")
        .agg(
            _count().alias("total_predictions"),
            F.avg(scalars.absolute_error(actual, predicted)).alias("mae"),
            F.sqrt(F.avg(F.pow(actual - predicted, 2))).alias("rmse"),
            F.corr(actual, predicted).alias("correlation"),
        )
    )


def recent_accuracy(features: DataFrame, predictions: DataFrame, as_of, days: int = 7) -> DataFrame:
    """One row: mean absolute error and number of evaluated predictions."""
    joined = joins.join_evaluated(filters.look_back(features, as_of, days), predictions)
    return joined.agg(
        F.avg(
            scalars.absolute_error(
                F.col("liquidity_need_millions"), F.col("predicted_liquidity_millions")
            )
        ).alias("avg_error"),
        _count().alias("prediction_count"),
    )


def latest_and_volume(features: DataFrame, as_of, days: int = 30) -> DataFrame:
    return filters.look_back(features, as_of, days).agg(
        F.max("date").alias("latest_data_date"), _count().alias("total_records_30d")
    )


def fuel_profile(generation: DataFrame) -> DataFrame:
    return generation.groupBy("fuel_type").agg(
        F.count(GEN).alias("records"),
        _dbl(F.sum(GEN), "total_mwh"),
        _dbl(F.avg(GEN), "mean_mwh"),
    )


def fuel_statistics(generation: DataFrame, digits: int = 2) -> DataFrame:
    x = F.col(GEN).cast("double")
    stats = {
        "mean": F.avg(x),
        "std": F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
        "sum": F.sum(x),
    }
    return generation.groupBy("fuel_type").agg(
        F.count(GEN).alias("count"), *[round_product(v, digits).alias(k) for k, v in stats.items()]
    )


def fuel_totals(generation: DataFrame) -> DataFrame:
    return (
        generation.groupBy("fuel_type")
        .agg(_dbl(F.sum(GEN), "total_mwh"))
        .orderBy(F.col("total_mwh").desc(), "fuel_type")
    )


def _renewable_sum(renewable: Sequence[str]) -> Column:
    part = F.sum(F.when(F.col("fuel_type").isin(*renewable), F.col(GEN)))
    return F.coalesce(part.cast("double"), F.lit(0.0))


def _other_sum(renewable: Sequence[str]) -> Column:
    part = F.sum(F.when(~F.col("fuel_type").isin(*renewable), F.col(GEN)))
    return F.coalesce(part.cast("double"), F.lit(0.0))


def daily_renewable(
    generation: DataFrame, renewable: Sequence[str] = tuple(RENEWABLE_FUELS)
) -> DataFrame:
    sums = generation.groupBy("date").agg(
        _renewable_sum(renewable).alias("renewable_mwh"),
        _other_sum(renewable).alias("non_renewable_mwh"),
    )
    return sums.withColumn(
        "total_mwh", F.col("renewable_mwh") + F.col("non_renewable_mwh")
    ).withColumn(
        "renewable_pct", scalars.share_pct(F.col("renewable_mwh"), F.col("total_mwh"))
    )


def renewable_range(generation: DataFrame) -> DataFrame:
    return daily_renewable(generation).agg(
        F.avg("renewable_pct").alias("mean_pct"),
        F.min("renewable_pct").alias("min_pct"),
        F.max("renewable_pct").alias("max_pct"),
    )


def renewable_totals(generation: DataFrame) -> DataFrame:
    return generation.groupBy(
        buckets.renewable_class(F.col("fuel_type")).alias("renewable")
    ).agg(_dbl(F.sum(GEN), "total_mwh"))


def weather_study_daily(
    generation: DataFrame,
    fuels: Sequence[str] = tuple(FUELS),
    renewable: Sequence[str] = tuple(RENEWABLE_FUELS),
) -> DataFrame:
    """Fuel columns, total and renewable share per date; a missing fuel counts as 0."""
    wide = generation.groupBy("date").agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col("fuel_type") == f, F.col(GEN))).cast("double"), F.lit(0.0)
            ).alias(f)
            for f in fuels
        ]
    )

    def add(names):
        total = F.lit(0.0)
        for n in names:
            total = total + F.col(n)
        return total

    wide = wide.withColumn("total_generation", add(fuels)).withColumn(
        "renewable_generation", add([f for f in renewable if f in fuels])
    )
    return wide.withColumn(
        "renewable_pct",
        scalars.share_pct(F.col("renewable_generation"), F.col("total_generation")),
    )


def _fuel_means(fuels: Sequence[str]) -> list[Column]:
    return [
        F.coalesce(
            F.avg(F.when(F.col("fuel_type") == f, F.col(GEN))).cast("double"), F.lit(0.0)
        ).alias(f)
        for f in fuels
    ]


def weekday_pattern(generation: DataFrame, fuels: Sequence[str] = tuple(FUELS)) -> DataFrame:
    """Mean generation per day of week and fuel, Monday first."""
    return (
        generation.groupBy(scalars.weekday(F.col("date")).alias("weekday"))
        .agg(*_fuel_means(fuels))
        .withColumn(
            "day_of_week",
            F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("weekday") + 1),
        )
        .orderBy("weekday")
    )


def weekend_pattern(generation: DataFrame, fuels: Sequence[str] = tuple(FUELS)) -> DataFrame:
    kind = F.when(scalars.is_weekend(F.col("date")), "Weekend").otherwise("Weekday")
    return generation.groupBy(kind.alias("day_type")).agg(*_fuel_means(fuels))


def generation_summary(generation: DataFrame) -> DataFrame:
    """One row: records, date range, fuels, total, mean daily total and mean renewable share.

    The per-date pass also carries what the summary needs of the rows, so the feed is read
    once; the label set is the union of small per-date sets.
    """
    per_day = generation.groupBy("date").agg(
        _count().alias("rows"),
        F.sum(GEN).cast("double").alias("total"),
        _renewable_sum(RENEWABLE_FUELS).alias("renewable"),
        F.array_sort(F.collect_set("fuel_type")).alias("fuels"),
    )
    return per_day.agg(
        F.sum("rows").alias("total_records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("fuels")))).alias("fuel_types"),
        F.sum("total").alias("total_generation_mwh"),
        F.avg("total").alias("avg_daily_generation_mwh"),
        F.avg(scalars.share_pct(F.col("renewable"), F.col("total"))).alias("avg_renewable_pct"),
    )


def weather_summary(weather_features: DataFrame) -> DataFrame:
    """One row of ranges and means plus a condition → count map.

    Rows are first reduced to one per simplified condition (five labels), then merged.
    """
    def total(c):
        return F.sum(F.col(c).cast("double")).alias(f"s_{c}")

    def known(c):
        return F.count(c).alias(f"n_{c}")

    means = {
        "temperature_f": "avg_temperature_f",
        "wind_speed_mph": "avg_wind_speed_mph",
        "solar_potential_index": "avg_solar_potential",
        "wind_potential_index": "avg_wind_potential",
    }
    per_label = weather_features.groupBy("weather_simple").agg(
        _count().alias("rows"),
        F.min("date").alias("lo_date"),
        F.max("date").alias("hi_date"),
        F.min("temperature_f").alias("lo_t"),
        F.max("temperature_f").alias("hi_t"),
        *[f(c) for c in means for f in (total, known)],
    )
    return per_label.agg(
        F.sum("rows").alias("total_periods"),
        F.min("lo_date").alias("first_date"),
        F.max("hi_date").alias("last_date"),
        F.min("lo_t").alias("min_temperature_f"),
        F.max("hi_t").alias("max_temperature_f"),
        *[
            F.try_divide(F.sum(f"s_{c}"), F.sum(f"n_{c}")).alias(name)
            for c, name in means.items()
        ],
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("weather_simple", "rows")))
        ).alias("weather_conditions"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.groupBy(column)
        .agg(_count().alias("n"))
        .orderBy(F.col("n").desc(), F.col(column))
    )


def coverage(df: DataFrame) -> DataFrame:
    """Date range and number of distinct dates, counted after a map-side distinct."""
    return (
        df.groupBy("date")
        .agg(F.lit(1).alias("seen"))
        .agg(
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.count("date").alias("distinct_dates"),
        )
    )


def correlations(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row, one correlation per named pair, all in a single pass."""
    return df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name)
            for name, (a, b) in pairs.items()
        ]
    )


# Weather/generation column pairs of the weather study.
STUDY_PAIRS = {
    "temp_total": ("temperature_f", "total_generation"),
    "temp_solar": ("temperature_f", "SUN"),
    "wind_total": ("wind_speed", "total_generation"),
    "wind_wind": ("wind_speed", "WND"),
    "temp_renewable": ("temperature_f", "renewable_pct"),
    "wind_renewable": ("wind_speed", "renewable_pct"),
}


def weather_study(generation: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily generation frame joined with the day's mean temperature and wind."""
    daily = weather.groupBy("date").agg(
        F.avg("temperature_f").alias("temperature_f"), F.avg("wind_speed").alias("wind_speed")
    )
    return weather_study_daily(generation).join(daily, "date", "inner")


def weather_correlations(generation: DataFrame, weather: DataFrame) -> DataFrame:
    return correlations(weather_study(generation, weather), STUDY_PAIRS)


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, correlation) rows, computed in one pass and turned to rows afterwards."""
    wide = correlations(df, {f: (f, target) for f in features})
    return wide.unpivot([], list(features), "feature", "correlation")


QUARTILES = (0.25, 0.5, 0.75)


def _describe(df: DataFrame, columns: Sequence[str], q: DataFrame) -> DataFrame:
    stats = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(
        *[
            F.struct(
                *[f(F.col(c).cast("double")).alias(k) for k, f in stats.items()]
            ).alias(c)
            for c in columns
        ]
    )
    rows = wide.unpivot([], list(columns), "column", "s").select("column", "s.*")
    p = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quart = q.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == k, F.col("value"))).alias(v) for k, v in p.items()]
    )
    return rows.join(quart, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per column; any number of rows."""
    return _describe(df, columns, quantiles.exact_quantiles(df, columns, QUARTILES))


def describe_daily(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`describe` for a table with one row per day."""
    return _describe(df, columns, quantiles.daily_quantiles(df, columns, QUARTILES))


def latest_per_series(economic: DataFrame, series: str = "indicator") -> DataFrame:
    """Newest value of each series, the smaller one on a tie."""
    order = F.struct(F.col("date"), -F.col("value").cast("double"))
    known = economic.filter(F.col("date").isNotNull())
    picked = known.groupBy(series).agg(F.max_by(F.struct("date", "value"), order).alias("r"))
    return picked.select(
        series, F.col("r.date").alias("date"), F.col("r.value").cast("double").alias("value")
    )


def date_label_counts(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Rows per date and label, one column per label, 0 where there are none.

    Dates that carry none of the labels are left out.
    """
    names = [f"n_{x.lower().replace(' ', '_')}" for x in labels]
    return (
        df.filter(F.col(column).isin(*labels))
        .groupBy("date")
        .agg(
            *[
                F.count(F.when(F.col(column) == x, 1)).alias(n)
                for x, n in zip(labels, names)
            ]
        )
    )


def linear_trend(df: DataFrame, y: str, x: str) -> DataFrame:
    yc, xc = F.col(y).cast("double"), F.col(x).cast("double")
    return df.agg(
        F.regr_slope(yc, xc).alias("slope"), F.regr_intercept(yc, xc).alias("intercept")
    )


def histogram(df: DataFrame, column: str, n_bins: int = 15) -> DataFrame:
    """Equal-width bins between the extremes; the last bin is closed. Empty bins show 0."""
    x = F.col(column).cast("double")
    known = df.filter(x.isNotNull())
    ends = known.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("e")).scalar()
    lo, hi = ends["lo"], ends["hi"]
    width = (hi - lo) / F.lit(n_bins)
    raw = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide(x - lo, width)).cast("int") + 1, F.lit(n_bins))
    )
    counts = known.groupBy(raw.alias("bin")).agg(_count().alias("n"))
    all_bins = df.sparkSession.range(1, n_bins + 1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (lo + width * (F.col("bin") - 1)).alias("lower"),
        (lo + width * F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def five_numbers(df: DataFrame, column: str, by: str) -> DataFrame:
    """Box-plot summary (min, quartiles, max) per group."""
    q = quantiles.exact_quantiles(df, [column], (0.0, *QUARTILES, 1.0), [by])
    names = {0.0: "min", 0.25: "p25", 0.5: "p50", 0.75: "p75", 1.0: "max"}
    return q.groupBy(by).agg(
        *[F.max(F.when(F.col("prob") == k, F.col("value"))).alias(v) for k, v in names.items()]
    )


def measure_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: min, max, mean and standard deviation of each column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.min(x).alias(f"min_{c}"),
            F.max(x).alias(f"max_{c}"),
            F.avg(x).alias(f"mean_{c}"),
            F.stddev_samp(x).alias(f"std_{c}"),
        ]
    return df.agg(*aggs)


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    """The distinct labels as rows, in order; never gathered into one array."""
    return df.select(column).distinct().orderBy(column)

"""Joins on the calendar date between daily tables and feeds of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators import calendars
from wattledger.operators.filters import restrict_to_dates
from wattledger.session import materialize


def left_join_feed(
    daily: DataFrame, feed: DataFrame, on: str = "date", present: DataFrame | None = None
) -> DataFrame:
    """LEFT join of a one-row-per-day table to a feed with any number of rows per day.

    A plain left join could only broadcast or split the preserved side, so one hot date in
    the feed would end in a single task. The matched part is an inner join instead (Spark
    may broadcast the daily side or split skewed partitions), the unmatched part an anti
    join against the distinct dates of the feed (``present``, when already at hand).
    """
    keys = present if present is not None else feed.select(on).distinct()
    matched = daily.join(feed, on, "inner")
    unmatched = daily.join(keys, on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def left_join_parts(daily: DataFrame, *parts: DataFrame, on: str = "date") -> DataFrame:
    """LEFT join of a one-row-per-day table to a feed that is kept in parts (``by_date``).

    Every part is joined as it lies: what shares the buckets of ``daily`` moves no row, and
    the spread rows of hot dates are met by the daily rows, broadcast or split by adaptive
    execution. A day is unmatched if no part has it.
    """
    matched = reduce(DataFrame.unionByName, [daily.join(p, on, "inner") for p in parts])
    unmatched = daily
    for part in parts:
        unmatched = unmatched.join(part.select(on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def left_chain(base: DataFrame, *others: DataFrame, on: str = "date") -> DataFrame:
    """LEFT join chain of frames that hold at most one row per key."""
    return reduce(lambda left, right: left.join(right, on, "left"), others, base)


def latest_order(timestamp: str, tie: str) -> Column:
    """Ordering value for "newest first, null timestamps before all, ties by ``tie``"."""
    return F.struct(
        F.col(timestamp).isNull().alias("undated"), F.col(timestamp), F.col(tie)
    )


def latest_version_per_date(predictions: DataFrame) -> DataFrame:
    """(date, model_version) of the newest prediction of each date.

    ``max_by`` combines on the map side, so a date with very many predictions costs no
    more than any other.
    """
    order = latest_order("prediction_timestamp", "model_version")
    return predictions.groupBy("date").agg(
        F.max_by("model_version", order).alias("model_version")
    )


def join_latest_prediction(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every feature day with the prediction(s) of the newest model version of that day."""
    latest = latest_version_per_date(predictions)
    current = predictions.join(latest, ["date", "model_version"], "left_semi")
    present = latest.filter(F.col("model_version").isNotNull()).select("date")
    return left_join_feed(features, current, present=present)


def join_all_predictions(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every feature day × all its predictions, one row per model version."""
    return left_join_feed(features, predictions)


def join_evaluated(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Feature days that have a prediction, one row per model version."""
    return features.join(predictions, "date", "inner")


def latest_model(predictions: DataFrame) -> DataFrame:
    """One row: the model version with the newest prediction timestamp."""
    return (
        predictions.orderBy(
            F.col("prediction_timestamp").desc_nulls_first(), F.col("model_version").desc()
        )
        .select("model_version")
        .limit(1)
    )


def restrict_to_latest_model(predictions: DataFrame) -> DataFrame:
    """Predictions of the latest model only; the version is a one-value scalar subquery."""
    return predictions.filter(F.col("model_version") == latest_model(predictions).scalar())


def attach_single_rows(base: DataFrame, *singles: DataFrame) -> DataFrame:
    """Put the columns of one-row frames next to ``base``; an empty one empties the result.

    Each frame becomes a scalar subquery, so no join operator is planned at all.
    """
    out = base
    for i, one in enumerate(singles):
        name = f"_single_{i}"
        packed = one.select(F.struct(*[F.col(c) for c in one.columns]).alias(name))
        out = out.withColumn(name, packed.scalar()).filter(F.col(name).isNotNull())
        out = out.select(
            *[c for c in out.columns if c != name],
            *[F.col(f"{name}.{c}").alias(c) for c in one.columns],
        )
    return out


def fan_out_join(
    generation: DataFrame, weather: DataFrame, economic: DataFrame, price: DataFrame
) -> DataFrame:
    """Per date, what the row-by-row four-table LEFT join would aggregate to.

    Joining the raw rows first repeats each generation row once per weather × indicator ×
    price row of its date. The repeats are never materialised: each side is aggregated on
    its own with its row count, and the product of the counts (1 where a side is empty)
    carries the multiplicity.
    """
    gen = (
        generation.filter(F.col("date").isNotNull() & F.col("generation_mwh").isNotNull())
        .groupBy("date")
        .agg(
            F.sum("generation_mwh").cast("double").alias("generation_mwh"),
            F.count(F.lit(1)).alias("generation_rows"),
        )
    )
    w = weather.groupBy("date").agg(
        F.avg("temperature_f").alias("avg_temperature_f"),
        F.count(F.lit(1)).alias("weather_rows"),
    )
    ec = economic.groupBy("date").agg(
        *indicator_columns(),
        F.count(F.lit(1)).alias("economic_rows"),
    )
    p = price.groupBy("date").agg(
        F.avg("price_per_mwh").cast("double").alias("avg_electricity_price"),
        F.count(F.lit(1)).alias("price_rows"),
    )
    joined = left_chain(gen, w, ec, p)
    copies = F.lit(1).cast("long")
    for rows in ("weather_rows", "economic_rows", "price_rows"):
        copies = copies * F.coalesce(F.col(rows), F.lit(1).cast("long"))
    return joined.withColumn("copies", copies)


def indicator_columns(names: dict[str, str] | None = None) -> list[Column]:
    """Conditional maxima that turn indicator rows into columns."""
    from wattledger.settings import INDICATOR_COLUMNS

    return [
        F.max(F.when(F.col("indicator") == k, F.col("value"))).cast("double").alias(v)
        for k, v in (names or INDICATOR_COLUMNS).items()
    ]


def join_daily_weather(generation: DataFrame, weather: DataFrame) -> DataFrame:
    """Days with both generation and weather: daily total next to daily mean temperature."""
    gen = generation.groupBy("date").agg(
        F.sum("generation_mwh").cast("double").alias("generation_mwh")
    )
    temp = weather.groupBy("date").agg(F.avg("temperature_f").alias("temperature_f"))
    return gen.join(temp, "date", "inner")


def source_flags(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per date seen in any source with a 0/1 flag per source."""
    return calendars.flags(sources)


def availability(
    generation: DataFrame, weather: DataFrame, economic: DataFrame, last: int = 14
) -> DataFrame:
    """Data availability of the last ``last`` dates known to any source."""
    flags = source_flags({"generation": generation, "weather": weather, "economic": economic})
    return flags.orderBy(F.col("date").desc()).limit(last)


def common_dates(
    generation: DataFrame, weather: DataFrame, economic: DataFrame
) -> DataFrame:
    """Dates present in all three sources; failing that, those of the first non-empty one."""
    names = ["generation", "weather", "economic"]
    flags = source_flags(dict(zip(names, (generation, weather, economic))))
    every = F.col("generation") + F.col("weather") + F.col("economic") == 3
    choice = flags.agg(
        F.when(F.max(F.when(every, 1)) == 1, "all")
        .when(F.max("generation") == 1, "generation")
        .when(F.max("weather") == 1, "weather")
        .otherwise("economic")
        .alias("choice")
    ).scalar()
    keep = F.when(choice == "all", every)
    for n in names:
        keep = keep.when(choice == n, F.col(n) == 1)
    return flags.filter(keep).select("date")


def synchronize(
    generation: DataFrame, weather: DataFrame, economic: DataFrame
) -> dict[str, DataFrame]:
    """The three sources restricted to their common dates, and those dates.

    The dates (one row per day at most) are found once and written to the shared folder;
    each of the results then reads its own source only.
    """
    dates = materialize(common_dates(generation, weather, economic), "common-dates")
    return {
        "generation": restrict_to_dates(generation, dates),
        "weather": restrict_to_dates(weather, dates),
        "economic": restrict_to_dates(economic, dates),
        "common_dates": dates.orderBy("date"),
    }


def lookup(
    df: DataFrame,
    key: str,
    table: dict,
    into: str,
    default: Column | None = None,
) -> DataFrame:
    """LEFT join to a dictionary, held as a broadcast dimension table of its fixed size."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    dim = df.sparkSession.range(1).select(F.explode(entries).alias(key, into))
    out = df.join(F.broadcast(dim), key, "left")
    return out if default is None else out.withColumn(into, F.coalesce(F.col(into), default))

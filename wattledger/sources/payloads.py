"""Landed JSON responses → typed rows.

``read_*`` take a path of JSON files (one response each); ``parse_*`` take a DataFrame that
already holds the parsed response, e.g. from a text column and ``from_json``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wattledger import schemas
from wattledger import settings as cfg
from wattledger.functions import rounding, scalars


def _read(spark: SparkSession, path, schema) -> DataFrame:
    return (
        spark.read.schema(schema)
        .json(path, multiLine=True)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def parse_generation(payloads: DataFrame, with_respondent: bool = False) -> DataFrame:
    """(date, fuel_type, generation_mwh, data_source) with incomplete records dropped.

    ``with_respondent`` gives the research shape: the respondent in place of the tag.
    """
    records = payloads.select(F.explode("response.data").alias("r"))
    last = (
        F.col("r.respondent").alias("respondent")
        if with_respondent
        else F.lit(cfg_tag("raw_eia_data")).alias("data_source")
    )
    return records.select(
        scalars.text_date(F.col("r.period")).alias("date"),
        F.col("r.fueltype").alias("fuel_type"),
        scalars.clean_number(F.col("r.value")).alias("generation_mwh"),
        last,
    ).dropna()


def cfg_tag(table: str) -> str:
    return schemas.SOURCE_TAGS[table]


def read_generation(spark: SparkSession, path, with_respondent: bool = False) -> DataFrame:
    return parse_generation(_read(spark, path, schemas.GENERATION_PAYLOAD), with_respondent)


def _temperature(c: Column) -> Column:
    whole = scalars.clean_number(c).try_cast("int")
    return F.coalesce(whole, F.lit(0))


def _periods(payloads: DataFrame) -> DataFrame:
    return payloads.select(F.explode("properties.periods").alias("p"))


def parse_forecast(
    payloads: DataFrame, wind: str = "first", max_chars: int | None = None
) -> DataFrame:
    """(date, temperature_f, wind_speed, forecast, data_source), one row per period.

    ``wind="first"`` takes the first number of a range such as "9 to 14 mph" (9);
    ``wind="digits"`` joins all its digits (914), as the original loader does. ``max_chars``
    cuts the forecast text, which is kept whole by default.
    """
    text = F.coalesce(F.col("p.windSpeed"), F.lit("0 mph"))
    if wind == "digits":
        speed = scalars.digits_number(text)
    else:
        speed = F.coalesce(scalars.first_number(text).cast("int"), F.lit(0))
    words = F.coalesce(F.col("p.shortForecast"), F.lit(""))
    if max_chars is not None:
        words = scalars.prefix(words, max_chars)
    return _periods(payloads).select(
        scalars.text_date(F.col("p.startTime")).alias("date"),
        _temperature(F.col("p.temperature")).alias("temperature_f"),
        speed.alias("wind_speed"),
        words.alias("forecast"),
        F.lit(cfg_tag("raw_weather_data")).alias("data_source"),
    )


def read_forecast(
    spark: SparkSession, path, wind: str = "first", max_chars: int | None = None
) -> DataFrame:
    return parse_forecast(_read(spark, path, schemas.FORECAST_PAYLOAD), wind, max_chars)


def parse_forecast_wide(payloads: DataFrame) -> DataFrame:
    """One row per period with the period name, wind text and direction, and both texts."""

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(f"p.{name}"), F.lit(default))

    return _periods(payloads).select(
        scalars.text_date(F.col("p.startTime")).alias("date"),
        F.col("p.name").alias("period_name"),
        _temperature(F.col("p.temperature")).alias("temperature_f"),
        text("windSpeed", "Unknown").alias("wind_speed"),
        text("windDirection", "Unknown").alias("wind_direction"),
        text("shortForecast", "").alias("forecast"),
        text("detailedForecast", "").alias("detailed_forecast"),
    )


def read_forecast_wide(spark: SparkSession, path) -> DataFrame:
    return parse_forecast_wide(_read(spark, path, schemas.FORECAST_PAYLOAD))


def _observations(payloads: DataFrame, **named: Column) -> DataFrame:
    """(date, ``named``…, value); what names a file is worked out once for the file."""
    return (
        payloads.select("observations", *[c.alias(n) for n, c in named.items()])
        .select(*named, F.explode("observations").alias("o"))
        .filter(F.col("o.value") != ".")
        .select(
            scalars.text_date(F.col("o.date")).alias("date"),
            *named,
            scalars.clean_number(F.col("o.value")).alias("value"),
        )
    )


def parse_series(payloads: DataFrame, indicator: Column) -> DataFrame:
    """(date, indicator, value, data_source) without the missing-value records."""
    return _observations(payloads, indicator=indicator).select(
        "date",
        "indicator",
        "value",
        F.lit(cfg_tag("raw_economic_data")).alias("data_source"),
    )


def series_of_file(path: Column) -> Column:
    """Series id from a file named ``<series id>[_anything].json``."""
    return F.regexp_extract(F.substring_index(path, "/", -1), r"([A-Za-z0-9]+)", 1)


def read_series(spark: SparkSession, path, names: dict[str, str] | None = None) -> DataFrame:
    """All series files below ``path`` in one read, the indicator taken from the file name."""
    payloads = _read(spark, path, schemas.SERIES_PAYLOAD)
    series = series_of_file(F.col("source_file"))
    return parse_series(
        payloads, scalars.map_lookup(series, names or cfg.SERIES_INDICATORS, series)
    )


def parse_series_described(payloads: DataFrame, series: Column) -> DataFrame:
    """(date, series_id, indicator_name, value, units)."""
    named = {
        "series_id": series,
        "indicator_name": scalars.map_lookup(series, cfg.SERIES_NAMES, series),
        "units": scalars.map_lookup(series, cfg.SERIES_UNITS, F.lit("Units")),
    }
    rows = _observations(payloads, **named)
    return rows.select("date", "series_id", "indicator_name", "value", "units")


def read_series_described(spark: SparkSession, path) -> DataFrame:
    payloads = _read(spark, path, schemas.SERIES_PAYLOAD)
    return parse_series_described(payloads, series_of_file(F.col("source_file")))


def weather_code_text(code: Column) -> Column:
    fallback = F.concat(F.lit("Weather code "), F.coalesce(code.cast("string"), F.lit("None")))
    return scalars.map_lookup(code, cfg.WEATHER_CODES, fallback)


def parse_historical_weather(payloads: DataFrame) -> DataFrame:
    """Parallel daily arrays → one row per day."""
    d = "daily."
    zipped = F.arrays_zip(
        F.col(d + "time").alias("time"),
        F.col(d + "temperature_2m_max").alias("t_max"),
        F.col(d + "temperature_2m_min").alias("t_min"),
        F.col(d + "temperature_2m_mean").alias("t_mean"),
        F.col(d + "windspeed_10m_max").alias("wind"),
        F.col(d + "precipitation_sum").alias("rain"),
        F.col(d + "weathercode").alias("code"),
    )
    day = payloads.select(F.explode(zipped).alias("x")).select("x.*")
    both = (F.col("t_max") != 0) & (F.col("t_min") != 0)
    mean = F.when(both, (F.col("t_max") + F.col("t_min")) / 2).otherwise(F.col("t_mean"))
    return day.select(
        scalars.text_date(F.col("time")).alias("date"),
        F.when(mean != 0, rounding.round_exact(mean, 1)).alias("temperature_f"),
        F.col("t_max").alias("temperature_max_f"),
        F.col("t_min").alias("temperature_min_f"),
        F.col("wind").alias("wind_speed"),
        F.col("rain").alias("precipitation_inch"),
        F.col("code").alias("weather_code"),
        weather_code_text(F.col("code")).alias("forecast"),
        F.lit("Open-Meteo").alias("data_source"),
    )


def read_historical_weather(spark: SparkSession, path) -> DataFrame:
    return parse_historical_weather(_read(spark, path, schemas.HISTORICAL_PAYLOAD))


def generation_error() -> Column:
    """Why a generation response can't be used; null for a good one."""
    return (
        F.when(F.col("response").isNull(), "Missing 'response' key in API data")
        .when(F.col("response.data").isNull(), "Missing 'data' key in response")
        .when(F.size("response.data") == 0, "No data found in API response")
    )


def validate_payload(payloads: DataFrame, *keys: str) -> DataFrame:
    """``keys``… plus (is_valid, error), one row per response."""
    error = generation_error()
    return payloads.select(*keys, error.isNull().alias("is_valid"), error.alias("error"))


def validate_files(spark: SparkSession, path) -> DataFrame:
    return validate_payload(_read(spark, path, schemas.GENERATION_PAYLOAD), "source_file")


def feed_filter(
    df: DataFrame,
    start,
    end,
    respondent: str = cfg.RESPONDENT,
    fuels: Sequence[str] = tuple(cfg.FUELS),
    limit: int | None = None,
) -> DataFrame:
    """The request facets as a query: region, fuels, date range, newest first, row cap."""
    kept = df.filter(
        (F.col("respondent") == respondent)
        & F.col("fuel_type").isin(*fuels)
        & F.col("date").between(scalars.as_date(start), scalars.as_date(end))
    )
    order = [F.col("date").desc(), *[c for c in ("fuel_type", "generation_mwh") if c in df.columns]]
    ordered = kept.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


MALFORMED = "_malformed"


def response_options(reader):
    """Reader (or stream reader) of JSON files with one response each."""
    return reader.options(multiLine="true", mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)


def _missing(*path: str) -> Column:
    """First key on the way to the records that a response lacks."""
    error = None
    for i, key in enumerate(path):
        lacks = F.col(".".join(path[: i + 1])).isNull()
        said = f"Missing '{key}' key in response"
        error = F.when(lacks, said) if error is None else error.when(lacks, said)
    return error


@dataclass(frozen=True)
class Feed:
    """A feed that lands as JSON: its payload, where its records are, what makes one unusable,
    and the parser of valid responses."""

    payload: StructType
    records: str
    unusable: Callable[[str], Column]
    parse: Callable[[DataFrame], DataFrame]
    invalid: Callable[[], Column]

    @property
    def landed(self) -> StructType:
        return StructType([*self.payload.fields, StructField(MALFORMED, StringType())])

    def error(self) -> Column:
        """Why a response can't be used; null for a good one."""
        return F.when(F.col(MALFORMED).isNotNull(), "Malformed JSON").otherwise(self.invalid())

    def rejected(self, payloads: DataFrame) -> DataFrame:
        """(source_file, error, record as JSON) of the records that give no row."""
        records = payloads.select("source_file", F.explode(self.records).alias("r"))
        bad = records.filter(self.unusable("r"))
        return bad.select("source_file", F.lit("Unusable record").alias("error"), F.to_json("r").alias("record"))


def _series_rows(payloads: DataFrame) -> DataFrame:
    series = series_of_file(F.col("source_file"))
    return parse_series(payloads, scalars.map_lookup(series, cfg.SERIES_INDICATORS, series))


def _no_reading(r: str) -> Column:
    value = scalars.clean_number(F.col(f"{r}.value"))
    return scalars.text_date(F.col(f"{r}.period")).isNull() | F.col(f"{r}.fueltype").isNull() | value.isNull()


#: Feeds by raw table. A series' missing values (".") are no records and not rejected.
FEEDS: dict[str, Feed] = {
    "raw_eia_data": Feed(
        schemas.GENERATION_PAYLOAD, "response.data", _no_reading, parse_generation, generation_error,
    ),
    "raw_weather_data": Feed(
        schemas.FORECAST_PAYLOAD, "properties.periods",
        lambda r: scalars.text_date(F.col(f"{r}.startTime")).isNull(),
        parse_forecast, lambda: _missing("properties", "periods"),
    ),
    "raw_economic_data": Feed(
        schemas.SERIES_PAYLOAD, "observations",
        lambda r: (F.col(f"{r}.value") != ".") & scalars.text_date(F.col(f"{r}.date")).isNull(),
        _series_rows, lambda: _missing("observations"),
    ),
}

"""Table and payload schemas, declared keys and the fixed column lists."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# Names, types and order of the tables' columns and of the payloads' fields.
RAW_GENERATION = _struct(
    ("date", DateType(), False),
    ("fuel_type", StringType(), False),
    ("generation_mwh", DecimalType(15, 2), True),
    ("data_source", StringType(), True),
    ("created_at", TimestampType(), True),
)
RAW_WEATHER = _struct(
    ("date", DateType(), False),
    ("temperature_f", IntegerType(), True),
    ("wind_speed", IntegerType(), True),
    ("forecast", StringType(), True),
    ("data_source", StringType(), True),
    ("created_at", TimestampType(), True),
)
RAW_ECONOMIC = _struct(
    ("date", DateType(), False),
    ("indicator", StringType(), False),
    ("value", DecimalType(15, 4), True),
    ("data_source", StringType(), True),
    ("created_at", TimestampType(), True),
)
RAW_PRICE = _struct(
    ("date", DateType(), False),
    ("price_type", StringType(), False),
    ("price_per_mwh", DecimalType(10, 2), True),
    ("market", StringType(), True),
    ("data_source", StringType(), True),
    ("created_at", TimestampType(), True),
)
ML_FEATURES = _struct(
    ("date", DateType(), False),
    ("total_generation_mwh", DecimalType(15, 2), True),
    ("avg_temperature_f", DecimalType(5, 1), True),
    ("oil_price_usd", DecimalType(8, 2), True),
    ("industrial_production_index", DecimalType(8, 2), True),
    ("ca_unemployment_rate", DecimalType(5, 2), True),
    ("avg_electricity_price", DecimalType(8, 2), True),
    ("liquidity_need_millions", DecimalType(12, 2), True),
    ("created_at", TimestampType(), True),
)
ML_PREDICTIONS = _struct(
    ("date", DateType(), False),
    ("predicted_liquidity_millions", DecimalType(12, 2), True),
    ("actual_liquidity_millions", DecimalType(12, 2), True),
    ("model_version", StringType(), True),
    ("prediction_timestamp", TimestampType(), True),
    ("confidence_interval_lower", DecimalType(12, 2), True),
    ("confidence_interval_upper", DecimalType(12, 2), True),
)
MODEL_PERFORMANCE = _struct(
    ("evaluation_date", DateType(), False),
    ("model_version", StringType(), False),
    ("mae_millions", DecimalType(10, 2), True),
    ("rmse_millions", DecimalType(10, 2), True),
    ("r_squared", DecimalType(5, 4), True),
    ("mape_percent", DecimalType(5, 2), True),
    ("num_predictions", IntegerType(), True),
    ("evaluation_period_days", IntegerType(), True),
    ("created_at", TimestampType(), True),
)
DATA_QUALITY_METRICS = _struct(
    ("check_date", DateType(), False),
    ("table_name", StringType(), False),
    ("metric_name", StringType(), False),
    ("metric_value", DecimalType(15, 4), True),
    ("status", StringType(), True),
    ("threshold_value", DecimalType(15, 4), True),
    ("created_at", TimestampType(), True),
)

TABLES: dict[str, StructType] = {
    "raw_eia_data": RAW_GENERATION,
    "raw_weather_data": RAW_WEATHER,
    "raw_economic_data": RAW_ECONOMIC,
    "raw_price_data": RAW_PRICE,
    "ml_features": ML_FEATURES,
    "ml_predictions": ML_PREDICTIONS,
    "model_performance": MODEL_PERFORMANCE,
    "data_quality_metrics": DATA_QUALITY_METRICS,
}

KEYS: dict[str, list[str]] = {
    "raw_eia_data": ["date", "fuel_type"],
    "raw_weather_data": ["date"],
    "raw_economic_data": ["date", "indicator"],
    "raw_price_data": ["date", "price_type", "market"],
    "ml_features": ["date"],
    "ml_predictions": ["date", "model_version"],
    "model_performance": ["evaluation_date", "model_version"],
    "data_quality_metrics": ["check_date", "table_name", "metric_name"],
}

# Source tag each raw table falls back to when the file carries none.
SOURCE_TAGS: dict[str, str] = {
    "raw_eia_data": "EIA",
    "raw_weather_data": "NOAA",
    "raw_economic_data": "FRED",
    "raw_price_data": "SIMULATED",
}

# Columns a landed file of each table holds, in file order.
LOAD_COLUMNS: dict[str, list[str]] = {
    "raw_eia_data": ["date", "fuel_type", "generation_mwh", "data_source"],
    "raw_weather_data": ["date", "temperature_f", "wind_speed", "forecast", "data_source"],
    "raw_economic_data": ["date", "indicator", "value", "data_source"],
    "raw_price_data": ["date", "price_type", "price_per_mwh", "market", "data_source"],
    "ml_predictions": [
        "date",
        "predicted_liquidity_millions",
        "model_version",
        "prediction_timestamp",
    ],
}

FEATURES = [
    "total_generation_mwh",
    "avg_temperature_f",
    "oil_price_usd",
    "industrial_production_index",
    "avg_electricity_price",
]
TARGET = "liquidity_need_millions"

_STR = StringType()

GENERATION_PAYLOAD = StructType(
    [
        StructField(
            "response",
            StructType(
                [
                    StructField(
                        "data",
                        ArrayType(
                            _struct(
                                ("period", _STR, True),
                                ("fueltype", _STR, True),
                                ("value", _STR, True),
                                ("respondent", _STR, True),
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)
FORECAST_PAYLOAD = StructType(
    [
        StructField(
            "properties",
            StructType(
                [
                    StructField(
                        "periods",
                        ArrayType(
                            _struct(
                                ("name", _STR, True),
                                ("startTime", _STR, True),
                                ("temperature", _STR, True),
                                ("windSpeed", _STR, True),
                                ("windDirection", _STR, True),
                                ("shortForecast", _STR, True),
                                ("detailedForecast", _STR, True),
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)
SERIES_PAYLOAD = StructType(
    [
        StructField(
            "observations",
            ArrayType(_struct(("date", _STR, True), ("value", _STR, True))),
        )
    ]
)
HISTORICAL_PAYLOAD = StructType(
    [
        StructField(
            "daily",
            StructType(
                [
                    StructField("time", ArrayType(_STR)),
                    StructField("temperature_2m_max", ArrayType(DoubleType())),
                    StructField("temperature_2m_min", ArrayType(DoubleType())),
                    StructField("temperature_2m_mean", ArrayType(DoubleType())),
                    StructField("windspeed_10m_max", ArrayType(DoubleType())),
                    StructField("precipitation_sum", ArrayType(DoubleType())),
                    StructField("weathercode", ArrayType(IntegerType())),
                ]
            ),
        )
    ]
)


def select_typed(df, table: str):
    """Project ``df`` on a table's columns and types; absent columns become null."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].fields
        ]
    )

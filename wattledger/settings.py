"""Fixed values of the domain and default thresholds; every operator takes them as parameters."""

from __future__ import annotations

# Fuel codes, indicator names and series descriptions.
FUELS = ["NG", "SUN", "WAT", "WND"]
RENEWABLE_FUELS = ["SUN", "WND", "WAT"]
RESPONDENT = "CAL"

SERIES_INDICATORS = {
    "INDPRO": "industrial_production_index",
    "CAUR": "california_unemployment_rate",
    "DCOILWTICO": "crude_oil_price_wti",
    "GASREGW": "gasoline_price_regular",
}
SERIES_NAMES = {
    "INDPRO": "Industrial Production Index",
    "CAUR": "California Unemployment Rate",
    "DCOILWTICO": "Crude Oil Price (WTI)",
    "GASREGW": "Regular Gasoline Price",
}
SERIES_UNITS = {
    "INDPRO": "Index 2017=100",
    "CAUR": "Percent",
    "DCOILWTICO": "Dollars per Barrel",
    "GASREGW": "Dollars per Gallon",
}

OIL = "crude_oil_price_wti"
PRODUCTION = "industrial_production_index"
UNEMPLOYMENT = "california_unemployment_rate"
INDICATOR_COLUMNS = {
    OIL: "oil_price_usd",
    PRODUCTION: "industrial_production_index",
    UNEMPLOYMENT: "ca_unemployment_rate",
}

# WMO weather codes.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    95: "Thunderstorm",
    96: "Thunderstorm with hail",
}

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Defaults of the liquidity target.
GENERATION_WEIGHT = 0.05
OIL_WEIGHT = 10.0
DEFAULT_OIL_PRICE = 50.0
NOISE_LOW = 50
NOISE_HIGH = 200

# Export, training and forecast defaults.
VALIDATION_SHARE = 0.2
SEED = 42
RIDGE_ALPHA = 1.0
FOREST_TREES = 100
FOREST_DEPTH = 10
FORECAST_DAYS = 7
CONFIDENCE_Z = 1.96

# Buckets of a table that is kept by date.
DATE_BUCKETS = 64

# Data-quality and monitoring thresholds.
MIN_ROWS = 30
MAX_ROWS = 10000
MAX_DAYS_OLD = 2
MIN_COMPLETE_PCT = 90
MAX_ERROR_PCT = 25
MAX_MAE = 50
MIN_R2 = 0.7
MIN_DAILY_RECORDS = 100

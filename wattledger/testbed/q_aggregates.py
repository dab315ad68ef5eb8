"""Queries for aggregates, windows, ordered reads, set operations and the reporting views."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattledger import schemas
from wattledger import settings as cfg
from wattledger.functions import buckets as bk
from wattledger.operators import aggregates as ag
from wattledger.operators import joins as jn
from wattledger.operators import sets, windows
from wattledger.plans import model as ml
from wattledger.plans import features as feats
from wattledger.plans import views
from wattledger.testbed.q_tables import (
    DEMAND_SQL,
    ERR,
    EVALUATED,
    FEAT_SQL,
    INDEX_SQL,
    JN3_FROM,
    LATEST_MODEL_SQL,
    LIQ,
    PRED,
    SIMPLE_SQL,
    TEMP_BIN_SQL,
    D,
    case,
    col,
)
from wattledger.testbed.registry import R, query
from wattledger.testbed.standins import AS_OF

NUMBERS = [c for c in feats.ML_COLUMNS if c != "date"]


def avg_of(columns: dict[str, str]) -> str:
    return ", ".join(f"{R(f'avg({c})')} AS {n}" for c, n in columns.items())


# ---- aggregates -------------------------------------------------------------------------


@query(
    "agg1_daily_generation",
    f"SELECT date, {R('sum(generation_mwh)')} AS total_generation_mwh FROM readings GROUP BY date",
)
def _(t):
    return ag.daily_generation(t.readings)


@query(
    "agg2_daily_weather",
    f"SELECT date, {R('avg(temperature_f)')} AS avg_temperature_f, {R('avg(wind_speed)')} "
    "AS avg_wind_speed FROM obs GROUP BY date",
)
def _(t):
    return ag.daily_weather(t.observations)


@query(
    "agg3_daily_price",
    f"SELECT date, {R('avg(price_per_mwh)')} AS avg_electricity_price FROM price GROUP BY date",
)
def _(t):
    return ag.daily_price(t.price)


INDICATOR_SQL = (
    "SELECT date, "
    + ", ".join(
        R(f"{{f}}(CASE WHEN indicator = '{k}' THEN value END)") + f" AS {v}"
        for k, v in cfg.INDICATOR_COLUMNS.items()
    )
    + " FROM econ GROUP BY date"
)


@query("agg4_indicators_max", INDICATOR_SQL.format(f="max"))
def _(t):
    return ag.indicators_max(t.economic)


@query("agg5_indicators_first", INDICATOR_SQL.format(f="min"))
def _(t):
    return ag.indicators_first(t.economic)


@query(
    "agg6_pivot_fuels",
    "SELECT date, "
    + ", ".join(
        R(f"sum(CASE WHEN fuel_type = '{f}' THEN generation_mwh END)")
        + f" AS generation_{f.lower()}_mwh"
        for f in cfg.FUELS
    )
    + " FROM readings GROUP BY date",
)
def _(t):
    return ag.pivot_fuels(t.readings, fill=None)


@query(
    "agg7_feature_groups",
    f"SELECT date, {R('sum(generation_mwh)')} AS total_generation_mwh, count(*) AS readings "
    "FROM readings WHERE date IS NOT NULL GROUP BY date HAVING sum(generation_mwh) > "
    "(SELECT sum(generation_mwh) / count(DISTINCT date) FROM readings)",
)
def _(t):
    mean = t.readings.groupBy("date").agg(F.sum("generation_mwh").alias("s")).agg(F.avg("s")).scalar()
    return (
        t.readings.filter(col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.sum("generation_mwh").alias("total_generation_mwh"),
            F.count(F.lit(1)).alias("readings"),
        )
        .filter(col("total_generation_mwh") > mean)
    )


WEEKLY_SQL = f"""SELECT CAST(date_trunc('week', mf.date) AS DATE) AS week_start,
  count(*) AS days_in_week, {R('avg(mf.total_generation_mwh)')} AS avg_daily_generation,
  {R('avg(mf.avg_temperature_f)')} AS avg_temperature,
  {R(f'avg(mf.{LIQ})')} AS avg_liquidity_need,
  {R(f'avg(mp.{PRED})')} AS avg_predicted_liquidity,
  {R(f'avg(abs(mf.{LIQ} - mp.{PRED}))')} AS avg_prediction_error
FROM {JN3_FROM}
WHERE mp.{PRED} IS NOT NULL GROUP BY 1"""


@query("agg8_weekly_summary", WEEKLY_SQL)
def _(t):
    return ag.weekly_summary(
        views.daily_energy_dashboard(t.features, t.predictions).filter(col(PRED).isNotNull())
    )


WEEKLY_MODEL_SQL = f"""SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, model_version,
  {R('avg(e)')} AS avg_mae, {R('sqrt(avg(e * e))')} AS rmse, {R('avg(abs(pct))')} AS avg_mape,
  count(*) AS prediction_count, {R(f'min({LIQ})')} AS min_actual, {R(f'max({LIQ})')}
  AS max_actual{{extra}}
FROM (SELECT *, {ERR} AS e, ({LIQ} - {PRED}) / nullif({LIQ}, 0) * 100 AS pct
      FROM feat JOIN pred USING (date) {{where}}) GROUP BY ALL"""


@query("agg9_weekly_model_errors", WEEKLY_MODEL_SQL.format(extra="", where=""))
def _(t):
    return ag.weekly_model_errors(views.daily_errors(t.features, t.predictions, AS_OF, 100000))


MONTH_SQL = f"""SELECT count(*) AS days_this_month, {R(f'avg({LIQ})')} AS avg_liquidity_need,
  {R(f'max({LIQ})')} AS max_liquidity_need, {R(f'min({LIQ})')} AS min_liquidity_need,
  {R('avg(total_generation_mwh)')} AS avg_generation, {R('avg(avg_temperature_f)')}
  AS avg_temperature, {R('avg(oil_price_usd)')} AS avg_oil_price
FROM feat WHERE date_trunc('month', date) = date_trunc('month', {D})"""


@query("agg10_month_summary", MONTH_SQL)
def _(t):
    return ag.month_summary(t.features, AS_OF)


STATS_SQL = f"""SELECT model_version, count(*) AS total_predictions, {R('avg(' + ERR + ')')} AS mae,
  {R(f'sqrt(avg(power({LIQ} - {PRED}, 2)))')} AS rmse, {R(f'corr({LIQ}, {PRED})')} AS correlation
FROM feat JOIN pred USING (date) {{where}} GROUP BY model_version"""


@query("agg11_model_stats", STATS_SQL.format(where=""))
def _(t):
    return ag.model_stats(t.features, t.predictions)


@query(
    "agg12_recent_accuracy",
    f"SELECT {R('avg(' + ERR + ')')} AS avg_error, count(*) AS prediction_count "
    f"FROM feat JOIN pred USING (date) WHERE date >= {D} - 7",
)
def _(t):
    return ag.recent_accuracy(t.features, t.predictions, AS_OF)


@query(
    "agg13_latest_and_volume",
    f"SELECT max(date) AS latest_data_date, count(*) AS total_records_30d FROM feat "
    f"WHERE date >= {D} - 30",
)
def _(t):
    return ag.latest_and_volume(t.features, AS_OF)


@query(
    "agg14_fuel_profile",
    f"SELECT fuel_type, count(generation_mwh) AS records, {R('sum(generation_mwh)')} AS total_mwh, "
    f"{R('avg(generation_mwh)')} AS mean_mwh FROM readings GROUP BY fuel_type",
)
def _(t):
    return ag.fuel_profile(t.readings)


def even2(expr: str) -> str:
    return R(f"round_even({expr} * 100, 0) / 100")


@query(
    "agg15_fuel_statistics",
    "SELECT fuel_type, count(generation_mwh) AS count, "
    + ", ".join(
        f"{even2(f'{f}(generation_mwh)')} AS {n}"
        for n, f in {
            "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "sum": "sum"
        }.items()
    )
    + " FROM readings GROUP BY fuel_type",
)
def _(t):
    return ag.fuel_statistics(t.readings)


@query(
    "agg16_fuel_totals",
    f"SELECT fuel_type, {R('sum(generation_mwh)')} AS total_mwh FROM readings GROUP BY fuel_type "
    "ORDER BY total_mwh DESC",
)
def _(t):
    return ag.fuel_totals(t.readings)


RENEW = "coalesce(sum(CASE WHEN fuel_type <> 'NG' THEN generation_mwh END), 0)"
OTHER = "coalesce(sum(CASE WHEN fuel_type = 'NG' THEN generation_mwh END), 0)"
RENEW_DAY_SQL = f"""SELECT date, {RENEW} AS renewable_mwh, {OTHER} AS non_renewable_mwh,
  sum(generation_mwh) AS total_mwh, {RENEW} / sum(generation_mwh) * 100 AS renewable_pct
FROM readings GROUP BY date"""


@query(
    "agg17_daily_renewable",
    f"SELECT date, {R('renewable_mwh')} AS renewable_mwh, {R('non_renewable_mwh')} "
    f"AS non_renewable_mwh, {R('total_mwh')} AS total_mwh, {R('renewable_pct')} AS renewable_pct "
    f"FROM ({RENEW_DAY_SQL})",
)
def _(t):
    return ag.daily_renewable(t.readings)


@query(
    "agg17_renewable_range",
    f"SELECT {R('avg(renewable_pct)')} AS mean_pct, {R('min(renewable_pct)')} AS min_pct, "
    f"{R('max(renewable_pct)')} AS max_pct FROM ({RENEW_DAY_SQL})",
)
def _(t):
    return ag.renewable_range(t.readings)


@query(
    "agg18_renewable_totals",
    "SELECT CASE WHEN fuel_type IN ('SUN', 'WND', 'WAT') THEN 'Renewable' ELSE 'Non-Renewable' END "
    f"AS renewable, {R('sum(generation_mwh)')} AS total_mwh FROM readings GROUP BY 1",
)
def _(t):
    return ag.renewable_totals(t.readings)


STUDY_DAY_SQL = (
    "(SELECT date, "
    + ", ".join(
        f'coalesce(sum(CASE WHEN fuel_type = \'{f}\' THEN generation_mwh END), 0) AS "{f}"'
        for f in cfg.FUELS
    )
    + f", sum(generation_mwh) AS total_generation, {RENEW} AS renewable_generation, "
    f"{RENEW} / sum(generation_mwh) * 100 AS renewable_pct FROM readings GROUP BY date)"
)


@query(
    "agg19_weather_study_daily",
    "SELECT date, "
    + ", ".join(f'{R(f)} AS "{f}"' for f in cfg.FUELS)
    + f", {R('total_generation')} AS total_generation, {R('renewable_generation')} "
    f"AS renewable_generation, {R('renewable_pct')} AS renewable_pct FROM {STUDY_DAY_SQL}",
)
def _(t):
    return ag.weather_study_daily(t.readings)


FUEL_MEANS = ", ".join(
    R(f"coalesce(avg(CASE WHEN fuel_type = '{f}' THEN generation_mwh END), 0)") + f' AS "{f}"'
    for f in cfg.FUELS
)


@query(
    "agg20_weekday_pattern",
    f"SELECT CAST(isodow(date) - 1 AS INTEGER) AS weekday, dayname(date) AS day_of_week, "
    f"{FUEL_MEANS} FROM readings GROUP BY 1, 2",
)
def _(t):
    return ag.weekday_pattern(t.readings)


@query(
    "agg21_weekend_pattern",
    "SELECT CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
    f"{FUEL_MEANS} FROM readings GROUP BY 1",
)
def _(t):
    return ag.weekend_pattern(t.readings)


@query(
    "agg22_generation_summary",
    f"""SELECT CAST(sum(n) AS BIGINT) AS total_records, min(date) AS first_date,
  max(date) AS last_date,
  (SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT fuel_type AS f FROM readings))
    AS fuel_types,
  {R('sum(total)')} AS total_generation_mwh, {R('avg(total)')} AS avg_daily_generation_mwh,
  {R('avg(pct)')} AS avg_renewable_pct
FROM (SELECT date, count(*) AS n, sum(generation_mwh) AS total,
        {RENEW} / sum(generation_mwh) * 100 AS pct FROM readings GROUP BY date)""",
)
def _(t):
    out = ag.generation_summary(t.readings)
    return out.withColumn("fuel_types", F.array_join("fuel_types", ","))


@query(
    "agg23_weather_summary",
    f"""SELECT count(*) AS total_periods, min(date) AS first_date, max(date) AS last_date,
  {R('min(temperature_f)')} AS min_temperature_f, {R('max(temperature_f)')} AS max_temperature_f,
  {R('avg(temperature_f)')} AS avg_temperature_f, {R('avg(wind_speed)')} AS avg_wind_speed_mph,
  {R(f'avg({INDEX_SQL})')} AS avg_solar_potential,
  {R('avg(least(CAST(wind_speed AS DOUBLE) / 25, 1))')} AS avg_wind_potential,
  (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM
    (SELECT {SIMPLE_SQL} AS k, count(*) AS n FROM obs GROUP BY 1)) AS weather_conditions
FROM obs""",
)
def _(t):
    out = ag.weather_summary(feats.weather_features(t.observations))
    text = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("weather_conditions")),
            lambda e: F.concat(e["key"], F.lit("="), e["value"]),
        ),
        ",",
    )
    return out.withColumn("weather_conditions", text)


@query("agg24_fuel_counts", "SELECT fuel_type, count(*) AS n FROM readings GROUP BY 1")
def _(t):
    return ag.value_counts(t.readings, "fuel_type")


@query(
    "agg24_demand_counts",
    f"SELECT {DEMAND_SQL} AS demand_factor, count(*) AS n FROM obs GROUP BY 1",
)
def _(t):
    return ag.value_counts(feats.energy_factors(t.observations), "demand_factor")


@query(
    "agg25_coverage",
    "SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) "
    "AS distinct_dates FROM readings",
)
def _(t):
    return ag.coverage(t.readings)


STUDY_SQL = f"""(SELECT * FROM {STUDY_DAY_SQL} JOIN (SELECT date, avg(temperature_f)
  AS temperature_f, avg(wind_speed) AS wind_speed FROM obs GROUP BY date) USING (date))"""


@query(
    "agg26_weather_correlations",
    "SELECT "
    + ", ".join(R(f'corr("{a}", "{b}")') + f" AS {n}" for n, (a, b) in ag.STUDY_PAIRS.items())
    + f" FROM {STUDY_SQL}",
)
def _(t):
    return ag.weather_correlations(t.readings, t.observations)


@query(
    "agg27_target_correlations",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {R(f'corr({f}, {LIQ})')} AS correlation FROM feat"
        for f in schemas.FEATURES
    ),
)
def _(t):
    return ag.target_correlations(t.features, schemas.FEATURES, schemas.TARGET)


def describe_sql(columns, source) -> str:
    one = (
        "SELECT '{c}' AS column, {count} AS count, {mean} AS mean, {std} AS std, {lo} AS min, "
        "{p25} AS p25, {p50} AS p50, {p75} AS p75, {hi} AS max FROM {source}"
    )
    return " UNION ALL ".join(
        one.format(
            c=c,
            count=R(f"count({c})"),
            mean=R(f"avg({c})"),
            std=R(f"stddev_samp({c})"),
            lo=R(f"min({c})"),
            hi=R(f"max({c})"),
            p25=R(f"quantile_cont({c}, 0.25)"),
            p50=R(f"quantile_cont({c}, 0.5)"),
            p75=R(f"quantile_cont({c}, 0.75)"),
            source=source,
        )
        for c in columns
    ).replace(" AS column", ' AS "column"')


@query("agg28_describe_daily", describe_sql(NUMBERS, "feat"))
def _(t):
    return ag.describe_daily(t.features, NUMBERS)


@query("agg28_describe", describe_sql(["temperature_f", "wind_speed"], "obs"))
def _(t):
    return ag.describe(t.observations, ["temperature_f", "wind_speed"])


@query(
    "agg29_latest_per_series",
    f"SELECT indicator, max(date) AS date, {R('arg_max(value, date)')} AS value FROM econ "
    "GROUP BY indicator",
)
def _(t):
    return ag.latest_per_series(t.economic)


@query(
    "agg30_date_label_counts",
    "SELECT date, "
    + ", ".join(
        f"count(*) FILTER (WHERE c = '{x}') AS n_{x.lower()}"
        for x in ["Cold", "Mild", "Warm", "Hot"]
    )
    + f" FROM (SELECT date, {TEMP_BIN_SQL} AS c FROM obs) WHERE c IS NOT NULL GROUP BY date",
)
def _(t):
    binned = t.observations.select("date", bk.temp_bin(col("temperature_f")).alias("c"))
    return ag.date_label_counts(binned, "c", ["Cold", "Mild", "Warm", "Hot"])


@query(
    "agg31_linear_trend",
    f"SELECT {R('regr_slope(total_generation, temperature_f)')} AS slope, "
    f"{R('regr_intercept(total_generation, temperature_f)')} AS intercept FROM {STUDY_SQL}",
)
def _(t):
    study = ag.weather_study(t.readings, t.observations)
    return ag.linear_trend(study, "total_generation", "temperature_f")


HIST_SQL = """WITH x AS ({source}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM x)
SELECT CAST(i AS INTEGER) AS bin, {lower} AS lower, {upper} AS upper, count(b) AS n
FROM range(1, 16) r(i) CROSS JOIN e
LEFT JOIN (SELECT least(CAST(floor((v - lo) / ((hi - lo) / 15)) AS INTEGER) + 1, 15) AS b
           FROM x CROSS JOIN e) ON b = i
GROUP BY i, lo, hi"""


@query(
    "agg32_histogram",
    HIST_SQL.format(
        source="SELECT value AS v FROM events WHERE value IS NOT NULL",
        lower=R("lo + (hi - lo) / 15 * (i - 1)"),
        upper=R("lo + (hi - lo) / 15 * i"),
    ),
)
def _(t):
    return ag.histogram(t.source("events"), "value")


@query(
    "agg33_five_numbers",
    "SELECT fuel_type, "
    + ", ".join(
        f"{R(f'quantile_cont(generation_mwh, {p})')} AS {n}"
        for n, p in {"min": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max": 1.0}.items()
    )
    + " FROM readings GROUP BY fuel_type",
)
def _(t):
    return ag.five_numbers(t.readings, "generation_mwh", "fuel_type")


@query(
    "agg34_measure_stats",
    "SELECT "
    + ", ".join(
        f"{R(f'{f}({c})')} AS {n}_{c}"
        for c in ("temperature_f", "wind_speed")
        for n, f in {"min": "min", "max": "max", "mean": "avg", "std": "stddev_samp"}.items()
    )
    + " FROM obs",
)
def _(t):
    return ag.measure_stats(t.observations, ["temperature_f", "wind_speed"])


@query("agg35_distinct_labels", "SELECT DISTINCT forecast FROM obs")
def _(t):
    return ag.distinct_labels(t.observations, "forecast")


# ---- windows ----------------------------------------------------------------------------

SHARE_SQL = f"""SELECT date, fuel_type, {R('sum(generation_mwh)')} AS total_generation_mwh,
  {R('sum(generation_mwh) / sum(sum(generation_mwh)) OVER (PARTITION BY date) * 100')}
    AS generation_percentage
FROM readings {{where}} GROUP BY date, fuel_type"""


@query("win1_share_of_day", SHARE_SQL.format(where=""))
def _(t):
    return windows.share_of_day(
        t.readings, "fuel_type", "generation_mwh", "total_generation_mwh", "generation_percentage"
    )


@query(
    "win2_latest_per_date",
    f"""SELECT date, model_version, {R(PRED)} AS {PRED} FROM (SELECT *, row_number() OVER (
  PARTITION BY date ORDER BY prediction_timestamp DESC NULLS FIRST, model_version DESC) AS rn
  FROM pred) WHERE rn = 1""",
)
def _(t):
    latest = windows.latest_per_key(
        t.predictions, ["date"], "prediction_timestamp", "model_version"
    )
    return latest.select("date", "model_version", PRED)


FILLED = ["avg_temperature_f", "oil_price_usd", "ca_unemployment_rate"]


def fill_sql(fn: str, frame: str) -> str:
    return (
        "SELECT date, "
        + ", ".join(
            R(f"{fn}({c} IGNORE NULLS) OVER (ORDER BY date {frame})") + f" AS {c}" for c in FILLED
        )
        + " FROM feat"
    )


@query(
    "win3_forward_fill",
    fill_sql("last_value", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"),
)
def _(t):
    return windows.forward_fill(t.features, FILLED).select("date", *FILLED)


@query(
    "win4_backward_fill",
    fill_sql("first_value", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"),
)
def _(t):
    return windows.backward_fill(t.features, FILLED).select("date", *FILLED)


READINGS_SQL = (
    "(SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_partkey, l_linestatus, "
    "CASE WHEN l_partkey % 5 = 0 THEN l_quantity END AS v FROM lineitem)"
)


def gappy_readings(t):
    """Every line as a reading, four of five without a value."""
    return t.source("lineitem").select(
        col("l_shipdate").cast("date").alias("date"), "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus",
        F.when(col("l_partkey") % 5 == 0, col("l_quantity")).alias("v"))


def scan_sql(value: str) -> str:
    return f"SELECT date, l_orderkey, l_linenumber, l_partkey, l_linestatus, {value} AS v FROM {READINGS_SQL}"


LINE = "ORDER BY date, l_orderkey, l_linenumber, l_partkey ROWS BETWEEN"
BEFORE = "last_value(v IGNORE NULLS) OVER ({0}" + LINE + " UNBOUNDED PRECEDING AND CURRENT ROW)"
AFTER = "first_value(v IGNORE NULLS) OVER ({0}" + LINE + " CURRENT ROW AND UNBOUNDED FOLLOWING)"
LINE_ORDER = ["date", "l_orderkey", "l_linenumber", "l_partkey"]


@query("win3_scan_forward", scan_sql(BEFORE.format("PARTITION BY l_linestatus ")))
def _(t):
    return windows.scan_fill(gappy_readings(t), ["v"], LINE_ORDER, by=["l_linestatus"])


@query("win4_scan_backward", scan_sql(AFTER.format("")))
def _(t):
    return windows.scan_fill(gappy_readings(t), ["v"], LINE_ORDER, forward=False, backward=True)


@query("mla1_impute_rows", scan_sql(f"coalesce({BEFORE.format('')}, {AFTER.format('')})"))
def _(t):
    return ml.impute(gappy_readings(t), ["v"], LINE_ORDER)


# ---- ordered reads ----------------------------------------------------------------------


@query("ord1_newest_first", f"SELECT {FEAT_SQL} FROM feat ORDER BY date DESC")
def _(t):
    return sets.newest_first(t.features)


@query(
    "ord2_next_prediction",
    f"SELECT date AS prediction_date, {R(PRED)} AS {PRED}, model_version FROM pred "
    f"WHERE date >= {D} ORDER BY date, model_version LIMIT 1",
)
def _(t):
    return sets.next_prediction(t.predictions, AS_OF)


@query("ord3_latest_model", f"SELECT * FROM {LATEST_MODEL_SQL}")
def _(t):
    return jn.latest_model(t.predictions)


@query(
    "ord4_newest_rows",
    f"SELECT {FEAT_SQL} FROM feat ORDER BY feat.date DESC LIMIT 1000",
)
def _(t):
    return sets.newest_rows(t.features, 1000)


@query("ord5_last_dates", "SELECT DISTINCT date FROM readings ORDER BY date DESC LIMIT 14")
def _(t):
    return sets.last_dates(t.readings)


@query(
    "ord6_head",
    "SELECT obs_id, date, forecast FROM obs ORDER BY obs_id LIMIT 5",
)
def _(t):
    return sets.head(t.observations.select("obs_id", "date", "forecast"), 5, "obs_id")


@query(
    "ord7_day_order",
    "SELECT CAST(isodow(date) - 1 AS INTEGER) AS weekday, dayname(date) AS day_of_week, "
    f"{R('avg(generation_mwh)')} AS mean_mwh FROM readings GROUP BY 1, 2 ORDER BY 1",
)
def _(t):
    return (
        t.readings.groupBy(
            F.weekday("date").alias("weekday"), F.date_format("date", "EEEE").alias("day_of_week")
        )
        .agg(F.avg("generation_mwh").alias("mean_mwh"))
        .orderBy("weekday")
    )


@query(
    "ord8_first_labels",
    f"SELECT date, indicator, {R('value')} AS value FROM econ WHERE indicator IN "
    "(SELECT DISTINCT indicator FROM econ ORDER BY indicator LIMIT 3)",
)
def _(t):
    return sets.first_labels(t.economic, "indicator", 3).select("date", "indicator", "value")


# ---- set operations ---------------------------------------------------------------------

STATUS_SQL = f"""SELECT 'Latest Data' AS metric_category, max(date) AS latest_date,
  CAST(NULL AS BIGINT) AS metric_value,
  CAST(date_diff('day', max(date), {D}) AS INTEGER) AS days_behind FROM feat
UNION ALL SELECT 'Data Volume', NULL, count(*), NULL FROM feat WHERE date >= {D} - 30
UNION ALL SELECT 'Prediction Coverage', NULL, count(*), NULL FROM pred WHERE date >= {D} - 7"""


@query("set1_status_rows", STATUS_SQL)
def _(t):
    return sets.current_status(t.features, t.predictions, AS_OF)


@query(
    "set2_row_counts",
    "SELECT 'Raw EIA' AS table_name, count(*) AS record_count FROM gen UNION ALL "
    "SELECT 'Raw Weather', count(*) FROM wx UNION ALL SELECT 'Raw Economic', count(*) FROM econ "
    "UNION ALL SELECT 'ML Features', count(*) FROM feat "
    "UNION ALL SELECT 'ML Predictions', count(*) FROM pred",
)
def _(t):
    return sets.row_counts(
        {
            "Raw EIA": t.generation,
            "Raw Weather": t.weather,
            "Raw Economic": t.economic,
            "ML Features": t.features,
            "ML Predictions": t.predictions,
        }
    )


@query(
    "set3_concat",
    f"SELECT date, indicator, {R('value')} AS value FROM econ UNION ALL "
    f"SELECT date, price_type, {R('price_per_mwh')} FROM price",
)
def _(t):
    """Two feeds below each other, columns by name."""
    prices = t.price.select(col("price_per_mwh").alias("value"), "date", col("price_type").alias("indicator"))
    return sets.concat([t.economic, prices])


@query(
    "set4_date_intersection",
    "SELECT date FROM readings INTERSECT SELECT date FROM obs INTERSECT SELECT date FROM econ",
)
def _(t):
    return sets.date_intersection(t.readings, t.observations, t.economic)


@query(
    "set5_date_union",
    "SELECT date FROM readings UNION SELECT date FROM obs UNION SELECT date FROM econ",
)
def _(t):
    return sets.date_union(t.readings, t.observations, t.economic)


# ---- reporting views --------------------------------------------------------------------

E3 = f"abs(mf.{LIQ} - mp.{PRED})"


DASHBOARD_SQL = f"""SELECT mf.date, {R('mf.total_generation_mwh')} AS total_generation_mwh,
  {R('mf.avg_temperature_f')} AS avg_temperature_f, {R('mf.avg_electricity_price')}
    AS avg_electricity_price, {R('mf.' + LIQ)} AS actual_liquidity, {R('mp.' + PRED)} AS {PRED},
  {R(E3)} AS prediction_error_millions,
  CASE WHEN mp.{PRED} IS NULL THEN 'No Prediction' WHEN {E3} <= 10 THEN 'Accurate'
    WHEN {E3} <= 25 THEN 'Acceptable' ELSE 'Poor' END AS prediction_quality
FROM {JN3_FROM}"""


@query("vw1_daily_energy_dashboard", DASHBOARD_SQL)
def _(t):
    t = t.with_stored_features()
    return views.daily_energy_dashboard(t.features, t.predictions)


@query("vw2_weekly_summary", WEEKLY_SQL)
def _(t):
    t = t.with_stored_features()
    return views.weekly_summary(t.features, t.predictions)


@query("vw3_current_status", STATUS_SQL)
def _(t):
    return views.current_status(t.features, t.predictions, AS_OF)


@query(
    "vw4_executive_kpis",
    f"""SELECT latest_data_date, total_records_30d, prediction_date,
  {R(PRED)} AS next_day_liquidity_forecast, model_version AS current_model_version,
  {R('avg_error')} AS recent_prediction_error_millions,
  prediction_count AS recent_predictions_evaluated,
  {case('avg_error', [10, 25, 50], ['Excellent', 'Good', 'Acceptable', 'Needs Attention'])}
    AS model_performance_status
FROM (SELECT max(date) AS latest_data_date, count(*) AS total_records_30d FROM feat
      WHERE date >= {D} - 30)
CROSS JOIN (SELECT date AS prediction_date, {PRED}, model_version FROM pred WHERE date >= {D}
      ORDER BY date, model_version LIMIT 1)
CROSS JOIN (SELECT avg({ERR}) AS avg_error, count(*) AS prediction_count
      FROM feat JOIN pred USING (date) WHERE date >= {D} - 7)""",
)
def _(t):
    t = t.with_stored_features()
    return views.executive_kpis(t.features, t.predictions, AS_OF)


@query(
    "vw5_liquidity_time_series",
    f"""SELECT date, {R(LIQ)} AS actual_liquidity, {R(PRED)} AS predicted_liquidity,
  {R('err')} AS prediction_error, {R('total_generation_mwh')} AS total_generation_mwh,
  {R('avg_temperature_f')} AS avg_temperature_f, {R('oil_price_usd')} AS oil_price_usd,
  {R('avg_electricity_price')} AS avg_electricity_price, model_version,
  CASE WHEN {PRED} IS NULL THEN 'No Prediction' ELSE
    {case('err', [10, 25], ['High Accuracy', 'Medium Accuracy', 'Low Accuracy'])} END
    AS accuracy_category,
  {case(LIQ, [100, 200], ['Low Risk', 'Medium Risk', 'High Risk'])} AS risk_level
FROM {EVALUATED} WHERE date >= {D} - 90""",
)
def _(t):
    return views.liquidity_time_series(t.features, t.predictions, AS_OF)


@query("vw6_daily_generation_by_fuel", SHARE_SQL.format(where=f"WHERE date >= {D} - 60"))
def _(t):
    return views.daily_generation_by_fuel(t.readings, AS_OF)


@query(
    "vw7_weather_energy_correlation",
    f"""SELECT date, {R('avg_temperature_f')} AS avg_temperature_f,
  {R('total_generation_mwh')} AS total_generation_mwh, {R(LIQ)} AS {LIQ}, wind_speed, forecast,
  {case('avg_temperature_f', [60, 75, 85],
        ['Cool (≤60°F)', 'Mild (61-75°F)', 'Warm (76-85°F)', 'Hot (>85°F)'])}
    AS temperature_category,
  {case('total_generation_mwh', [50000, 100000],
        ['Low Generation', 'Medium Generation', 'High Generation'])} AS generation_level
FROM feat LEFT JOIN wx USING (date) WHERE date >= {D} - 60""",
)
def _(t):
    return views.weather_energy_correlation(t.features, t.weather, AS_OF)


@query(
    "vw8_economic_indicators_impact",
    f"""SELECT date, {R(LIQ)} AS {LIQ}, {R('oil_price_usd')} AS oil_price_usd,
  {R('industrial_production_index')} AS industrial_production_index,
  {R('ca_unemployment_rate')} AS ca_unemployment_rate,
  {case('oil_price_usd', [60, 80], ['Low Oil Price', 'Medium Oil Price', 'High Oil Price'])}
    AS oil_price_category,
  {case('ca_unemployment_rate', [4, 6],
        ['Low Unemployment', 'Medium Unemployment', 'High Unemployment'])}
    AS unemployment_category
FROM feat WHERE date >= {D} - 90 AND oil_price_usd IS NOT NULL
  AND ca_unemployment_rate IS NOT NULL""",
)
def _(t):
    return views.economic_indicators_impact(t.features, AS_OF)


@query(
    "vw9_model_performance_trend",
    WEEKLY_MODEL_SQL.format(
        extra=", "
        + case("avg(e)", [15, 30, 50], ["Excellent", "Good", "Acceptable", "Poor"])
        + " AS performance_rating",
        where=f"WHERE date >= {D} - 60",
    ),
)
def _(t):
    return views.model_performance_trend(t.features, t.predictions, AS_OF)


@query(
    "vw10_risk_analysis",
    f"""SELECT date, {R(LIQ)} AS {LIQ}, {R(PRED)} AS {PRED}, {R('err')} AS prediction_error,
  a + b + c + d AS total_risk_score,
  CASE WHEN a + b + c + d = 0 THEN 'Low Risk' WHEN a + b + c + d <= 2 THEN 'Medium Risk'
    ELSE 'High Risk' END AS overall_risk_level,
  a AS high_liquidity_risk, b AS high_prediction_risk, c AS oil_price_risk,
  d AS low_generation_risk
FROM (SELECT *, CASE WHEN {LIQ} > 200 THEN 1 ELSE 0 END AS a,
        CASE WHEN err > 50 THEN 1 ELSE 0 END AS b,
        CASE WHEN oil_price_usd > 80 THEN 1 ELSE 0 END AS c,
        CASE WHEN total_generation_mwh < 50000 THEN 1 ELSE 0 END AS d
      FROM {EVALUATED} WHERE date >= {D} - 90 AND {PRED} IS NOT NULL)""",
)
def _(t):
    return views.risk_analysis(t.features, t.predictions, AS_OF)


@query("vw11_current_month_summary", MONTH_SQL)
def _(t):
    return views.current_month_summary(t.features, AS_OF)


@query(
    "vw12_current_model_performance",
    "SELECT *, "
    + case("mae", [15, 30, 50], ["Excellent", "Good", "Acceptable", "Needs Improvement"])
    + f" AS performance_grade FROM ({STATS_SQL.format(where=f'WHERE model_version = {LATEST_MODEL_SQL}')})",
)
def _(t):
    return views.current_model_performance(t.features, t.predictions)



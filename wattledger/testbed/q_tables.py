"""Queries for filters, projections, bucketings, scalar functions, joins and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattledger import schemas
from wattledger import settings as cfg
from wattledger.functions import buckets as bk
from wattledger.functions import scalars as sc
from wattledger.operators import aggregates as ag
from wattledger.operators import filters as fl
from wattledger.operators import joins as jn
from wattledger.plans import features as feats
from wattledger.plans import views
from wattledger.testbed.registry import R, query
from wattledger.testbed.standins import AS_OF

D = f"DATE '{AS_OF}'"
LIQ = "liquidity_need_millions"
PRED = "predicted_liquidity_millions"
UNWEATHERED = [c for c in feats.ML_COLUMNS[1:] if c != "avg_temperature_f"]
FEAT_SQL = ", ".join(["date", *[f"{R(c)} AS {c}" for c in feats.ML_COLUMNS[1:]]])
ERR = f"abs({LIQ} - {PRED})"


def col(name):
    return F.col(name)


# ---- filters ----------------------------------------------------------------------------


@query("flt1_look_back", f"SELECT {FEAT_SQL} FROM feat WHERE date >= {D} - 30")
def _(t):
    return fl.look_back(t.features, AS_OF, 30)


@query(
    "flt2_from_date",
    f"SELECT date, model_version, {R(PRED)} AS {PRED} FROM pred WHERE date >= {D} - 30",
)
def _(t):
    start = F.date_sub(sc.as_date(AS_OF), 30)
    return fl.from_date(t.predictions, start).select("date", "model_version", PRED)


@query(
    "flt3_month_to_date",
    f"SELECT {FEAT_SQL} FROM feat WHERE date_trunc('month', date) = date_trunc('month', {D})",
)
def _(t):
    return fl.month_of(t.features, AS_OF)


@query(
    "flt4_require",
    f"SELECT {FEAT_SQL} FROM feat WHERE oil_price_usd IS NOT NULL "
    "AND ca_unemployment_rate IS NOT NULL",
)
def _(t):
    return fl.require(t.features, ["oil_price_usd", "ca_unemployment_rate"])


@query(
    "flt5_drop_incomplete",
    f"SELECT 'all' AS required, {FEAT_SQL} FROM feat WHERE avg_temperature_f IS NOT NULL "
    "AND oil_price_usd IS NOT NULL AND industrial_production_index IS NOT NULL "
    "AND ca_unemployment_rate IS NOT NULL AND avg_electricity_price IS NOT NULL "
    f"UNION ALL SELECT 'prices', date, NULL, NULL, {R('oil_price_usd')}, NULL, NULL, {R('avg_electricity_price')}, NULL "
    "FROM feat WHERE oil_price_usd IS NOT NULL AND avg_electricity_price IS NOT NULL",
)
def _(t):
    """Feature days that are complete, and those complete in both prices (small tables have some)."""
    prices = t.features.select("date", "oil_price_usd", "avg_electricity_price")
    parts = {"all": fl.drop_incomplete(t.features), "prices": fl.drop_incomplete(prices)}
    whole, priced = [df.select(F.lit(name).alias("required"), "*") for name, df in parts.items()]
    return whole.unionByName(priced, allowMissingColumns=True)


@query(
    "flt5_drop_incomplete_features",
    f"SELECT {', '.join(['date', *[R(c) + ' AS ' + c for c in UNWEATHERED]])} FROM feat "
    "WHERE oil_price_usd IS NOT NULL AND industrial_production_index IS NOT NULL "
    "AND ca_unemployment_rate IS NOT NULL AND avg_electricity_price IS NOT NULL",
)
def _(t):
    """Feature days with every column but the temperature, which few days have."""
    return fl.drop_incomplete(t.features.select("date", *UNWEATHERED))


@query(
    "flt6_having",
    f"SELECT date, {R('sum(generation_mwh)')} AS total_generation_mwh FROM gen GROUP BY date "
    "HAVING sum(generation_mwh) > (SELECT sum(generation_mwh) / count(DISTINCT date) FROM gen)",
)
def _(t):
    """Days above the mean day's generation."""
    daily = ag.daily_generation(t.generation)
    mean = daily.agg(F.avg("total_generation_mwh")).scalar()
    return daily.filter(col("total_generation_mwh") > mean)


@query(
    "flt7_restrict_to_dates",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh FROM readings "
    "WHERE date IN (SELECT date FROM wx)",
)
def _(t):
    kept = fl.restrict_to_dates(t.readings, t.weather)
    return kept.select("date", "fuel_type", "generation_mwh")


@query("flt8_valid_target", f"SELECT {FEAT_SQL} FROM feat WHERE {LIQ} IS NOT NULL")
def _(t):
    return fl.require(t.features, [schemas.TARGET])


# ---- projections ------------------------------------------------------------------------


@query(
    "prj1_select_rename",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS mwh, 'EIA' AS data_source FROM gen",
)
def _(t):
    return t.generation.select(
        "date", "fuel_type", col("generation_mwh").alias("mwh"), F.lit("EIA").alias("data_source")
    )


@query(
    "prj2_fuel_columns",
    "SELECT date, "
    + ", ".join(
        R(f"coalesce(sum(CASE WHEN fuel_type = '{f}' THEN generation_mwh END), 0)")
        + f" AS generation_{f.lower()}_mwh"
        for f in cfg.FUELS
    )
    + " FROM gen GROUP BY date",
)
def _(t):
    return ag.pivot_fuels(t.generation)


@query(
    "prj3_absolute_error",
    f"SELECT date, model_version, {R(ERR)} AS absolute_error FROM feat JOIN pred USING (date)",
)
def _(t):
    return jn.join_evaluated(t.features, t.predictions).select(
        "date", "model_version", sc.absolute_error(col(LIQ), col(PRED)).alias("absolute_error")
    )


@query(
    "prj4_percentage_error",
    f"SELECT date, model_version, {R(f'({LIQ} - {PRED}) / nullif({LIQ}, 0) * 100')} "
    "AS percentage_error FROM feat JOIN pred USING (date)",
)
def _(t):
    return jn.join_evaluated(t.features, t.predictions).select(
        "date", "model_version", sc.percentage_error(col(LIQ), col(PRED)).alias("percentage_error")
    )


@query(
    "prj5_liquidity_need",
    f"SELECT date, {R('total_generation_mwh * 5e-2 + coalesce(oil_price_usd, 50) * 10 + 50')} "
    f"AS {LIQ} FROM feat",
)
def _(t):
    need = sc.liquidity_need(col("total_generation_mwh"), col("oil_price_usd"), F.lit(50))
    return t.features.select("date", need.alias(LIQ))


# ---- bucketings -------------------------------------------------------------------------


def case(value: str, cuts, labels) -> str:
    whens = " ".join(f"WHEN {value} <= {c} THEN '{label}'" for c, label in zip(cuts, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


def _evaluated(t):
    joined = jn.join_all_predictions(t.features, t.predictions)
    return joined.withColumn("err", sc.absolute_error(col(LIQ), col(PRED)))


EVALUATED = f"(SELECT *, {ERR} AS err FROM feat LEFT JOIN pred USING (date))"

for key, name, build, labels in [
    ("cas1_prediction_quality", "prediction_quality", bk.prediction_quality,
     ["Accurate", "Acceptable", "Poor"]),
    ("cas2_accuracy_category", "accuracy_category", bk.accuracy_category,
     ["High Accuracy", "Medium Accuracy", "Low Accuracy"]),
]:
    @query(
        key,
        f"SELECT date, model_version, CASE WHEN {PRED} IS NULL THEN 'No Prediction' "
        f"ELSE {case('err', [10, 25], labels)} END AS {name} FROM {EVALUATED}",
    )
    def _(t, build=build, name=name):
        label = build(col(PRED), col("err")).alias(name)
        return _evaluated(t).select("date", "model_version", label)

for key, name, build, cuts, labels in [
    ("cas4_performance_status", "model_performance_status", bk.performance_status,
     [10, 25, 50], ["Excellent", "Good", "Acceptable", "Needs Attention"]),
    ("cas9_performance_rating", "performance_rating", bk.performance_rating,
     [15, 30, 50], ["Excellent", "Good", "Acceptable", "Poor"]),
    ("cas10_performance_grade", "performance_grade", bk.performance_grade,
     [15, 30, 50], ["Excellent", "Good", "Acceptable", "Needs Improvement"]),
]:
    @query(
        key,
        f"SELECT date, model_version, {case('err', cuts, labels)} AS {name} FROM {EVALUATED}",
    )
    def _(t, build=build, name=name):
        return _evaluated(t).select("date", "model_version", build(col("err")).alias(name))

for key, name, build, source, cuts, labels in [
    ("cas3_risk_level", "risk_level", bk.risk_level, LIQ,
     [100, 200], ["Low Risk", "Medium Risk", "High Risk"]),
    ("cas5_temperature_category", "temperature_category", bk.temperature_category,
     "avg_temperature_f", [60, 75, 85],
     ["Cool (≤60°F)", "Mild (61-75°F)", "Warm (76-85°F)", "Hot (>85°F)"]),
    ("cas6_generation_level", "generation_level", bk.generation_level, "total_generation_mwh",
     [50000, 100000], ["Low Generation", "Medium Generation", "High Generation"]),
    ("cas7_oil_price_category", "oil_price_category", bk.oil_price_category, "oil_price_usd",
     [60, 80], ["Low Oil Price", "Medium Oil Price", "High Oil Price"]),
    ("cas8_unemployment_category", "unemployment_category", bk.unemployment_category,
     "ca_unemployment_rate", [4, 6],
     ["Low Unemployment", "Medium Unemployment", "High Unemployment"]),
]:
    @query(key, f"SELECT date, {case(source, cuts, labels)} AS {name} FROM feat")
    def _(t, build=build, name=name, source=source):
        return t.features.select("date", build(col(source)).alias(name))

FLAG_SQL = f"""SELECT date, model_version,
  CASE WHEN {LIQ} > 200 THEN 1 ELSE 0 END AS high_liquidity_risk,
  CASE WHEN err > 50 THEN 1 ELSE 0 END AS high_prediction_risk,
  CASE WHEN oil_price_usd > 80 THEN 1 ELSE 0 END AS oil_price_risk,
  CASE WHEN total_generation_mwh < 50000 THEN 1 ELSE 0 END AS low_generation_risk
FROM {EVALUATED}"""


def _flags(t):
    flags = bk.risk_flags(
        col(LIQ), col("err"), col("oil_price_usd"), col("total_generation_mwh")
    )
    return _evaluated(t).select(
        "date", "model_version", *[v.alias(k) for k, v in flags.items()]
    ), list(flags)


@query("cas11_risk_flags", FLAG_SQL)
def _(t):
    return _flags(t)[0]


@query(
    "cas12_overall_risk",
    f"""SELECT date, model_version, score AS total_risk_score,
  CASE WHEN score = 0 THEN 'Low Risk' WHEN score <= 2 THEN 'Medium Risk' ELSE 'High Risk' END
    AS overall_risk_level
FROM (SELECT date, model_version, high_liquidity_risk + high_prediction_risk + oil_price_risk
        + low_generation_risk AS score FROM ({FLAG_SQL}))""",
)
def _(t):
    df, names = _flags(t)
    score = sum((col(n) for n in names), F.lit(0))
    return df.select(
        "date",
        "model_version",
        score.alias("total_risk_score"),
        bk.overall_risk(score).alias("overall_risk_level"),
    )


@query(
    "cas13_pass_fail",
    "SELECT date, CASE WHEN count(*) >= 30 THEN 'PASS' ELSE 'FAIL' END AS status "
    "FROM readings GROUP BY date",
)
def _(t):
    counts = t.readings.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("date", bk.pass_fail(col("n") >= 30).alias("status"))


@query(
    "cas14_renewable_class",
    "SELECT date, fuel_type, CASE WHEN fuel_type IN ('SUN', 'WND', 'WAT') THEN 'Renewable' "
    "ELSE 'Non-Renewable' END AS renewable FROM gen",
)
def _(t):
    label = bk.renewable_class(col("fuel_type")).alias("renewable")
    return t.generation.select("date", "fuel_type", label)


SIMPLE_SQL = """CASE WHEN lower(forecast) LIKE '%sunny%' OR lower(forecast) LIKE '%clear%'
    THEN 'Clear'
  WHEN lower(forecast) LIKE '%partly%' OR lower(forecast) LIKE '%mostly%' THEN 'Partly Cloudy'
  WHEN lower(forecast) LIKE '%cloud%' THEN 'Cloudy'
  WHEN lower(forecast) LIKE '%rain%' OR lower(forecast) LIKE '%shower%'
    OR lower(forecast) LIKE '%storm%' THEN 'Rainy' ELSE 'Other' END"""
SOLAR_SQL = """CASE WHEN lower(forecast) LIKE '%sunny%' OR lower(forecast) LIKE '%clear%'
    THEN 'High'
  WHEN lower(forecast) LIKE '%partly%' AND lower(forecast) LIKE '%cloud%' THEN 'Medium'
  ELSE 'Low' END"""
WIND_SQL = (
    "CASE WHEN wind_speed >= 15 THEN 'High' WHEN wind_speed >= 8 THEN 'Medium' ELSE 'Low' END"
)
DEMAND_SQL = (
    "CASE WHEN temperature_f >= 80 THEN 'High Cooling' WHEN temperature_f <= 60 "
    "THEN 'High Heating' ELSE 'Moderate' END"
)
TEMP_BIN_SQL = """CASE WHEN temperature_f > 0 AND temperature_f <= 60 THEN 'Cold'
  WHEN temperature_f > 60 AND temperature_f <= 75 THEN 'Mild'
  WHEN temperature_f > 75 AND temperature_f <= 85 THEN 'Warm'
  WHEN temperature_f > 85 AND temperature_f <= 100 THEN 'Hot' END"""
WIND_BIN_SQL = """CASE WHEN wind_speed > 0 AND wind_speed <= 5 THEN 'Calm'
  WHEN wind_speed > 5 AND wind_speed <= 15 THEN 'Light'
  WHEN wind_speed > 15 AND wind_speed <= 25 THEN 'Moderate'
  WHEN wind_speed > 25 AND wind_speed <= 50 THEN 'Strong' END"""
INDEX_SQL = f"""CASE {SIMPLE_SQL} WHEN 'Clear' THEN 1.0 WHEN 'Partly Cloudy' THEN 0.7
  WHEN 'Cloudy' THEN 0.3 ELSE 0.1 END"""

for key, name, build, source, text in [
    ("cas15_solar_potential", "solar_potential", bk.solar_potential, "forecast", SOLAR_SQL),
    ("cas16_wind_potential", "wind_potential", bk.wind_potential, "wind_speed", WIND_SQL),
    ("cas17_demand_factor", "demand_factor", bk.demand_factor, "temperature_f", DEMAND_SQL),
    ("cas18_temp_category", "temp_category", bk.temp_bin, "temperature_f", TEMP_BIN_SQL),
    ("cas19_wind_category", "wind_category", bk.wind_bin, "wind_speed", WIND_BIN_SQL),
    ("cas20_weather_simple", "weather_simple", bk.weather_simple, "forecast", SIMPLE_SQL),
    ("cas21_solar_potential_index", "solar_potential_index",
     lambda c: bk.solar_potential_index(bk.weather_simple(c)), "forecast", R(INDEX_SQL)),
    ("sca6_word_tests", "has_cloud", lambda c: sc.contains_any(c, ["cloud", "fog"]), "forecast",
     "lower(forecast) LIKE '%cloud%' OR lower(forecast) LIKE '%fog%'"),
    ("sca18_wind_potential_index", "wind_potential_index", sc.wind_potential_index,
     "wind_speed", R("least(CAST(wind_speed AS DOUBLE) / 25, 1)")),
]:
    @query(key, f"SELECT obs_id, {text} AS {name} FROM obs")
    def _(t, build=build, name=name, source=source):
        return t.observations.select("obs_id", build(col(source)).alias(name))


# ---- scalar functions -------------------------------------------------------------------


@query(
    "sca1_clean_number",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN NULL "
    f"WHEN o_orderkey % 5 = 2 THEN NULL ELSE {R('o_totalprice')} END AS value FROM orders",
)
def _(t):
    k = col("o_orderkey") % 5
    text = (
        F.when(k == 0, ".").when(k == 1, "").when(k == 2, "n/a")
        .otherwise(col("o_totalprice").cast("string"))
    )
    return t.source("orders").select("o_orderkey", sc.clean_number(text).alias("value"))


@query(
    "sca2_coerce_number",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL "
    f"ELSE {R('o_totalprice')} END AS value FROM orders",
)
def _(t):
    text = F.when(col("o_orderkey") % 3 == 0, "none").otherwise(
        col("o_totalprice").cast("string")
    )
    return t.source("orders").select("o_orderkey", sc.coerce_number(text).alias("value"))


@query(
    "sca3_prefix",
    "SELECT o_orderkey, substr(o_orderpriority, 1, 5) AS short FROM orders",
)
def _(t):
    return t.source("orders").select(
        "o_orderkey", sc.prefix(col("o_orderpriority"), 5).alias("short")
    )


def _wind_text(t):
    w = col("wind_speed")
    text = (
        F.when(col("obs_id") % 3 == 0, F.concat(w, F.lit(" to "), w + 5, F.lit(" mph")))
        .when(col("obs_id") % 3 == 1, F.concat(w, F.lit(" mph")))
        .otherwise("calm")
    )
    return t.observations.select("obs_id", text.alias("wind"))


@query(
    "sca4_digits_number",
    "SELECT obs_id, CASE WHEN obs_id % 3 = 0 THEN CAST(CAST(wind_speed AS VARCHAR) || "
    "CAST(wind_speed + 5 AS VARCHAR) AS INTEGER) WHEN obs_id % 3 = 1 THEN wind_speed ELSE 0 END "
    "AS wind FROM obs",
)
def _(t):
    return _wind_text(t).select("obs_id", sc.digits_number(col("wind")).alias("wind"))


@query(
    "sca5_first_number",
    "SELECT obs_id, CASE WHEN obs_id % 3 < 2 THEN CAST(wind_speed AS DOUBLE) END AS wind FROM obs",
)
def _(t):
    return _wind_text(t).select("obs_id", sc.first_number(col("wind")).alias("wind"))


@query("sca7_text_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.source("events").select("event_id", sc.text_date(text).alias("day"))


@query(
    "sca8_week_month",
    "SELECT date, CAST(date_trunc('week', date) AS DATE) AS week_start, "
    "CAST(date_trunc('month', date) AS DATE) AS month_start FROM readings GROUP BY date",
)
def _(t):
    d = col("date")
    return t.readings.select("date").distinct().select(
        "date", sc.week_start(d).alias("week_start"), sc.month_start(d).alias("month_start")
    )


@query(
    "sca9_days_between",
    f"SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), {D}) AS INTEGER) AS days "
    "FROM orders",
)
def _(t):
    days = sc.days_between(col("o_orderdate").cast("date"), sc.as_date(AS_OF))
    return t.source("orders").select("o_orderkey", days.alias("days"))


@query(
    "sca10_date_shift",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 30 AS before, CAST(o_orderdate AS DATE) + 7 "
    "AS after FROM orders",
)
def _(t):
    d = col("o_orderdate").cast("date")
    return t.source("orders").select(
        "o_orderkey", F.date_sub(d, 30).alias("before"), F.date_add(d, 7).alias("after")
    )


@query(
    "sca11_day_name",
    "SELECT o_orderkey, dayname(o_orderdate) AS day_of_week, isodow(o_orderdate) >= 6 "
    "AS is_weekend FROM orders",
)
def _(t):
    d = col("o_orderdate").cast("date")
    return t.source("orders").select(
        "o_orderkey", sc.day_name(d).alias("day_of_week"), sc.is_weekend(d).alias("is_weekend")
    )


@query(
    "sca12_compact_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day, "
    "'v' || strftime(o_orderdate, '%Y%m%d') AS tag FROM orders",
)
def _(t):
    d = col("o_orderdate").cast("date")
    return t.source("orders").select(
        "o_orderkey", sc.compact_date(d).alias("day"), sc.version_tag(d).alias("tag")
    )


@query(
    "sca13_calendar",
    "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM "
    "(SELECT min(date) AS lo, max(date) AS hi FROM readings)",
)
def _(t):
    ends = t.readings.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return ends.select(F.explode(sc.calendar(col("lo"), col("hi"))).alias("day"))


@query(
    "sca14_arithmetic",
    f"SELECT o_orderkey, {R('abs(o_totalprice - 150000)')} AS distance, "
    f"{R('sqrt(o_totalprice)')} AS root, {R('power(o_totalprice / 1000, 2)')} AS square, "
    "round(o_totalprice / 1000, 0) AS thousands FROM orders",
)
def _(t):
    p = col("o_totalprice")
    return t.source("orders").select(
        "o_orderkey",
        F.abs(p - 150000).alias("distance"),
        F.sqrt(p).alias("root"),
        F.pow(p / 1000, 2).alias("square"),
        F.round(p / 1000, 0).alias("thousands"),
    )


@query("sca15_coalesce", f"SELECT date, {R('coalesce(oil_price_usd, 50)')} AS oil FROM feat")
def _(t):
    return t.features.select("date", F.coalesce("oil_price_usd", F.lit(50.0)).alias("oil"))


@query(
    "sca16_seasonal_factor",
    "SELECT o_orderkey, "
    + R("1 + 2e-1 * sin(2 * pi() * dayofyear(o_orderdate) / 365)")
    + " AS factor, "
    + R("60 + 10 * sin(2 * pi() * (dayofyear(o_orderdate) - 80) / 365)")
    + " AS base_temperature FROM orders",
)
def _(t):
    d = col("o_orderdate").cast("date")
    return t.source("orders").select(
        "o_orderkey",
        sc.seasonal_factor(d).alias("factor"),
        sc.seasonal_factor(d, 60, 10, 80).alias("base_temperature"),
    )


@query(
    "sca17_degree_days",
    f"SELECT obs_id, {R('greatest(temperature_f - 65, 0)')} AS cooling, "
    f"{R('greatest(65 - temperature_f, 0)')} AS heating FROM obs",
)
def _(t):
    x = col("temperature_f")
    return t.observations.select(
        "obs_id",
        sc.cooling_degree_days(x).alias("cooling"),
        sc.heating_degree_days(x).alias("heating"),
    )


@query(
    "sca19_casts",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, "
    "CAST(floor(o_totalprice) AS BIGINT) AS whole, CAST(o_custkey AS DOUBLE) AS cust FROM orders",
)
def _(t):
    return t.source("orders").select(
        "o_orderkey",
        col("o_orderdate").cast("date").alias("day"),
        F.floor("o_totalprice").cast("long").alias("whole"),
        col("o_custkey").cast("double").alias("cust"),
    )


@query(
    "sca20_noise",
    "SELECT date, CAST((date_diff('day', DATE '1970-01-01', date) * 7919) % 151 + 50 AS BIGINT) "
    "AS noise FROM readings GROUP BY date",
)
def _(t):
    days = t.readings.select("date").distinct()
    return days.select("date", sc.noise_from_date(col("date")).alias("noise"))


@query(
    "sca21_nested_access",
    "SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k "
    "FROM events",
)
def _(t):
    parsed = F.from_json("props", "k INT")
    return t.source("events").select(
        "event_id", F.coalesce(parsed["k"], F.lit(0)).alias("k")
    )


@query(
    "sca22_map_lookup",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'Sunny' WHEN 'click' THEN 'Partly Cloudy' "
    "ELSE 'Other' END AS label FROM events",
)
def _(t):
    names = {"view": "Sunny", "click": "Partly Cloudy"}
    label = sc.map_lookup(col("event_type"), names, F.lit("Other"))
    return t.source("events").select("event_id", label.alias("label"))


@query("sca23_load_time", "SELECT date, fuel_type, true AS stamped FROM gen")
def _(t):
    stamped = t.generation.withColumn("created_at", F.current_timestamp())
    return stamped.select(
        "date", "fuel_type", (F.current_timestamp() >= col("created_at")).alias("stamped")
    )


# ---- joins ------------------------------------------------------------------------------

FAN_SQL = """SELECT e.date, {total} AS total_generation_mwh,
  {temp} AS avg_temperature_f,
  {oil} AS oil_price_usd,
  {ipi} AS industrial_production_index,
  {une} AS ca_unemployment_rate,
  {price} AS avg_electricity_price{extra}
FROM gen e LEFT JOIN wx w ON e.date = w.date LEFT JOIN econ c ON e.date = c.date
LEFT JOIN price p ON e.date = p.date
WHERE e.date IS NOT NULL AND e.generation_mwh IS NOT NULL{more}
GROUP BY e.date HAVING sum(e.generation_mwh) > 0"""


def _ind(name):
    return f"max(CASE WHEN c.indicator = '{name}' THEN c.value END)"


def fan_sql(extra: str = "", more: str = "") -> str:
    return FAN_SQL.format(
        total=R("sum(e.generation_mwh)"),
        temp=R("avg(w.temperature_f)"),
        oil=R(_ind(cfg.OIL)),
        ipi=R(_ind(cfg.PRODUCTION)),
        une=R(_ind(cfg.UNEMPLOYMENT)),
        price=R("avg(p.price_per_mwh)"),
        extra=extra,
        more=more,
    )


@query("jn1_fan_out_join", fan_sql(", count(*) AS joined_rows"))
def _(t):
    joined = jn.fan_out_join(*t.raw)
    return joined.filter(col("generation_mwh") > 0).select(
        "date",
        (col("generation_mwh") * col("copies")).alias("total_generation_mwh"),
        "avg_temperature_f",
        *cfg.INDICATOR_COLUMNS.values(),
        "avg_electricity_price",
        (col("generation_rows") * col("copies")).alias("joined_rows"),
    )


CHAIN_SQL = f"""SELECT date, {R('total_generation_mwh')} AS total_generation_mwh,
  {R('avg_temperature_f')} AS avg_temperature_f, {R('avg_electricity_price')}
    AS avg_electricity_price
FROM (SELECT date, sum(generation_mwh) AS total_generation_mwh FROM gen GROUP BY date)
LEFT JOIN (SELECT date, avg(temperature_f) AS avg_temperature_f FROM wx GROUP BY date)
  USING (date)
LEFT JOIN (SELECT date, avg(price_per_mwh) AS avg_electricity_price FROM price GROUP BY date)
  USING (date)"""


@query("jn2_left_chain", CHAIN_SQL)
def _(t):
    return jn.left_chain(
        ag.daily_generation(t.generation),
        ag.daily_weather(t.weather).drop("avg_wind_speed"),
        ag.daily_price(t.price),
    )


# Per date the prediction made last; one without a time counts as made last of all.
LAST_PRED = """(SELECT date, arg_max(p, made) AS p FROM (
    SELECT date, {'model_version': model_version,
      'predicted_liquidity_millions': predicted_liquidity_millions} AS p,
      {'unknown': prediction_timestamp IS NULL,
       'at': coalesce(prediction_timestamp, TIMESTAMP '1970-01-01'), 'v': model_version} AS made
    FROM pred) GROUP BY date)"""
JN3_FROM = f"""feat mf LEFT JOIN (SELECT date, p.model_version AS model_version,
  p.predicted_liquidity_millions AS predicted_liquidity_millions FROM {LAST_PRED}) mp
  ON mf.date = mp.date"""


@query(
    "jn3_latest_prediction",
    f"SELECT mf.date, {R('mf.' + LIQ)} AS {LIQ}, mp.model_version, {R('mp.' + PRED)} AS {PRED} "
    f"FROM {JN3_FROM}",
)
def _(t):
    return jn.join_latest_prediction(t.features, t.predictions).select(
        "date", LIQ, "model_version", PRED
    )


@query(
    "jn4_all_predictions",
    f"SELECT date, {R(LIQ)} AS {LIQ}, model_version, {R(PRED)} AS {PRED} "
    "FROM feat LEFT JOIN pred USING (date)",
)
def _(t):
    return jn.join_all_predictions(t.features, t.predictions).select(
        "date", LIQ, "model_version", PRED
    )


@query(
    "jn5_evaluated",
    f"SELECT date, {R(LIQ)} AS {LIQ}, model_version, {R(PRED)} AS {PRED} "
    "FROM feat JOIN pred USING (date)",
)
def _(t):
    return jn.join_evaluated(t.features, t.predictions).select("date", LIQ, "model_version", PRED)


LATEST_MODEL_SQL = (
    "(SELECT model_version FROM pred ORDER BY prediction_timestamp DESC NULLS FIRST, "
    "model_version DESC LIMIT 1)"
)


@query(
    "jn6_latest_model",
    f"SELECT date, model_version, {R(PRED)} AS {PRED} FROM pred "
    f"WHERE model_version = {LATEST_MODEL_SQL}",
)
def _(t):
    return jn.restrict_to_latest_model(t.predictions).select("date", "model_version", PRED)


@query(
    "jn7_single_rows",
    f"SELECT * FROM (SELECT max(date) AS newest, count(*) AS days FROM feat), "
    f"(SELECT {R('avg(price_per_mwh)')} AS mean_price FROM price), "
    "(SELECT count(*) AS readings FROM readings)",
)
def _(t):
    return jn.attach_single_rows(
        t.features.agg(F.max("date").alias("newest"), F.count(F.lit(1)).alias("days")),
        t.price.agg(F.avg("price_per_mwh").alias("mean_price")),
        t.readings.agg(F.count(F.lit(1)).alias("readings")),
    )


@query(
    "jn8_feature_weather",
    f"SELECT date, {R('total_generation_mwh')} AS total_generation_mwh, wind_speed, forecast "
    "FROM feat LEFT JOIN wx USING (date)",
)
def _(t):
    periods = t.weather.select("date", "wind_speed", "forecast")
    return jn.left_join_feed(t.features, periods).select(
        "date", "total_generation_mwh", "wind_speed", "forecast"
    )


DAILY_PAIR_SQL = """(SELECT date, sum(generation_mwh) AS generation_mwh FROM gen GROUP BY date)
JOIN (SELECT date, avg(temperature_f) AS temperature_f FROM wx GROUP BY date) USING (date)"""


@query(
    "jn9_daily_weather",
    f"SELECT date, {R('generation_mwh')} AS generation_mwh, {R('temperature_f')} AS temperature_f "
    f"FROM {DAILY_PAIR_SQL}",
)
def _(t):
    return jn.join_daily_weather(t.generation, t.weather)


SYNC_SQL = """SELECT 'generation' AS source, count(*) AS n, min(date) AS first_date,
  max(date) AS last_date FROM gen WHERE date IN (SELECT date FROM common)
UNION ALL SELECT 'weather', count(*), min(date), max(date) FROM wx
  WHERE date IN (SELECT date FROM common)
UNION ALL SELECT 'economic', count(*), min(date), max(date) FROM econ
  WHERE date IN (SELECT date FROM common)"""
COMMON_SQL = (
    "(SELECT date FROM gen INTERSECT SELECT date FROM wx INTERSECT SELECT date FROM econ)"
)


@query("jn10_synchronize", SYNC_SQL.replace("(SELECT date FROM common)", COMMON_SQL))
def _(t):
    parts = jn.synchronize(t.generation, t.weather, t.economic)
    out = None
    for name in ("generation", "weather", "economic"):
        row = parts[name].agg(
            F.count(F.lit(1)).alias("n"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        ).select(F.lit(name).alias("source"), "n", "first_date", "last_date")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "jn11_availability",
    """SELECT date, max(g) AS generation, max(w) AS weather, max(e) AS economic FROM (
  SELECT date, 1 AS g, 0 AS w, 0 AS e FROM gen UNION ALL SELECT date, 0, 1, 0 FROM wx
  UNION ALL SELECT date, 0, 0, 1 FROM econ) GROUP BY date ORDER BY date DESC LIMIT 14""",
)
def _(t):
    return jn.availability(t.generation, t.weather, t.economic)


VW15_SQL = (
    "SELECT date, "
    + R("sum(generation_mwh)")
    + " AS total_generation_mwh, "
    + ", ".join(
        R(f"coalesce(sum(CASE WHEN fuel_type = '{f}' THEN generation_mwh END), 0)")
        + f" AS generation_{f.lower()}_mwh"
        for f in cfg.FUELS
    )
    + ", "
    + R(
        "coalesce(sum(CASE WHEN fuel_type <> 'NG' THEN generation_mwh END), 0) "
        "/ sum(generation_mwh) * 100"
    )
    + " AS renewable_percentage FROM {src} GROUP BY date"
)


@query("jn12_generation_merge", VW15_SQL.format(src="gen"))
def _(t):
    return feats.generation_features(t.generation)


@query(
    "jn13_lookup",
    "SELECT substr(o_orderpriority, 1, 1) AS code, CASE substr(o_orderpriority, 1, 1) "
    + " ".join(
        f"WHEN '{p}' THEN '{cfg.SERIES_NAMES[s]}'"
        for p, s in {"1": "DCOILWTICO", "2": "INDPRO", "3": "CAUR", "4": "GASREGW"}.items()
    )
    + " ELSE 'Series ' || substr(o_orderpriority, 1, 1) END AS label, count(*) AS n "
    "FROM orders GROUP BY ALL",
)
def _(t):
    names = {
        p: cfg.SERIES_NAMES[s]
        for p, s in {"1": "DCOILWTICO", "2": "INDPRO", "3": "CAUR", "4": "GASREGW"}.items()
    }
    codes = t.source("orders").select(F.substring("o_orderpriority", 1, 1).alias("code"))
    named = jn.lookup(codes, "code", names, "label", F.concat(F.lit("Series "), col("code")))
    return named.groupBy("code", "label").agg(F.count(F.lit(1)).alias("n"))


# ---- features ---------------------------------------------------------------------------


@query(
    "vw0a_ml_features_fan_out",
    f"""SELECT *, {R('total_generation_mwh * 5e-4 + coalesce(oil_price_usd, 50) * 5e-1 '
      '+ (date_diff(' + "'day', DATE '1970-01-01', date" + ') * 7919) % 151')}
  AS {LIQ} FROM ({fan_sql(more=f" AND e.date <= {D}")})""",
)
def _(t):
    return t.features_fan_out


@query("vw0b_ml_features", f"SELECT {FEAT_SQL} FROM feat")
def _(t):
    return t.features


WX_FEATURES = f"""SELECT {{lead}}, {R('temperature_f')} AS temperature_f,
  {R('wind_speed')} AS wind_speed_mph,
  {R('greatest(temperature_f - 65, 0)')} AS cooling_degree_days,
  {R('greatest(65 - temperature_f, 0)')} AS heating_degree_days,
  {R(INDEX_SQL)} AS solar_potential_index,
  {R('least(CAST(wind_speed AS DOUBLE) / 25, 1)')} AS wind_potential_index,
  {SIMPLE_SQL} AS weather_simple"""


@query(
    "vw13_weather_features",
    WX_FEATURES.format(lead="obs_id, date")
    + f", {TEMP_BIN_SQL} AS temp_category, {WIND_BIN_SQL} AS wind_category FROM obs",
)
def _(t):
    wide = feats.weather_features(t.observations)
    return wide.select("obs_id", *feats.WEATHER_EXPORT, "temp_category", "wind_category")


@query("vw13_weather_export", WX_FEATURES.format(lead="date") + " FROM wx")
def _(t):
    return feats.weather_export(t.weather)


@query(
    "vw14_energy_factors",
    f"SELECT obs_id, {SOLAR_SQL} AS solar_potential, {WIND_SQL} AS wind_potential, "
    f"{DEMAND_SQL} AS demand_factor FROM obs",
)
def _(t):
    return feats.energy_factors(t.observations).select(
        "obs_id", "solar_potential", "wind_potential", "demand_factor"
    )


@query("vw15_generation_features", VW15_SQL.format(src="readings"))
def _(t):
    return feats.generation_features(t.readings)


@query(
    "vw16_synchronized",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh FROM readings "
    f"WHERE date IN {COMMON_SQL}",
)
def _(t):
    parts = feats.synchronized_training_data(t.readings, t.weather, t.economic)
    return parts["generation"].select("date", "fuel_type", "generation_mwh")


@query(
    "vw17_patterns",
    f"SELECT count(*) AS days, CASE WHEN count(*) >= 3 THEN "
    f"{R('corr(generation_mwh, temperature_f)')} END AS correlation FROM {DAILY_PAIR_SQL}",
)
def _(t):
    return views.energy_weather_patterns(t.generation, t.weather)

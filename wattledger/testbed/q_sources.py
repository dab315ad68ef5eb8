"""Queries for payload parsing, file loads and sinks.

Responses are made from all rows of the test tables, land as JSON files with one response each
in the session's shared folder, and are read from there, as other files are.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

from pyspark.sql import functions as F

from wattledger import schemas
from wattledger import settings as cfg
from wattledger.functions import scalars as sc
from wattledger.operators import aggregates as ag
from wattledger.operators import filters as fl
from wattledger.operators import joins as jn
from wattledger.session import scratch_path
from wattledger.sources import commits, files, payloads, sinks
from wattledger.streaming import incremental
from wattledger.testbed.q_tables import D, FEAT_SQL, col
from wattledger.testbed.registry import R, query
from wattledger.testbed.standins import AS_OF, SERIES_OF_PRIORITY, choose

RUN = AS_OF


#: Records in one response, about.
PAGE = 1000


#: Responses that one task writes, about: creating a file costs more than its bytes.
WRITTEN = 100
#: Files renamed at a time; each waits for the file system.
MOVES = 8


def tasks_for(t, responses):
    """Tasks for so many responses, so that no task has many more files than another."""
    return max(t.spark.sparkContext.defaultParallelism, responses // WRITTEN)


def landed_json(t, responses, name=None, text=False):
    """One file for each row of ``responses``, written by as many tasks as that has partitions;
    named ``<name>_<number>.json`` if it has a ``name`` column. Returns the folder."""
    path = scratch_path(t.spark, "responses")
    written = scratch_path(t.spark, "written") if name else path
    writer = responses.write.option("maxRecordsPerFile", 1)
    writer = writer.partitionBy(name) if name else writer
    (writer.text if text else writer.json)(written)
    if name:
        renamed(t, written, path)
    return path


def renamed(t, written, path):
    """Move the files of ``<column>=<name>`` folders in ``written`` to ``<path>/<name>_<number>.json``."""
    _, fs = commits.located(t.spark, path)
    jvm = t.spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(place(path))
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(place(f"{written}/*/part-*")))
    found = sorted((p.toString(), p) for p in paths)
    moves = []
    for folder, files_of in groupby(found, lambda f: f[0].rpartition("/")[0].rpartition("/")[2]):
        moves += [(f, f"{path}/{folder.partition('=')[2]}_{i}.json") for i, (_, f) in enumerate(files_of)]

    def move(pair):
        if not fs.rename(pair[0], place(pair[1])):
            raise OSError(f"cannot move {pair[0].toString()} to {pair[1]}")

    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(move, moves))


# ---- payloads ---------------------------------------------------------------------------


def generation_responses(t):
    """Every reading as two records, the second with an unusable value."""
    def record(r, value):
        return F.struct(
            F.date_format(r.date, "yyyy-MM-dd").alias("period"),
            r.fuel_type.alias("fueltype"),
            value.alias("value"),
            r.respondent.alias("respondent"),
        )

    def records(r):
        return F.array(record(r, r.generation_mwh.cast("string")), record(r, F.lit("n/a")))

    pages = max(1, t.source("lineitem").count() // PAGE)
    page = F.pmod(F.xxhash64("date", "fuel_type", "generation_mwh", "respondent"), F.lit(pages))
    # Dealt out by page first, so that a page is collected once and its records are made there.
    dealt = t.readings.withColumn("page", page).repartition(tasks_for(t, pages), "page")
    packed = F.collect_list(F.struct("date", "fuel_type", "generation_mwh", "respondent"))
    data = F.flatten(F.transform(packed, records)).alias("data")
    return dealt.groupBy("page").agg(F.struct(data).alias("response")).drop("page")


@query(
    "src1_generation",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, 'EIA' AS data_source "
    "FROM readings",
)
def _(t):
    return payloads.read_generation(t.spark, landed_json(t, generation_responses(t)))


@query(
    "src1_generation_respondent",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, respondent FROM readings",
)
def _(t):
    return payloads.read_generation(t.spark, landed_json(t, generation_responses(t)), with_respondent=True)


LONG_TEXT = " with light winds in the morning and again late at night"


def observation_pages(t, **arrays):
    """One row for each page of observations: a list of ``arrays``' values for each name."""
    page = F.expr(f"obs_id div {PAGE}").alias("page")
    packed = F.collect_list(F.struct(*[c.alias(n) for n, c in arrays.items()])).alias("x")
    return t.observations.groupBy(page).agg(packed)


def forecast_files(t):
    w, k = col("wind_speed"), col("obs_id") % 3
    wind = F.when(k == 0, F.concat(w, F.lit(" to "), w + 5, F.lit(" mph"))).when(
        k == 1, F.concat(w, F.lit(" mph"))
    )
    pages = observation_pages(
        t,
        name=col("period"),
        startTime=F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T06:00:00-08:00")),
        temperature=F.when(col("obs_id") % 10 != 0, F.floor("temperature_f").cast("string")),
        windSpeed=wind,
        windDirection=F.when(k == 0, "SW"),
        shortForecast=F.concat("forecast", F.lit(LONG_TEXT)),
        detailedForecast=col("forecast"),
    )
    return landed_json(t, pages.select(F.struct(col("x").alias("periods")).alias("properties")))


TEMP_SQL = "CASE WHEN obs_id % 10 <> 0 THEN CAST(floor(temperature_f) AS INTEGER) ELSE 0 END"


@query(
    "src2_forecast",
    f"SELECT date, {TEMP_SQL} AS temperature_f, CASE WHEN obs_id % 3 < 2 THEN wind_speed ELSE 0 "
    f"END AS wind_speed, forecast || '{LONG_TEXT}' AS forecast, "
    "'NOAA' AS data_source FROM obs",
)
def _(t):
    return payloads.read_forecast(t.spark, forecast_files(t))


@query(
    "src2_forecast_digits",
    f"SELECT date, {TEMP_SQL} AS temperature_f, CASE WHEN obs_id % 3 = 0 THEN "
    "CAST(CAST(wind_speed AS VARCHAR) || CAST(wind_speed + 5 AS VARCHAR) AS INTEGER) "
    "WHEN obs_id % 3 = 1 THEN wind_speed ELSE 0 END AS wind_speed, "
    f"substr(forecast || '{LONG_TEXT}', 1, 50) AS forecast, 'NOAA' AS data_source FROM obs",
)
def _(t):
    return payloads.read_forecast(t.spark, forecast_files(t), wind="digits", max_chars=50)


@query(
    "src3_forecast_wide",
    f"""SELECT date, period AS period_name, {TEMP_SQL} AS temperature_f,
  CASE obs_id % 3 WHEN 0 THEN wind_speed || ' to ' || (wind_speed + 5) || ' mph'
    WHEN 1 THEN wind_speed || ' mph' ELSE 'Unknown' END AS wind_speed,
  CASE WHEN obs_id % 3 = 0 THEN 'SW' ELSE 'Unknown' END AS wind_direction,
  forecast || '{LONG_TEXT}' AS forecast, forecast AS detailed_forecast FROM obs""",
)
def _(t):
    return payloads.read_forecast_wide(t.spark, forecast_files(t))


def series_files(t):
    """Each order as a value and a missing value of the series that its priority picks."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    items = F.array(
        F.struct(day, col("o_totalprice").cast("string").alias("value")),
        F.struct(day, F.lit(".").alias("value")),
    )
    series = F.coalesce(choose(F.substring("o_orderpriority", 1, 1), SERIES_OF_PRIORITY), F.lit("OTHER"))
    page = F.expr(f"o_orderkey div {4 * PAGE}").alias("page")
    orders = t.source("orders").select(series.alias("series"), page, items.alias("items"))
    tasks = tasks_for(t, orders.count() // PAGE)
    grouped = orders.repartition(tasks, "series", "page").groupBy("series", "page")
    pages = grouped.agg(F.flatten(F.collect_list("items")).alias("observations"))
    return landed_json(t, pages.drop("page"), "series")


SERIES_CASE = "CASE substr(o_orderpriority, 1, 1) {} ELSE {} END"


def series_case(table, other):
    whens = " ".join(f"WHEN '{p}' THEN '{table[s]}'" for p, s in SERIES_OF_PRIORITY.items())
    return SERIES_CASE.format(whens, f"'{other}'")


@query(
    "src4_series",
    f"SELECT CAST(o_orderdate AS DATE) AS date, {series_case(cfg.SERIES_INDICATORS, 'OTHER')} "
    f"AS indicator, {R('o_totalprice')} AS value, 'FRED' AS data_source FROM orders",
)
def _(t):
    return payloads.read_series(t.spark, series_files(t))


@query(
    "src5_series_described",
    f"SELECT CAST(o_orderdate AS DATE) AS date, "
    f"{series_case({s: s for s in cfg.SERIES_NAMES}, 'OTHER')} AS series_id, "
    f"{series_case(cfg.SERIES_NAMES, 'OTHER')} AS indicator_name, {R('o_totalprice')} AS value, "
    f"{series_case(cfg.SERIES_UNITS, 'Units')} AS units FROM orders",
)
def _(t):
    return payloads.read_series_described(t.spark, series_files(t))


@query(
    "src6_historical_weather",
    f"""SELECT date, CASE WHEN m <> 0 THEN round_even(m, 1) END AS temperature_f,
  hi AS temperature_max_f, lo AS temperature_min_f, CAST(wind_speed AS DOUBLE) AS wind_speed,
  {R('temperature_f / 100')} AS precipitation_inch, code AS weather_code,
  CASE code {" ".join(f"WHEN {k} THEN '{v}'" for k, v in cfg.WEATHER_CODES.items())}
    ELSE 'Weather code ' || code END AS forecast, 'Open-Meteo' AS data_source
FROM (SELECT *, CASE WHEN hi <> 0 AND lo <> 0 THEN (hi + lo) / 2
          ELSE CAST(obs_id % 50 AS DOUBLE) / 2 END AS m
  FROM (SELECT *, CASE WHEN obs_id % 7 <> 0 THEN CAST(obs_id % 100 AS DOUBLE) / 2 END AS hi,
          CAST(obs_id % 37 AS DOUBLE) / 2 AS lo, CAST(obs_id % 100 AS INTEGER) AS code FROM obs))""",
)
def _(t):
    k = col("obs_id")
    values = {
        "time": F.date_format("date", "yyyy-MM-dd"),
        "temperature_2m_max": F.when(k % 7 != 0, (k % 100).cast("double") / 2),
        "temperature_2m_min": (k % 37).cast("double") / 2,
        "temperature_2m_mean": (k % 50).cast("double") / 2,
        "windspeed_10m_max": col("wind_speed").cast("double"),
        "precipitation_sum": col("temperature_f") / 100,
        "weathercode": (k % 100).cast("int"),
    }
    pages = observation_pages(t, **values)
    daily = F.struct(*[col(f"x.{n}").alias(n) for n in values]).alias("daily")
    return payloads.read_historical_weather(t.spark, landed_json(t, pages.select(daily)))


ERRORS = (
    "CASE {k} WHEN 0 THEN 'Missing ''response'' key in API data' WHEN 1 THEN "
    "'Missing ''data'' key in response' WHEN 2 THEN 'No data found in API response' END"
)


def texts_of(k):
    """A response text for each remainder of four, the last one valid."""
    return (
        F.when(k == 0, '{"error": "none"}')
        .when(k == 1, '{"response": {"total": 0}}')
        .when(k == 2, '{"response": {"data": []}}')
        .otherwise('{"response": {"data": [{"period": "1999-01-01"}]}}')
    )


@query(
    "src7_validate_payload",
    f"SELECT o_orderkey, o_orderkey % 4 = 3 AS is_valid, {ERRORS.format(k='o_orderkey % 4')} AS error FROM orders",
)
def _(t):
    landed = t.source("orders").select(
        "o_orderkey", F.from_json(texts_of(col("o_orderkey") % 4), schemas.GENERATION_PAYLOAD).alias("j")
    )
    return payloads.validate_payload(landed.select("o_orderkey", "j.*"), "o_orderkey")


@query(
    "src7_validate_files",
    f"SELECT page, page % 4 = 3 AS is_valid, {ERRORS.format(k='page % 4')} AS error "
    "FROM (SELECT DISTINCT o_orderkey // 250 AS page FROM orders)",
)
def _(t):
    orders = t.source("orders")
    pages = orders.select(F.expr("o_orderkey div 250").alias("page")).distinct()
    pages = pages.repartition(tasks_for(t, orders.count() // 250))  # not by page: an equal exchange is merged
    folder = landed_json(t, pages.select("page", texts_of(col("page") % 4).alias("value")), "page", text=True)
    page = payloads.series_of_file(col("source_file")).cast("long").alias("page")
    return payloads.validate_files(t.spark, folder).select(page, "is_valid", "error")


@query(
    "src8_feed_filter",
    f"""SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, respondent FROM readings
WHERE respondent = 'CAL' AND fuel_type IN ('NG', 'SUN') AND date BETWEEN {D} - 30 AND {D}
ORDER BY readings.date DESC, fuel_type, readings.generation_mwh LIMIT 100""",
)
def _(t):
    start = F.date_sub(sc.as_date(AS_OF), 30)
    return payloads.feed_filter(t.readings, start, AS_OF, fuels=["NG", "SUN"], limit=100)


@query(
    "src8_feed_filter_all",
    f"""SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, respondent FROM readings
WHERE respondent = 'CAL' AND fuel_type IN ('NG', 'SUN') AND date BETWEEN {D} - 730 AND {D}""",
)
def _(t):
    start = F.date_sub(sc.as_date(AS_OF), 730)
    return payloads.feed_filter(t.readings, start, AS_OF, fuels=["NG", "SUN"])


# ---- file loads -------------------------------------------------------------------------


def landed(t, df, table):
    """``df`` as the run date's CSV files of ``table``; returns the landing folder."""
    path = scratch_path(t.spark, table)
    sinks.land_raw(df, path, RUN, "csv")
    return path


def raw_frames(t):
    tag = {k: F.lit(v).alias("data_source") for k, v in schemas.SOURCE_TAGS.items()}
    return {
        "raw_eia_data": t.generation.select("*", tag["raw_eia_data"]),
        "raw_weather_data": t.weather.select(
            "date", "temperature_f", "wind_speed", "forecast", tag["raw_weather_data"]
        ),
        "raw_economic_data": t.economic.select("*", tag["raw_economic_data"]),
        "raw_price_data": t.price.select(
            "date", "price_type", "price_per_mwh", "market", tag["raw_price_data"]
        ),
    }


LOADS = {
    "raw_eia_data": (
        "generation",
        f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, 'EIA' AS data_source "
        "FROM gen",
    ),
    "raw_weather_data": (
        "weather",
        "SELECT date, temperature_f, wind_speed, forecast, 'NOAA' AS data_source FROM wx",
    ),
    "raw_economic_data": (
        "economic",
        f"SELECT date, indicator, {R('value')} AS value, 'FRED' AS data_source FROM econ",
    ),
    "raw_price_data": (
        "price",
        f"SELECT date, price_type, {R('price_per_mwh')} AS price_per_mwh, market, "
        "'SIMULATED' AS data_source FROM price",
    ),
}


def as_doubles(df):
    return df.select(
        *[
            col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else f.name
            for f in df.schema.fields
        ]
    )


@query("src9_read_csv", LOADS["raw_economic_data"][1])
def _(t):
    frame = raw_frames(t)["raw_economic_data"]
    path = scratch_path(t.spark, "csv")
    frame.write.csv(path, header=True)
    return as_doubles(files.read_csv(t.spark, path, files.load_schema("raw_economic_data")))


for table, (short, text) in LOADS.items():
    @query(f"src10_load_{short}", text)
    def _(t, table=table):
        landing = landed(t, raw_frames(t)[table], table)
        return as_doubles(files.load_raw(t.spark, landing, table, RUN).drop("created_at"))


@query("src10_incremental_load", LOADS["raw_price_data"][1])
def _(t):
    landing = landed(t, raw_frames(t)["raw_price_data"], "raw_price_data")
    target, marks = scratch_path(t.spark, "table"), scratch_path(t.spark, "marks")
    for _ in range(2):  # the second run finds nothing new
        incremental.load_new_files(t.spark, landing, "raw_price_data", target, marks)
    return as_doubles(t.spark.read.parquet(target).drop("created_at"))


@query("src10_beside_other_writers", f"SELECT * FROM ({LOADS['raw_economic_data'][1]}) UNION ALL SELECT * FROM ({LOADS['raw_economic_data'][1]})")
def _(t):
    name, frame = "raw_economic_data", raw_frames(t)["raw_economic_data"]
    target, marks = scratch_path(t.spark, "table"), scratch_path(t.spark, "marks")
    half = F.dayofmonth("date") % 2 == 0
    typed = schemas.select_typed(frame, name)
    typed.filter(half).write.parquet(target)  # another writer before the load and one after it
    incremental.load_new_files(t.spark, landed(t, frame, name), name, target, marks)
    typed.filter(~half).write.mode("append").parquet(target)
    return as_doubles(commits.read(t.spark, target, schemas.TABLES[name]).drop("created_at"))


@query(
    "src10_rejected_records",
    "SELECT CAST(count(*) FILTER (WHERE l_orderkey % 9 > 0) AS BIGINT) AS rows, "
    "CAST(count(*) FILTER (WHERE l_orderkey % 9 = 0) AS BIGINT) AS rejected FROM lineitem",
)
def _(t):
    """Every line as a CSV record, each ninth order's with a text for a number."""
    name = "raw_eia_data"
    value = F.when(col("l_orderkey") % 9 == 0, "many").otherwise(col("l_quantity").cast("string"))
    frame = t.source("lineitem").select(
        col("l_shipdate").cast("date").alias("date"), F.lit("NG").alias("fuel_type"),
        value.alias("generation_mwh"), F.lit("EIA").alias("data_source"))
    target, marks, bad = (scratch_path(t.spark, n) for n in ("table", "marks", "rejected"))
    incremental.load_new_files(t.spark, landed(t, frame, name), name, target, marks, rejected=bad)
    kept = commits.read(t.spark, target, schemas.TABLES[name]).agg(F.count(F.lit(1)).alias("rows"))
    refused = t.spark.read.schema(incremental.REJECTED).parquet(bad).filter("record like '%many%'")
    return jn.attach_single_rows(kept, refused.agg(F.count(F.lit(1)).alias("rejected")))


def stream_query(key, sql, name, files_of):
    """The rows that a stream of landed responses appends to a raw table."""
    @query(key, sql)
    def _(t):
        target, marks = scratch_path(t.spark, "table"), scratch_path(t.spark, "marks")
        landing = files_of(t)
        for _ in range(2):
            incremental.load_new_responses(t.spark, landing, name, target, marks)
        return as_doubles(commits.read(t.spark, target, schemas.TABLES[name]).drop("created_at"))


stream_query(
    "src1_response_stream",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, 'EIA' AS data_source FROM readings",
    "raw_eia_data", lambda t: landed_json(t, generation_responses(t)))
stream_query(
    "src2_response_stream",
    f"SELECT date, {TEMP_SQL} AS temperature_f, CASE WHEN obs_id % 3 < 2 THEN wind_speed ELSE 0 "
    f"END AS wind_speed, forecast || '{LONG_TEXT}' AS forecast, 'NOAA' AS data_source FROM obs",
    "raw_weather_data", forecast_files)
stream_query(
    "src4_response_stream",
    f"SELECT CAST(o_orderdate AS DATE) AS date, {series_case(cfg.SERIES_INDICATORS, 'OTHER')} "
    f"AS indicator, {R('o_totalprice')} AS value, 'FRED' AS data_source FROM orders",
    "raw_economic_data", series_files)


PRED_SQL = (
    "SELECT date, floor(predicted_liquidity_millions * 10) / 10 "
    "AS predicted_liquidity_millions, model_version FROM pred"
)


@query("src11_load_predictions", PRED_SQL)
def _(t):
    frame = t.predictions.withColumn(
        "predicted_liquidity_millions", F.floor(col("predicted_liquidity_millions") * 10) / 10
    )
    landing = landed(t, frame, "ml_predictions")
    loaded = files.load_predictions(t.spark, landing, RUN)
    return as_doubles(loaded).select("date", "predicted_liquidity_millions", "model_version")


TRAINING = [*schemas.FEATURES, schemas.TARGET]
EXPORT_SQL = f"""SELECT {", ".join(f"{R(c)} AS {c}" for c in TRAINING)} FROM feat
WHERE total_generation_mwh IS NOT NULL AND avg_temperature_f IS NOT NULL
  AND oil_price_usd IS NOT NULL AND liquidity_need_millions IS NOT NULL"""


@query("src12_read_training", EXPORT_SQL)
def _(t):
    path = scratch_path(t.spark, "training")
    sinks.export_training(t.features, path)
    return files.read_training(t.spark, path).drop("date")


@query(
    "src13_load_saved_generation",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh, respondent FROM readings",
)
def _(t):
    path = scratch_path(t.spark, "saved")
    stamped = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 00:16:47.415921"))
    t.readings.withColumn("date", stamped).write.csv(path, header=True)
    return files.load_saved_generation(t.spark, path)


# ---- sinks ------------------------------------------------------------------------------


@query("snk1_dated_landing", LOADS["raw_eia_data"][1])
def _(t):
    path = scratch_path(t.spark, "landing")
    frame = raw_frames(t)["raw_eia_data"]
    for run in ("1999-01-29", RUN, RUN):  # the repeated date is replaced, not doubled
        sinks.land_raw(frame, path, run)
    back = t.spark.read.parquet(path)
    return back.filter(col("run_date") == sc.as_date(RUN)).drop("run_date")


@query("snk2_export_training", EXPORT_SQL)
def _(t):
    return sinks.training_rows(t.features)


@query(
    "snk2_export_newest",
    f"""SELECT {", ".join(f"{R(c)} AS {c}" for c in TRAINING)}
FROM (SELECT date, total_generation_mwh, coalesce(avg_temperature_f, 60) AS avg_temperature_f,
    coalesce(oil_price_usd, 50) AS oil_price_usd, industrial_production_index, avg_electricity_price,
    liquidity_need_millions FROM feat) f ORDER BY f.date DESC LIMIT 1000""",
)
def _(t):
    """The newest 1,000 training rows, of days with stand-ins for what is missing."""
    return sinks.training_rows(t.features.fillna({"avg_temperature_f": 60.0, "oil_price_usd": 50.0}), n=1000)


def _table_name(t, stem):
    return scratch_path(t.spark, stem).rsplit("/", 1)[-1].replace("-", "_")


@query("snk3_create_or_replace", f"SELECT {FEAT_SQL} FROM feat")
def _(t):
    path = scratch_path(t.spark, "ml_features")
    name = _table_name(t, "ml_features")
    sinks.create_or_replace(t.features.limit(0), name, path)
    sinks.create_or_replace(t.features, name, path)
    return t.spark.table(name)


@query(
    "snk4_append",
    f"SELECT DATE '{AS_OF}' AS check_date, 'ml_features' AS table_name, "
    "'row_count' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value, "
    "CASE WHEN count(*) >= 30 THEN 'PASS' ELSE 'FAIL' END AS status, "
    f"CAST(30 AS DOUBLE) AS threshold_value FROM feat WHERE date >= {D} - 30",
)
def _(t):
    from wattledger.operators import quality

    prefix = _table_name(t, "w") + "_"
    sinks.create_tables(t.spark, scratch_path(t.spark, "tables"), prefix)
    name = prefix + "data_quality_metrics"
    checked = quality.row_count(t.features, AS_OF)
    sinks.append(schemas.select_typed(checked, "data_quality_metrics"), name)
    return as_doubles(t.spark.table(name).drop("created_at"))


@query(
    "snk5_save_results",
    "SELECT forecast, count(*) AS n FROM obs GROUP BY forecast",
)
def _(t):
    folder = scratch_path(t.spark, "results")
    counts = ag.value_counts(t.observations, "forecast")
    names = sinks.save_results({"forecasts": counts, "nothing": counts.limit(0)}, folder)
    assert names == ["forecasts"], names
    return t.spark.read.csv(f"{folder}/forecasts", header=True, schema="forecast string, n long")


@query(
    "snk6_json_summary",
    f"SELECT count(*) AS total_records, {R('sum(generation_mwh)')} AS total_generation_mwh "
    "FROM readings",
)
def _(t):
    path = scratch_path(t.spark, "summary")
    sinks.write_summary(ag.generation_summary(t.readings), path)
    schema = "total_records long, total_generation_mwh double"
    return t.spark.read.schema(schema).json(path)


@query(
    "snk7_typed_tables",
    "SELECT date, CAST(total_generation_mwh AS DOUBLE) AS total_generation_mwh FROM feat",
)
def _(t):
    prefix = _table_name(t, "w") + "_"
    sinks.create_tables(t.spark, scratch_path(t.spark, "tables"), prefix)
    name = prefix + "ml_features"
    sinks.append(schemas.select_typed(t.features, "ml_features"), name)
    return as_doubles(t.spark.table(name)).select("date", "total_generation_mwh")


@query(
    "snk7_date_clustered",
    f"SELECT date, fuel_type, {R('generation_mwh')} AS generation_mwh FROM readings "
    f"WHERE date >= {D} - 30",
)
def _(t):
    path = scratch_path(t.spark, "clustered")
    sinks.write_clustered(t.readings.select("date", "fuel_type", "generation_mwh"), path)
    return fl.look_back(t.spark.read.parquet(path), AS_OF, 30)



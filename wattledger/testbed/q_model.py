"""Queries for the model operators and the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattledger import schemas
from wattledger import settings as cfg
from wattledger.operators import metrics, normal_equations, quality
from wattledger.operators import joins as jn
from wattledger.functions import scalars
from wattledger.plans import features as feats
from wattledger.plans import incremental_features
from wattledger.plans import model as ml
from wattledger.session import materialize, scratch_path
from wattledger.testbed.q_tables import ERR, LIQ, PRED, D, col
from wattledger.testbed.registry import R, query
from wattledger.testbed.standins import AS_OF, GENERATION_WEIGHT

NUMBERS = [c for c in feats.ML_COLUMNS if c != "date"]
DATED = ["date", *schemas.FEATURES, schemas.TARGET]

# ---- model ------------------------------------------------------------------------------


def training(t):
    """All feature days with their features imputed, newest first."""
    return ml.prepare(t.features.select(*DATED))


def stored_training(t):
    return materialize(training(t), "training")


def impute_sql(c: str) -> str:
    ahead = (
        f"last_value({c} IGNORE NULLS) OVER (ORDER BY date DESC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    back = (
        f"first_value({c} IGNORE NULLS) OVER (ORDER BY date DESC "
        "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    )
    return R(f"coalesce({ahead}, {back})") + f" AS {c}"


@query(
    "mla1_impute",
    f"SELECT date, {', '.join(impute_sql(c) for c in schemas.FEATURES)}, {R(LIQ)} AS {LIQ} "
    "FROM feat",
)
def _(t):
    return training(t)


@query(
    "mla2_split",
    "SELECT CAST(n - ceil(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_train, "
    "CAST(ceil(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_validation "
    "FROM (SELECT count(*) AS n FROM feat)",
)
def _(t):
    parts = ml.split(t.features)
    return parts.agg(
        F.count(F.when(~col("is_validation"), 1)).alias("n_train"),
        F.count(F.when(col("is_validation"), 1)).alias("n_validation"),
    )


RANKED = "md5(CAST(date AS VARCHAR) || '|42')"


@query(
    "mla2_split_rows",
    f"SELECT date, row_number() OVER (ORDER BY {RANKED}) <= ceil(count(*) OVER () * CAST(0.2 AS DOUBLE)) "
    "AS is_validation FROM feat",
)
def _(t):
    return ml.split(t.features).select("date", "is_validation")


@query(
    "mla3_standardize",
    "SELECT date, "
    + ", ".join(
        R(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}"
        for c in ("total_generation_mwh", "liquidity_need_millions")
    )
    + " FROM feat",
)
def _(t):
    names = ["total_generation_mwh", "liquidity_need_millions"]
    return ml.standardize(t.features, t.features, names).select("date", *names)


def fit_sql(body: str, alpha: float = 0.0, split: bool = True) -> str:
    """``body`` over ``fitted`` (date, is_validation, y, r): residuals r of the regression of y on
    the standardised features, fitted on the training part (or on all rows).

    The features are made orthogonal one after the other, and y is projected on each. Ridge
    adds a row sqrt(alpha) for each feature. The row without a date holds the newest known
    features and y = 0, so its prediction is -r.
    """
    xs = list(enumerate(schemas.FEATURES))
    held = f"row_number() OVER (ORDER BY {RANKED}) <= ceil(count(*) OVER () * CAST(0.2 AS DOUBLE))"
    plain = [
        f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY date DESC ROWS BETWEEN UNBOUNDED "
        f"PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (ORDER BY date DESC "
        f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x{i}" for i, c in xs]
    newest = [f"arg_max({c}, date) FILTER (WHERE {c} IS NOT NULL) AS x{i}" for i, c in xs]
    steps = [
        f"parts AS (SELECT date, {held if split else 'false'} AS is_validation, {LIQ} AS y, {', '.join(plain)} FROM feat)",
        "stats AS (SELECT avg(y) AS my, "
        + ", ".join(f"avg(x{i}) AS m{i}, coalesce(nullif(stddev_pop(x{i}), 0), 1) AS s{i}" for i, _ in xs)
        + " FROM parts WHERE NOT is_validation)",
        f"ahead AS (SELECT CAST(NULL AS DATE) AS date, true AS is_validation, CAST(0 AS DOUBLE) AS y, {', '.join(newest)} FROM feat)",
        "g0 AS (SELECT date, is_validation, y, y - my AS r, "
        + ", ".join(f"(x{i} - m{i}) / s{i} AS a{i}" for i, _ in xs)
        + " FROM (SELECT * FROM parts UNION ALL SELECT * FROM ahead), stats"
        + (
            " UNION ALL SELECT DATE '1900-01-01', false, 0, 0, "
            + ", ".join(f"CASE WHEN k = {i} THEN sqrt(CAST({alpha} AS DOUBLE)) ELSE 0 END" for i, _ in xs)
            + f" FROM range({len(xs)}) q(k)" if alpha else "")
        + ")",
    ]
    for i, _ in xs:
        def share(v, i=i):
            return (
                f"coalesce(sum(a{i} * {v}) FILTER (WHERE NOT is_validation) OVER () / "
                f"nullif(sum(a{i} * a{i}) FILTER (WHERE NOT is_validation) OVER (), 0), 0)")
        later = [f"a{j} - a{i} * {share(f'a{j}')} AS a{j}" for j, _ in xs if j > i]
        columns = ["date", "is_validation", "y", f"r - a{i} * {share('r')} AS r", *later]
        steps.append(f"g{i + 1} AS (SELECT {', '.join(columns)} FROM g{i})")
    steps.append(f"fitted AS (SELECT * FROM g{len(xs)} WHERE date IS NULL OR date > DATE '1900-01-01')")
    return "WITH " + ",\n".join(steps) + "\n" + body + " /* feat */"


COMPARED = (
    f"SELECT date, {R('y')} AS actual, {R('y - r')} AS predicted, {R('abs(r)')} AS error "
    "FROM fitted WHERE date IS NOT NULL"
)


def _fit(t, model_type, **params):
    return ml.LiquidityModel(model_type, params=params).train(training(t))


for key, model_type, text in [
    ("mla4_linear_regression", "linear_regression", fit_sql(COMPARED)),
    ("mla5_ridge", "ridge", fit_sql(COMPARED, cfg.RIDGE_ALPHA)),
    ("mla6_random_forest", "random_forest", None),
]:
    @query(key, text)
    def _(t, model_type=model_type):
        rows = stored_training(t)
        return ml.compare(ml.LiquidityModel(model_type).train(rows, stored=True), rows)


def by_day_sums(t):
    """Moments of each day's training rows, stored, as a daily run would keep them."""
    sums = normal_equations.moments(training(t), schemas.FEATURES, LIQ, by=["date"])
    return materialize(sums, "moments")


for key, alpha in [("mla4_normal_equations", 0.0), ("mla5_normal_equations", cfg.RIDGE_ALPHA)]:
    @query(key, fit_sql(COMPARED, alpha, split=False))
    def _(t, alpha=alpha):
        """Fitted from the added-up sums of all days, without a pass over the rows."""
        row = normal_equations.merged(by_day_sums(t)).first().asDict()
        found = normal_equations.solve(row, schemas.FEATURES, LIQ, alpha)
        scored = training(t).withColumn("predicted", found.predicted())
        return scored.select(
            "date", col(LIQ).alias("actual"), "predicted", F.abs(col(LIQ) - col("predicted")).alias("error"))


@query(
    "mla4_least_squares",
    f"SELECT {R('regr_slope(y, x) * stddev_pop(x)')} AS weight, {R('avg(y)')} AS intercept FROM "
    f"(SELECT total_generation_mwh AS x, {LIQ} AS y FROM feat)",
)
def _(t):
    model = ml.LiquidityModel(features=["total_generation_mwh"])
    weights, intercept = model.fit(t.features).coefficients()
    # One row of fitted numbers; the fit itself ran over the whole feature table.
    return t.spark.range(1).select(
        F.lit(weights[0]).alias("weight"), F.lit(intercept).alias("intercept")
    )


METRIC_SQL = f"""SELECT model_version, {R('avg(e)')} AS mae, {R('sqrt(avg(e * e))')} AS rmse,
  {R(f'1 - sum(e * e) / sum(({LIQ} - m) * ({LIQ} - m))')} AS r2,
  {R(f'avg(e / {LIQ}) * 100')} AS mape, count(*) AS n
FROM (SELECT *, {ERR} AS e, avg({LIQ}) OVER (PARTITION BY model_version) AS m
      FROM feat JOIN pred USING (date) {{where}}) GROUP BY model_version"""


@query("mla7_metrics", METRIC_SQL.format(where=""))
def _(t):
    joined = jn.join_evaluated(t.features, t.predictions)
    return metrics.regression_metrics(joined, LIQ, PRED, ["model_version"])


@query(
    "mla7_model_metrics",
    fit_sql(
        f"SELECT is_validation, {R('avg(abs(r))')} AS mae, {R('sqrt(avg(r * r))')} AS rmse, "
        f"{R('1 - avg(r * r) / var_pop(y)')} AS r2, {R('avg(abs(r / y)) * 100')} AS mape, count(*) AS n "
        "FROM fitted WHERE date IS NOT NULL GROUP BY is_validation"),
)
def _(t):
    parts = materialize(ml.split(stored_training(t)), "split")
    model = ml.LiquidityModel().fit(parts.filter(~col("is_validation")))
    return model.evaluate(parts)


@query("mla8_importances")
def _(t):
    model = ml.LiquidityModel("random_forest", params={"trees": 20, "depth": 5})
    return model.fit(stored_training(t)).importances(t.spark)


@query(
    "mla9_save_metadata",
    "SELECT 'linear_regression' AS model_type, "
    "CAST(count(*) - ceil(count(*) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_train_samples FROM feat",
)
def _(t):
    path = scratch_path(t.spark, "model")
    _fit(t, "linear_regression").save(t.spark, path)
    return t.spark.read.schema("description string").json(f"{path}/metadata").select(
        F.get_json_object("description", "$.model_type").alias("model_type"),
        F.get_json_object("description", "$.training_metrics.n_train_samples")
        .cast("long")
        .alias("n_train_samples"),
    )


@query(
    "mla10_load_predict",
    "SELECT date, CAST(0 AS DOUBLE) AS difference FROM feat",
)
def _(t):
    path = scratch_path(t.spark, "model")
    rows = stored_training(t)
    model = ml.LiquidityModel("ridge").train(rows)
    model.save(t.spark, path)
    loaded = ml.LiquidityModel.load(t.spark, path).predict(rows)
    fresh = model.predict(rows).select("date", F.col("prediction").alias("fresh"))
    return loaded.join(fresh, "date").select(
        "date", F.abs(F.col("prediction") - F.col("fresh")).alias("difference")
    )


@query(
    "mla11_forecast",
    fit_sql(
        f"""SELECT {D} + CAST(i AS INTEGER) AS date, round(p, 2) AS predicted_liquidity_millions,
  'v{AS_OF.replace("-", "")}' AS model_version, round(p - 1.96 * rmse, 2) AS confidence_interval_lower,
  round(p + 1.96 * rmse, 2) AS confidence_interval_upper
FROM (SELECT -r AS p FROM fitted WHERE date IS NULL),
  (SELECT sqrt(avg(r * r)) AS rmse FROM fitted WHERE is_validation AND date IS NOT NULL), range(1, 8) d(i)"""),
)
def _(t):
    model = _fit(t, "linear_regression")
    return ml.forecast(model, t.features, AS_OF).drop("prediction_timestamp")


@query(
    "mla12_performance_rows",
    f"SELECT {D} AS evaluation_date, model_version, mae AS mae_millions, rmse AS rmse_millions, "
    "r2 AS r_squared, mape AS mape_percent, CAST(n AS INTEGER) AS num_predictions, "
    f"30 AS evaluation_period_days FROM ({METRIC_SQL.format(where=f'WHERE date >= {D} - 30')})",
)
def _(t):
    return ml.performance_rows(t.features, t.predictions, AS_OF)


@query("mla13_compare", fit_sql(COMPARED, split=False))
def _(t):
    rows = stored_training(t)
    return ml.compare(ml.LiquidityModel().fit(rows), rows)


@query(
    "mla13_compare_one_feature",
    f"""SELECT date, {R('y')} AS actual, {R('a + b * x')} AS predicted
FROM (SELECT date, total_generation_mwh AS x, {LIQ} AS y FROM feat),
  (SELECT regr_slope({LIQ}, total_generation_mwh) AS b,
     regr_intercept({LIQ}, total_generation_mwh) AS a FROM feat)""",
)
def _(t):
    model = ml.LiquidityModel(features=["total_generation_mwh"]).fit(t.features)
    return model.predict(t.features).select(
        "date", col(LIQ).alias("actual"), col("prediction").alias("predicted")
    )


@query(
    "mla6_forest_range",
    "SELECT date, true AS inside FROM feat",
)
def _(t):
    """A forest predicts means of targets, so never outside their range."""
    rows = stored_training(t)
    model = ml.LiquidityModel("random_forest", params={"trees": 5, "depth": 4}).fit(rows)
    ends = rows.agg(F.min(LIQ).alias("lo"), F.max(LIQ).alias("hi"))
    inside = col("prediction").between(ends.select("lo").scalar(), ends.select("hi").scalar())
    return model.predict(rows).select("date", inside.alias("inside"))


@query("mla8_importance_sum", "SELECT count(*) > 0 AS whole FROM feat")
def _(t):
    """Importances are shares: none negative, 1 in all."""
    model = ml.LiquidityModel("random_forest", params={"trees": 5, "depth": 4})
    shares = model.fit(stored_training(t)).importances(t.spark)
    value = [f.name for f in shares.schema.fields if f.dataType.typeName() == "double"][0]
    return shares.agg(
        ((F.abs(F.sum(value) - 1) < 1e-6) & (F.min(value) >= 0)).alias("whole")
    )


# ---- data quality -----------------------------------------------------------------------


def dq_sql(table, metric, value, ok, threshold, source):
    return (
        f"SELECT {D} AS check_date, '{table}' AS table_name, '{metric}' AS metric_name, "
        f"{R(value)} AS metric_value, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"CAST({threshold} AS DOUBLE) AS threshold_value FROM {source}"
    )


ROW_COUNT = dq_sql(
    "ml_features", "row_count", "count(*)", "count(*) >= 30", 30, f"feat WHERE date >= {D} - 30")
FRESHNESS = dq_sql(
    "ml_features", "freshness_days", f"date_diff('day', max(date), {D})",
    f"date_diff('day', max(date), {D}) <= 2", 2, "feat")
COMPLETENESS = " UNION ALL ".join(
    dq_sql("ml_features", f"completeness_{c}", f"CAST(count({c}) AS DOUBLE) / count(*) * 100",
           f"CAST(count({c}) AS DOUBLE) / count(*) * 100 >= 90", 90, "feat")
    for c in feats.ML_COLUMNS
)


@query("dqc1_row_count", ROW_COUNT)
def _(t):
    return quality.row_count(t.features, AS_OF)


@query("dqc2_freshness", FRESHNESS)
def _(t):
    return quality.freshness(t.features, AS_OF)


@query("dqc3_completeness", COMPLETENESS)
def _(t):
    return quality.completeness(t.features, AS_OF)


@query(
    "dqc4_accuracy",
    dq_sql("ml_predictions", "prediction_error_pct", f"avg({ERR} / {LIQ} * 100)",
           f"avg({ERR} / {LIQ} * 100) <= 25", 25, "feat JOIN pred USING (date)"),
)
def _(t):
    return quality.accuracy(t.features, t.predictions, AS_OF)


@query(
    "dqc5_null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
        f"{R(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100')} AS null_pct FROM feat"
        for c in feats.ML_COLUMNS
    ),
)
def _(t):
    return quality.null_profile(t.features)


def signed(t):
    """Line items with a margin that can be negative."""
    li = t.source("lineitem")
    return li.select(
        "l_quantity",
        F.round(col("l_extendedprice") * col("l_discount") - 2000, 4).alias("margin"),
    )


SIGNED_SQL = (
    "(SELECT l_quantity, round(l_extendedprice * l_discount - 2000, 4) AS margin FROM lineitem)"
)


@query(
    "dqc6_negatives",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < 0) AS negatives "
        f"FROM {SIGNED_SQL}"
        for c in ("l_quantity", "margin")
    ),
)
def _(t):
    return quality.negatives(signed(t))


def iqr_sql(c, source):
    return f"""SELECT '{c}' AS "column", {R('q1 - 1.5 * (q3 - q1)')} AS lower,
  {R('q3 + 1.5 * (q3 - q1)')} AS upper,
  count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
                FROM {source}) GROUP BY q1, q3"""


@query("dqc7_iqr_outliers_daily", " UNION ALL ".join(iqr_sql(c, "feat") for c in NUMBERS))
def _(t):
    return quality.iqr_outliers(t.features)


@query(
    "dqc7_iqr_outliers",
    " UNION ALL ".join(
        iqr_sql(c, "orders") for c in ("o_totalprice", "o_custkey")
    ),
)
def _(t):
    columns = ["o_totalprice", "o_custkey"]
    return quality.iqr_outliers(t.source("orders"), columns, daily=False)


@query(
    "dqc8_value_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM feat"
        for c in NUMBERS
    ),
)
def _(t):
    return quality.value_ranges(t.features)


@query(
    "dqc9_key_violations",
    "SELECT date, fuel_type, count(*) AS copies FROM readings GROUP BY ALL "
    "HAVING count(*) > 1 OR date IS NULL OR fuel_type IS NULL",
)
def _(t):
    return quality.key_violations(t.readings, ["date", "fuel_type"])


@query(
    "dqc10_monitoring",
    f"""WITH m AS (SELECT avg(e) AS mae, 1 - sum(e * e) / sum(({LIQ} - m) * ({LIQ} - m)) AS r2
  FROM (SELECT *, {ERR} AS e, avg({LIQ}) OVER () AS m FROM feat JOIN pred USING (date)))
"""
    + dq_sql("monitoring", "mae_millions", "mae", "mae <= 50", 50, "m")
    + " UNION ALL "
    + dq_sql("monitoring", "r_squared", "r2", "r2 >= 0.7", 0.7, "m")
    + " UNION ALL "
    + dq_sql("monitoring", "min_daily_records", "min(n)", "min(n) >= 100", 100,
             "(SELECT count(*) AS n FROM readings GROUP BY date)"),
)
def _(t):
    return quality.monitoring(t.features, t.predictions, t.readings, AS_OF)




# ---- features kept up by files ------------------------------------------------------------

HALF_UP_PRICE = (
    "(SELECT date, CAST((2 * sum(CAST(round(price_per_mwh * 100) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) "
    "/ 100 AS p FROM price GROUP BY date)"
)


@query(
    "vw0b_incremental_features",
    f"""SELECT date, {R('total_generation_mwh')} AS total_generation_mwh, {R('avg_temperature_f')} AS avg_temperature_f,
  {R('oil_price_usd')} AS oil_price_usd, {R('industrial_production_index')} AS industrial_production_index,
  {R('ca_unemployment_rate')} AS ca_unemployment_rate, {R('p')} AS avg_electricity_price,
  {R("total_generation_mwh * 5e-4 + coalesce(oil_price_usd, 50) "
     "+ (date_diff('day', DATE '1970-01-01', date) * 7919) % 151")} AS liquidity_need_millions
FROM feat LEFT JOIN {HALF_UP_PRICE} USING (date)""",
)
def _(t):
    """The raw tables in two landings by hash of the date, the second with a whole year besides,
    the features brought up to date behind each."""
    store = scratch_path(t.spark, "store")
    names = list(incremental_features.FEEDS)
    late = F.trunc("date", "year") == F.lit("1995-01-01")
    part = F.when(late, 1).otherwise(F.pmod(F.xxhash64("date"), F.lit(2)))
    weights = {
        "noise": scalars.noise_from_date(F.col("date"), 0, 150),
        "generation_weight": GENERATION_WEIGHT, "oil_weight": 1.0,
    }
    for landing in range(2):
        for name, frame in zip(names, t.raw):
            rows = schemas.select_typed(frame, name).filter(part == landing)
            rows.write.mode("append").parquet(f"{store}/{name}")
        incremental_features.refresh(t.spark, store, **weights)
    stored = t.spark.read.schema(schemas.TABLES["ml_features"]).parquet(f"{store}/ml_features")
    return stored.select("date", *[col(c).cast("double").alias(c) for c in NUMBERS])


# ---- checks from one pass -----------------------------------------------------------------


def watched(t):
    """Checks of the feature table, filled by writing it."""
    watch = quality.Watch(t.features, AS_OF)
    watch.frame.write.parquet(scratch_path(t.spark, "watched"))
    return watch


@query("dqc3_one_pass", " UNION ALL ".join(f"SELECT * FROM ({text})" for text in (ROW_COUNT, FRESHNESS, COMPLETENESS)))
def _(t):
    watch = watched(t)
    return watch.row_count().unionByName(watch.freshness()).unionByName(watch.completeness())


@query(
    "dqc5_one_pass",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
        f"{R(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100')} AS null_pct, "
        f"count(*) FILTER (WHERE {c} < 0) AS negatives, {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM feat"
        for c in NUMBERS
    ),
)
def _(t):
    """Nulls, negatives and ranges of the number columns."""
    watch = watched(t)
    return watch.null_profile().join(watch.negatives(), "column").join(watch.value_ranges(), "column")

"""Data-quality checks. Table-level checks emit the ``data_quality_metrics`` columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from wattledger import settings as cfg
from wattledger.functions.buckets import pass_fail
from wattledger.functions.scalars import absolute_error, as_date, percentage_error
from wattledger.operators import filters, joins, quantiles
from wattledger.operators.metrics import regression_metrics


def _metric(df: DataFrame, as_of, table: str, metric: Column, value: Column,
            ok: Column, threshold: Column) -> DataFrame:
    return df.select(
        as_date(as_of).alias("check_date"),
        F.lit(table).alias("table_name"),
        metric.alias("metric_name"),
        value.cast("double").alias("metric_value"),
        pass_fail(ok).alias("status"),
        threshold.cast("double").alias("threshold_value"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def row_count(df: DataFrame, as_of, table: str = "ml_features", days: int = 30,
              minimum: int = cfg.MIN_ROWS, maximum: int | None = None) -> DataFrame:
    """Rows of the last ``days``; PASS at ``minimum`` or more (and ``maximum`` or fewer)."""
    counted = filters.look_back(df, as_of, days).agg(F.count(F.lit(1)).alias("n"))
    return _row_count(counted, as_of, table, minimum, maximum)


def _row_count(counted: DataFrame, as_of, table: str, minimum: int, maximum: int | None) -> DataFrame:
    n = F.col("n")
    ok = n >= minimum if maximum is None else n.between(minimum, maximum)
    return _metric(counted, as_of, table, F.lit("row_count"), n, ok, F.lit(minimum))


def freshness(df: DataFrame, as_of, table: str = "ml_features",
              limit: int = cfg.MAX_DAYS_OLD) -> DataFrame:
    """Days the newest date lags behind ``as_of``."""
    return _freshness(df.agg(F.max("date").alias("newest")), as_of, table, limit)


def _freshness(newest: DataFrame, as_of, table: str, limit: int) -> DataFrame:
    age = F.datediff(as_date(as_of), F.col("newest"))
    return _metric(newest, as_of, table, F.lit("freshness_days"), age, age <= limit, F.lit(limit))


def completeness(df: DataFrame, as_of, table: str = "ml_features",
                 columns: Sequence[str] | None = None,
                 minimum: float = cfg.MIN_COMPLETE_PCT) -> DataFrame:
    """Share of non-null values per column, one row each, from a single pass."""
    cols = list(columns or df.columns)
    total = F.count(F.lit(1))
    wide = df.agg(*[(F.try_divide(F.count(c), total) * 100.0).alias(c) for c in cols])
    return _completeness(wide, as_of, table, cols, minimum)


def _completeness(wide: DataFrame, as_of, table: str, cols: list[str], minimum: float) -> DataFrame:
    long = wide.unpivot([], cols, "column", "pct")
    return _metric(
        long, as_of, table, F.concat(F.lit("completeness_"), F.col("column")), F.col("pct"),
        F.col("pct") >= minimum, F.lit(minimum),
    )


def accuracy(features: DataFrame, predictions: DataFrame, as_of,
             limit: float = cfg.MAX_ERROR_PCT, table: str = "ml_predictions") -> DataFrame:
    """Mean absolute percentage error of all evaluated predictions."""
    pct = F.abs(
        percentage_error(F.col("liquidity_need_millions"), F.col("predicted_liquidity_millions"))
    )
    mean = joins.join_evaluated(features, predictions).agg(F.avg(pct).alias("pct"))
    return _metric(
        mean, as_of, table, F.lit("prediction_error_pct"), F.col("pct"),
        F.col("pct") <= limit, F.lit(limit),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, null_pct) per column, from a single pass."""
    cols = list(columns or df.columns)
    total = F.count(F.lit(1))
    wide = df.agg(
        *[
            F.struct(
                (total - F.count(c)).alias("nulls"),
                (F.try_divide(total - F.count(c), total) * 100.0).alias("null_pct"),
            ).alias(c)
            for c in cols
        ]
    )
    return wide.unpivot([], cols, "column", "s").select("column", "s.nulls", "s.null_pct")


def negatives(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, negatives) per numeric column."""
    cols = list(columns or numeric_columns(df))
    wide = df.agg(*[F.count(F.when(F.col(c) < 0, 1)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "negatives")


def _fences(q: DataFrame, k: float) -> DataFrame:
    ends = q.groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return ends.select(
        "column", (F.col("q1") - iqr * k).alias("lower"), (F.col("q3") + iqr * k).alias("upper")
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5,
                 daily: bool = True) -> DataFrame:
    """(column, lower, upper, outliers) by the inter-quartile rule.

    ``daily`` says the table has one row per day; otherwise the distributed quantiles run.
    The fences, two numbers per column, are fetched first and enter the counting pass as
    literals, so that pass is one scan with a plain aggregate.
    """
    cols = list(columns or numeric_columns(df))
    find = quantiles.daily_quantiles if daily else quantiles.exact_quantiles
    found = {r["column"]: r for r in _fences(find(df, cols, (0.25, 0.75)), k).collect()}

    def fence(c: str, end: str) -> Column:
        return F.lit(found[c][end] if c in found else None).cast("double")

    def outside(c: str) -> Column:
        x = F.col(c).cast("double")
        return (x < fence(c, "lower")) | (x > fence(c, "upper"))

    wide = df.agg(
        *[
            F.struct(
                fence(c, "lower").alias("lower"),
                fence(c, "upper").alias("upper"),
                F.count(F.when(outside(c), 1)).alias("outliers"),
            ).alias(c)
            for c in cols
        ]
    )
    return wide.unpivot([], cols, "column", "s").select("column", "s.*")


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, min, max) per numeric column."""
    cols = list(columns or numeric_columns(df))
    wide = df.agg(
        *[
            F.struct(
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    return wide.unpivot([], cols, "column", "s").select("column", "s.min", "s.max")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that repeat or hold a null, with their row count."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter((F.col("copies") > 1) | incomplete)
    )


def monitoring(features: DataFrame, predictions: DataFrame, feed: DataFrame, as_of,
               max_mae: float = cfg.MAX_MAE, min_r2: float = cfg.MIN_R2,
               min_daily: int = cfg.MIN_DAILY_RECORDS) -> DataFrame:
    """Model error, model fit and daily volume against their alert thresholds."""
    joined = joins.join_evaluated(features, predictions)
    m = regression_metrics(joined, "liquidity_need_millions", "predicted_liquidity_millions")
    fit = m.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("mae_millions").alias("name"),
                    F.col("mae").alias("value"),
                    pass_fail(F.col("mae") <= max_mae).alias("status"),
                    F.lit(float(max_mae)).alias("threshold"),
                ),
                F.struct(
                    F.lit("r_squared").alias("name"),
                    F.col("r2").alias("value"),
                    pass_fail(F.col("r2") >= min_r2).alias("status"),
                    F.lit(float(min_r2)).alias("threshold"),
                ),
            )
        ).alias("x")
    ).select("x.*")
    daily = (
        feed.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.min("n").cast("double").alias("value"))
        .select(
            F.lit("min_daily_records").alias("name"),
            "value",
            pass_fail(F.col("value") >= min_daily).alias("status"),
            F.lit(float(min_daily)).alias("threshold"),
        )
    )
    return fit.unionByName(daily).select(
        as_date(as_of).alias("check_date"),
        F.lit("monitoring").alias("table_name"),
        F.col("name").alias("metric_name"),
        F.col("value").alias("metric_value"),
        "status",
        F.col("threshold").alias("threshold_value"),
    )


def prediction_errors(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Evaluated predictions with their absolute error."""
    return joins.join_evaluated(features, predictions).withColumn(
        "absolute_error",
        absolute_error(F.col("liquidity_need_millions"), F.col("predicted_liquidity_millions")),
    )


class Watch:
    """The checks of one table from a single pass that something else makes over it.

    ``frame`` is the table with the counts attached (``DataFrame.observe``): whatever action
    reads all of it first, such as an export, fills them, and the checks cost no scan of their
    own. They give the rows of the functions of the same names.
    """

    def __init__(self, df: DataFrame, as_of, table: str = "ml_features", days: int = 30):
        self.spark, self.as_of, self.table = df.sparkSession, as_of, table
        self.columns, self.numbers = list(df.columns), numeric_columns(df)
        self._seen = Observation()
        recent = F.col("date") >= F.date_sub(as_date(as_of), days)
        counts = [F.count(F.lit(1)).alias("rows"), F.count(F.when(recent, 1)).alias("recent"), F.max("date").alias("newest")]
        counts += [F.count(c).alias(f"known_{c}") for c in self.columns]
        for c in self.numbers:
            value = F.col(c).cast("double")
            counts += [F.count(F.when(F.col(c) < 0, 1)).alias(f"negative_{c}"), F.min(value).alias(f"min_{c}"), F.max(value).alias(f"max_{c}")]
        self._kinds = df.agg(*counts).schema
        self.frame = df.observe(self._seen, *counts)

    def _one(self) -> DataFrame:
        """What was counted, as one row; waits for the action on ``frame``."""
        got = self._seen.get
        return self.spark.createDataFrame([tuple(got[n] for n in self._kinds.names)], self._kinds)

    def row_count(self, minimum: int = cfg.MIN_ROWS, maximum: int | None = None) -> DataFrame:
        counted = self._one().select(F.col("recent").alias("n"))
        return _row_count(counted, self.as_of, self.table, minimum, maximum)

    def freshness(self, limit: int = cfg.MAX_DAYS_OLD) -> DataFrame:
        return _freshness(self._one(), self.as_of, self.table, limit)

    def completeness(self, columns: Sequence[str] | None = None, minimum: float = cfg.MIN_COMPLETE_PCT) -> DataFrame:
        cols = list(columns or self.columns)
        shares = [(F.try_divide(F.col(f"known_{c}"), F.col("rows")) * 100.0).alias(c) for c in cols]
        return _completeness(self._one().select(*shares), self.as_of, self.table, cols, minimum)

    def _by_column(self, cols: list[str], **values) -> DataFrame:
        wide = self._one().select(*[F.struct(*[v(c).alias(n) for n, v in values.items()]).alias(c) for c in cols])
        return wide.unpivot([], cols, "column", "s").select("column", *[f"s.{n}" for n in values])

    def null_profile(self) -> DataFrame:
        nulls = lambda c: F.col("rows") - F.col(f"known_{c}")
        return self._by_column(
            self.columns, nulls=nulls, null_pct=lambda c: F.try_divide(nulls(c), F.col("rows")) * 100.0)

    def negatives(self) -> DataFrame:
        return self._by_column(self.numbers, negatives=lambda c: F.col(f"negative_{c}"))

    def value_ranges(self) -> DataFrame:
        return self._by_column(self.numbers, min=lambda c: F.col(f"min_{c}"), max=lambda c: F.col(f"max_{c}"))

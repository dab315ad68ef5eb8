"""The daily run: load landed files, build features, export, train, forecast, publish."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattledger import schemas
from wattledger.operators import quality
from wattledger.plans import features as feats
from wattledger.plans import incremental_features
from wattledger.plans import model as ml
from wattledger.plans import views
from wattledger.sources import by_date, commits, payloads, sinks
from wattledger.streaming import incremental

RAW = ["raw_eia_data", "raw_weather_data", "raw_economic_data", "raw_price_data"]


def ingest(
    spark: SparkSession, landing: str, store: str, clean: str | None = None, archive: str | None = None
) -> None:
    """Append every newly landed file of the four feeds, CSV and JSON, to its raw table; what
    does not fit goes to ``_rejected/<table>``. ``clean`` as in ``incremental.csv_stream``."""
    for table in RAW:
        common = {"clean": clean, "archive": archive, "rejected": f"{store}/_rejected/{table}"}
        source, target = f"{landing}/{table}", f"{store}/{table}"
        incremental.load_new_files(
            spark, source, table, target, f"{store}/_loads/{table}", **common)
        if table in payloads.FEEDS:
            incremental.load_new_responses(
                spark, source, table, target, f"{store}/_loads/{table}-json", **common)


def load_counts(spark: SparkSession, store: str) -> DataFrame:
    """(table_name, batch, rows, rejected) of every published load."""
    parts = [
        commits.batches(spark, f"{store}/{t}").select(F.lit(t).alias("table_name"), "batch", "rows", "rejected")
        for t in RAW
    ]
    return reduce(DataFrame.union, parts)


def rejected(spark: SparkSession, store: str, name: str) -> DataFrame:
    """(source_file, error, record) of what the loads of a raw table left out."""
    schema = StructType.fromDDL(incremental.REJECTED)
    return commits.read(spark, f"{store}/_rejected/{name}", schema)


def table(spark: SparkSession, store: str, name: str) -> DataFrame:
    """The declared columns of a stored table, of every writer's files."""
    if name in RAW:
        return commits.read(spark, f"{store}/{name}", schemas.TABLES[name])
    stored = spark.read.schema(schemas.TABLES[name]).parquet(f"{store}/{name}")
    return stored.select(*schemas.TABLES[name].names)


def build_features(spark: SparkSession, store: str, **weights) -> DataFrame:
    """Bring the feature table up to date from the new raw files and return it as stored.

    The views and the training read this small table by month instead of aggregating the raw
    feeds again.
    """
    incremental_features.refresh(spark, store, **weights)
    return table(spark, store, "ml_features")


def rebuild_features(spark: SparkSession, store: str, **weights) -> DataFrame:
    """The feature rows of all raw rows, without the stored states."""
    raw = [table(spark, store, t) for t in RAW]
    return schemas.select_typed(feats.ml_features(*raw, **weights), "ml_features")


def save_checks(features: DataFrame, predictions: DataFrame, as_of, store: str, watch: quality.Watch) -> None:
    """The run's quality rows and model scores, kept by run date: a repeated run replaces its
    own. What ``watch`` counted during the export is not read again."""
    checks = [
        watch.row_count(),
        watch.freshness(),
        watch.completeness(),
        quality.accuracy(features, predictions, as_of),
    ]
    rows = reduce(DataFrame.unionByName, checks)
    sinks.land_raw(rows, f"{store}/data_quality_metrics", as_of)
    scores = ml.performance_rows(features, predictions, as_of)
    sinks.land_raw(scores, f"{store}/model_performance", as_of)


def train_and_forecast(
    spark: SparkSession, features: DataFrame, as_of, store: str, model_type="linear_regression"
) -> tuple[ml.LiquidityModel, DataFrame]:
    rows = ml.prepare(sinks.training_rows(features, keep_date=True))
    model = ml.LiquidityModel(model_type).train(rows)
    model.save(spark, f"{store}/models/{as_of}")
    ahead = ml.forecast(model, features, as_of)
    shaped = schemas.select_typed(ahead, "ml_predictions")
    # Kept by run date, so that a repeated run replaces its own predictions.
    sinks.land_raw(shaped, f"{store}/ml_predictions", as_of)
    return model, table(spark, store, "ml_predictions")


def kept_by_date(spark: SparkSession, df: DataFrame, store: str, name: str, as_of, buckets: int) -> DataFrame:
    """The run's copy of a daily table in date buckets; a repeated run replaces its own."""
    folder = f"{store}/_by_date/{name}/{as_of}"
    by_date.replace(df, folder, buckets=buckets)
    return by_date.read(spark, folder, df.schema).cool


def publish(
    features: DataFrame, predictions: DataFrame, generation: DataFrame, weather: DataFrame, as_of
):
    """The reporting views by name."""
    return {
        "daily_energy_dashboard": views.daily_energy_dashboard(features, predictions),
        "weekly_summary": views.weekly_summary(features, predictions),
        "current_status": views.current_status(features, predictions, as_of),
        "executive_kpis": views.executive_kpis(features, predictions, as_of),
        "liquidity_time_series": views.liquidity_time_series(features, predictions, as_of),
        "daily_generation_by_fuel": views.daily_generation_by_fuel(generation, as_of),
        "weather_energy_correlation": views.weather_energy_correlation(features, weather, as_of),
        "economic_indicators_impact": views.economic_indicators_impact(features, as_of),
        "model_performance_trend": views.model_performance_trend(features, predictions, as_of),
        "risk_analysis": views.risk_analysis(features, predictions, as_of),
        "current_month_summary": views.current_month_summary(features, as_of),
        "current_model_performance": views.current_model_performance(features, predictions),
    }


def run(
    spark: SparkSession, landing: str, store: str, as_of, model_type="linear_regression",
    clean: str | None = None, archive: str | None = None, buckets: int | None = None, **weights
):
    """One day's run. ``clean`` and ``archive`` say what becomes of consumed files, as in
    ``incremental.csv_stream``; ``weights`` are those of the target. With ``buckets`` the views
    read features and predictions from copies kept in so many date buckets."""
    ingest(spark, landing, store, clean, archive)
    features = build_features(spark, store, **weights)
    watch = quality.Watch(features, as_of)
    sinks.export_training(watch.frame, f"{store}/training")
    model, predictions = train_and_forecast(spark, features, as_of, store, model_type)
    save_checks(features, predictions, as_of, store, watch)
    generation, weather = (table(spark, store, t) for t in ("raw_eia_data", "raw_weather_data"))
    if buckets is not None:
        features = kept_by_date(spark, features, store, "ml_features", as_of, buckets)
        predictions = kept_by_date(spark, predictions, store, "ml_predictions", as_of, buckets)
    return model, publish(features, predictions, generation, weather, as_of)

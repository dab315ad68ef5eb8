"""Liquidity regression on Spark ML: impute, split, scale, fit, score, save, forecast."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger import settings as cfg
from wattledger.functions import scalars
from wattledger.operators import filters, joins, quantiles, windows
from wattledger.operators.metrics import regression_metrics
from wattledger.session import materialize

MODEL_TYPES = ["linear_regression", "ridge", "random_forest"]


def impute(
    df: DataFrame,
    columns: Sequence[str] = tuple(schemas.FEATURES),
    order: str | Sequence[str] = "date",
    descending: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Forward fill, backward fill, then median; a complete frame passes unchanged.

    One ``order`` column names the unique date of a daily table; a list of them orders the rows
    of a feed, oldest first (``descending`` does not count then).

    The export is newest first, hence ``descending``: forward filling takes the value of
    the next later day. Without ``by`` the median can only meet columns that are null
    throughout, where it is null as well, so it is planned only for per-key fills.
    """
    if isinstance(order, str):
        filled = windows.fill_in_order(df, columns, order, descending, True, True, by)
    else:
        filled = windows.scan_fill(df, columns, order, by, True, True)
    if not by:
        return filled
    medians = quantiles.exact_quantiles(filled, columns, (0.5,))
    middle = medians.agg(
        F.struct(
            *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
        ).alias("m")
    ).scalar()
    return filled.withColumns({c: F.coalesce(F.col(c), middle[c]) for c in columns})


def prepare(
    df: DataFrame,
    features: Sequence[str] = tuple(schemas.FEATURES),
    target: str = schemas.TARGET,
    order: str = "date",
    descending: bool = True,
) -> DataFrame:
    """Impute the features over all rows, then drop rows without a target."""
    return filters.require(impute(df, features, order, descending), [target])


def split_ticket(keys: Sequence[str], seed: int) -> Column:
    """The first 64 bits of the digest of the key's texts and the seed, as a long in their order."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    number = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return (number - F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")


def split(
    df: DataFrame,
    keys: Sequence[str] = ("date",),
    share: float = cfg.VALIDATION_SHARE,
    seed: int = cfg.SEED,
) -> DataFrame:
    """Adds ``is_validation``, true for exactly ``ceil(share · rows)`` rows (unique keys).

    Rows are ranked by a seeded digest of their key, and the hash at the wanted rank is found
    by counting: no global sort, no collected rows, and the same seed always gives the same
    split. Rows with equal keys fall on the same side.
    """
    ticket = split_ticket(keys, seed)
    cut = quantiles.hash_threshold(df, ticket, lambda n: F.ceil(n * F.lit(float(share))))
    return df.withColumn("is_validation", F.coalesce(ticket <= cut.scalar(), F.lit(False)))


def scaling(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per feature from one aggregate; a constant scales by 1."""
    row = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in features],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in features],
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in features}


def scaled(c: str, stats: dict[str, tuple[float, float]]) -> Column:
    mean, dev = stats[c]
    return (F.col(c).cast("double") - F.lit(mean)) / F.lit(dev)


def standardize(df: DataFrame, train: DataFrame, features: Sequence[str] = tuple(schemas.FEATURES)):
    """``df`` with each feature standardised by the statistics of ``train``."""
    stats = scaling(train, features)
    return df.withColumns({c: scaled(c, stats) for c in features})


def _scaler_stage(stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    columns = ", ".join(
        f"(CAST({c} AS DOUBLE) - {mean!r}D) / {dev!r}D AS scaled_{c}"
        for c, (mean, dev) in stats.items()
    )
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def _regressor(model_type: str, train: DataFrame, target: str, seed: int, **params):
    common = {"featuresCol": "features", "labelCol": target, "predictionCol": "prediction"}
    if model_type == "linear_regression":
        return LinearRegression(regParam=0.0, solver="normal", **common)
    if model_type == "ridge":
        # Spark penalises the mean loss on a target it scales itself; alpha · σ_y / n is the
        # setting whose minimum is that of squared loss + alpha · |w|².
        alpha = params.get("alpha", cfg.RIDGE_ALPHA)
        y = train.agg(
            F.stddev_pop(F.col(target).cast("double")).alias("s"), F.count(F.lit(1)).alias("n")
        ).first()
        return LinearRegression(
            regParam=alpha * (y["s"] or 0.0) / max(y["n"], 1),
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
            **common,
        )
    if model_type == "random_forest":
        return RandomForestRegressor(
            numTrees=params.get("trees", cfg.FOREST_TREES),
            maxDepth=params.get("depth", cfg.FOREST_DEPTH),
            featureSubsetStrategy="all",
            seed=seed,
            **common,
        )
    raise ValueError(f"Unknown model type: {model_type}")


@dataclass
class LiquidityModel:
    """A regression of the liquidity need; fitted state is a Spark ``PipelineModel``."""

    model_type: str = "linear_regression"
    seed: int = cfg.SEED
    features: list[str] = field(default_factory=lambda: list(schemas.FEATURES))
    target: str = schemas.TARGET
    params: dict = field(default_factory=dict)
    fitted: PipelineModel | None = None
    metrics: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"Unknown model type: {self.model_type}")

    def fit(self, train: DataFrame) -> LiquidityModel:
        """Fit scaler and regressor on ``train`` (complete features and target)."""
        wide = train.withColumn(self.target, F.col(self.target).cast("double"))
        stats = scaling(wide, self.features)
        stage = _scaler_stage(stats)
        assembler = VectorAssembler(
            inputCols=[f"scaled_{c}" for c in self.features], outputCol="features"
        )
        regressor = _regressor(self.model_type, wide, self.target, self.seed, **self.params)
        model = regressor.fit(assembler.transform(stage.transform(wide)))
        self.fitted = PipelineModel([stage, assembler, model])
        return self

    def train(
        self, df: DataFrame, keys: Sequence[str] = ("date",), share: float = cfg.VALIDATION_SHARE,
        stored: bool = False,
    ) -> LiquidityModel:
        """Split, fit on the training part and score both parts.

        Training passes over the rows several times, so they are written to the shared
        folder once, with and without the split, instead of being derived for each pass;
        ``stored`` says that ``df`` is read from files already.
        """
        rows = df.select(*keys, *self.features, self.target)
        rows = rows if stored else materialize(rows, "training")
        parts = materialize(split(rows, keys, share, self.seed), "split")
        self.fit(parts.filter(~F.col("is_validation")))
        scores = self.evaluate(parts).collect()  # two rows
        named = {("validation" if r["is_validation"] else "train"): r for r in scores}
        self.metrics = {
            part: {k: r[k] for k in ("mae", "rmse", "r2", "mape")} for part, r in named.items()
        }
        self.metrics.update(
            model_type=self.model_type,
            n_features=len(self.features),
            n_train_samples=named["train"]["n"] if "train" in named else 0,
            n_val_samples=named["validation"]["n"] if "validation" in named else 0,
        )
        return self

    def evaluate(self, parts: DataFrame) -> DataFrame:
        """Metrics of the training and validation part, one row each."""
        return regression_metrics(
            self.predict(parts), self.target, "prediction", ["is_validation"]
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``prediction``."""
        if self.fitted is None:
            raise ValueError("Model not trained yet. Call train() first.")
        helpers = ["features", *[f"scaled_{c}" for c in self.features]]
        return self.fitted.transform(df).drop(*helpers)

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance), largest first; tree models only."""
        if self.fitted is None:
            raise ValueError("Model not trained yet. Call train() first.")
        values = self.fitted.stages[-1].featureImportances.toArray().tolist()
        rows = list(zip(self.features, values))
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.col("importance").desc(), "feature"
        )

    def coefficients(self) -> tuple[list[float], float]:
        last = self.fitted.stages[-1]
        return last.coefficients.toArray().tolist(), float(last.intercept)

    def save(self, spark: SparkSession, path: str) -> None:
        """Pipeline below ``path/model``, description as JSON below ``path/metadata``."""
        if self.fitted is None:
            raise ValueError("Model not trained yet. Call train() first.")
        self.fitted.write().overwrite().save(f"{path}/model")
        description = json.dumps(
            {
                "model_type": self.model_type,
                "seed": self.seed,
                "feature_names": self.features,
                "target": self.target,
                "training_metrics": self.metrics,
                "spark_version": spark.version,
            }
        )
        (
            spark.createDataFrame([(description,)], "description string")
            .withColumn("training_timestamp", F.current_timestamp())
            .write.mode("overwrite")
            .json(f"{path}/metadata")
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> LiquidityModel:
        rows = spark.read.schema("description string").json(f"{path}/metadata")
        text = json.loads(rows.first()["description"])
        model = LiquidityModel(
            text["model_type"], text["seed"], text["feature_names"], text["target"]
        )
        model.metrics = text["training_metrics"]
        model.fitted = PipelineModel.load(f"{path}/model")
        return model


def latest_features(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the newest known value of each feature."""
    return features.agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in columns]
    )


def forecast(
    model: LiquidityModel,
    features: DataFrame,
    as_of,
    rmse: float | None = None,
    days: int = cfg.FORECAST_DAYS,
) -> DataFrame:
    """Predictions for the ``days`` after ``as_of``, in the shape of ``ml_predictions``.

    Every day carries the newest known features forward; the bounds are the prediction
    ± 1.96 × validation RMSE, null when no RMSE is known.
    """
    if rmse is None:
        rmse = model.metrics.get("validation", {}).get("rmse")
    day = scalars.as_date(as_of)
    ahead = latest_features(features, model.features).withColumn(
        "date", F.explode(scalars.calendar(F.date_add(day, 1), F.date_add(day, days)))
    )
    band = F.lit(None if rmse is None else cfg.CONFIDENCE_Z * rmse).cast("double")
    y = F.round("prediction", 2)
    return model.predict(ahead).select(
        "date",
        y.alias("predicted_liquidity_millions"),
        scalars.version_tag(day).alias("model_version"),
        day.cast("timestamp").alias("prediction_timestamp"),
        F.round(F.col("prediction") - band, 2).alias("confidence_interval_lower"),
        F.round(F.col("prediction") + band, 2).alias("confidence_interval_upper"),
    )


def performance_rows(
    features: DataFrame, predictions: DataFrame, as_of, days: int = 30
) -> DataFrame:
    """``model_performance`` rows: each version's metrics over the look-back."""
    joined = joins.join_evaluated(filters.look_back(features, as_of, days), predictions)
    m = regression_metrics(
        joined, "liquidity_need_millions", "predicted_liquidity_millions", ["model_version"]
    )
    return m.select(
        scalars.as_date(as_of).alias("evaluation_date"),
        "model_version",
        F.col("mae").alias("mae_millions"),
        F.col("rmse").alias("rmse_millions"),
        F.col("r2").alias("r_squared"),
        F.col("mape").alias("mape_percent"),
        F.col("n").cast("int").alias("num_predictions"),
        F.lit(days).alias("evaluation_period_days"),
    )


def compare(model: LiquidityModel, df: DataFrame) -> DataFrame:
    """Actual, prediction and absolute error per row."""
    scored = model.predict(df)
    return scored.select(
        *[c for c in ("date",) if c in df.columns],
        F.col(model.target).alias("actual"),
        F.col("prediction").alias("predicted"),
        scalars.absolute_error(F.col(model.target), F.col("prediction")).alias("error"),
    )

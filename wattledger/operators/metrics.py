"""Regression metrics as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.scalars import absolute_error, percentage_error


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE, R² and MAPE (percent) with the sample count, per group.

    R² uses the population variance of the actuals, so no second pass for their mean.
    """
    y = F.col(actual).cast("double")
    p = F.col(predicted).cast("double")
    e2 = (y - p) * (y - p)
    both = df.filter(y.isNotNull() & p.isNotNull())
    return both.groupBy(*by).agg(
        F.avg(absolute_error(y, p)).alias("mae"),
        F.sqrt(F.avg(e2)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.avg(e2), F.var_pop(y))).alias("r2"),
        F.avg(F.abs(percentage_error(y, p))).alias("mape"),
        F.count(F.lit(1)).alias("n"),
    )

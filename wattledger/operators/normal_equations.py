"""Least squares and ridge from sums: one aggregate that merges, and a small solution.

The sums (count, first and second moments of features and target) of any split of the rows add
up to those of all rows, so they can be kept by day and a model be fitted from them without
reading old rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations_with_replacement(names, 2))


def moments(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    by: Sequence[str] = (),
    origin: dict[str, float] | None = None,
) -> DataFrame:
    """``by``, n, s_<a> and p_<a>_<b>: count, sums and sums of products of the complete rows.

    Values are taken from ``origin`` (0 by default); one near the means keeps all digits where
    they are large against the deviations. One origin must serve all rows that are added up.
    """
    names, origin = [*features, target], origin or {}
    value = {c: F.col(c).cast("double") - F.lit(float(origin.get(c, 0.0))) for c in names}
    complete = F.lit(True)
    for c in names:
        complete = complete & F.col(c).isNotNull()
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(value[c]).alias(f"s_{c}") for c in names]
    sums += [F.sum(value[a] * value[b]).alias(f"p_{a}_{b}") for a, b in _pairs(names)]
    return df.filter(complete).groupBy(*by).agg(*sums)


def merged(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of several tables of ``moments``."""
    kept = [c for c in parts.columns if c == "n" or c.startswith(("s_", "p_"))]
    return parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in kept])


@dataclass
class Fit:
    """Weights of standardised features (population deviation), intercept, and what they need."""

    features: list[str]
    weights: np.ndarray
    intercept: float
    means: np.ndarray
    deviations: np.ndarray

    def predicted(self) -> Column:
        """The prediction as an expression on the feature columns."""
        out = F.lit(self.intercept)
        for c, w, m, s in zip(self.features, self.weights, self.means, self.deviations):
            out = out + (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w))
        return out


def solve(
    sums: dict, features: Sequence[str], target: str, alpha: float = 0.0,
    origin: dict[str, float] | None = None,
) -> Fit:
    """Minimum of squared loss + ``alpha`` · |w|² from one row of sums; a constant feature weighs 0.

    The system has one row and column per feature, whatever the number of rows summed.
    """
    names, origin = [*features, target], origin or {}
    n = sums["n"]
    if not n:
        raise ValueError("no complete rows to fit")
    mean = {c: sums[f"s_{c}"] / n for c in names}
    cov = {(a, b): sums[f"p_{a}_{b}"] / n - mean[a] * mean[b] for a, b in _pairs(names)}
    cov |= {(b, a): v for (a, b), v in cov.items()}
    dev = np.array([np.sqrt(max(cov[c, c], 0.0)) for c in features])
    # What rounding alone leaves of a constant's variance counts as none.
    scale = np.array([abs(sums[f"p_{c}_{c}"]) / n for c in features])
    dev[dev**2 <= 1e-13 * scale] = 0.0
    safe = np.where(dev > 0, dev, 1.0)
    gram = np.array([[cov[a, b] for b in features] for a in features]) / np.outer(safe, safe)
    gram[dev == 0, :] = gram[:, dev == 0] = 0.0
    right = np.where(dev > 0, np.array([cov[c, target] for c in features]) / safe, 0.0)
    weights = np.linalg.lstsq(gram + np.eye(len(features)) * alpha / n, right, rcond=1e-12)[0]
    means = np.array([mean[c] + origin.get(c, 0.0) for c in features])
    return Fit(list(features), weights, mean[target] + origin.get(target, 0.0), means, safe)


def fit(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.0) -> Fit:
    """Fit of all complete rows: means first (they become the origin), then one aggregate."""
    names = [*features, target]
    first = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first().asDict()
    origin = {c: v or 0.0 for c, v in first.items()}
    row = moments(df, features, target, origin=origin).first()
    return solve(row.asDict(), features, target, alpha, origin)

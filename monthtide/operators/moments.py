"""Least squares, ridge, lasso and elastic net from first and second moments.

The moments of a table are one aggregate, of a few numbers whatever its size. Moments of
parts can be put together, so that one scan of a table gives those of every fold, of the
rows outside every fold, and of the table with predicted rows added. Fits and errors follow
from them without another scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "n"
#: Coordinate descent ends when no standardized coefficient moves more than this.
TOLERANCE = 1e-13
MAX_ROUNDS = 100_000


def feature_columns(df: DataFrame) -> list[str]:
    """Those that the feature vector is made of."""
    return ["id", "category_idx"] if "category_idx" in df.columns else ["id"]


@dataclass(frozen=True)
class Moments:
    """Rows, means and co-moments (sums of products of deviations) of the features, then the label.

    Deviations are from the means, so that large values with little spread lose no digits.
    """

    rows: float
    means: np.ndarray
    spread: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.rows or not other.rows:
            return self if self.rows else other
        rows = self.rows + other.rows
        apart = other.means - self.means
        return Moments(
            rows,
            self.means + apart * (other.rows / rows),
            self.spread + other.spread
            + np.outer(apart, apart) * (self.rows * other.rows / rows),
        )

    @classmethod
    def none(cls, features: int) -> Moments:
        return cls(0.0, np.zeros(features + 1), np.zeros((features + 1, features + 1)))

    def squared_error(self, fit: LinearFit) -> float:
        """Sum of squared errors of a fit on the rows of these moments."""
        weights = np.append(-fit.weights, 1.0)
        miss = float(weights @ self.means) - fit.intercept
        return max(0.0, float(weights @ self.spread @ weights) + self.rows * miss * miss)

    def rmse(self, fit: LinearFit) -> float:
        return (self.squared_error(fit) / self.rows) ** 0.5 if self.rows else float("nan")


def moment_columns(columns: Sequence[str], only: Column | None = None, prefix: str = "") -> list[Column]:
    """The aggregates that ``read_moments`` reads, over all rows or those of a condition."""

    def kept(name: str) -> Column:
        value = F.col(name).cast("double")
        return value if only is None else F.when(only, value)

    out = [F.count(kept(columns[0])).cast("double").alias(f"{prefix}rows")]
    out += [F.avg(kept(c)).alias(f"{prefix}mean_{i}") for i, c in enumerate(columns)]
    out += [
        F.covar_pop(kept(columns[i]), kept(columns[j])).alias(f"{prefix}spread_{i}_{j}")
        for i in range(len(columns))
        for j in range(i + 1)
    ]
    return out


def read_moments(row, columns: int, prefix: str = "") -> Moments:
    rows = row[f"{prefix}rows"]
    if not rows:
        return Moments.none(columns - 1)
    means = np.array([row[f"{prefix}mean_{i}"] for i in range(columns)])
    spread = np.zeros((columns, columns))
    for i in range(columns):
        for j in range(i + 1):
            spread[i, j] = spread[j, i] = row[f"{prefix}spread_{i}_{j}"] * rows
    return Moments(rows, means, spread)


def moments(df: DataFrame, label: str = LABEL) -> Moments:
    columns = [*feature_columns(df), label]
    return read_moments(df.agg(*moment_columns(columns)).first(), len(columns))


def fold_moments(df: DataFrame, folds: int, label: str = LABEL) -> list[Moments]:
    """The moments of each fold, from one scan."""
    columns = [*feature_columns(df), label]
    found = df.groupBy("fold").agg(*moment_columns(columns)).collect()
    by_fold = {r["fold"]: read_moments(r, len(columns)) for r in found}
    return [by_fold.get(k, Moments.none(len(columns) - 1)) for k in range(folds)]


def outside(parts: Sequence[Moments], k: int) -> Moments:
    """All parts but the k-th: put together anew, as taking away would lose digits."""
    return reduce(Moments.__add__, [p for i, p in enumerate(parts) if i != k])


@dataclass(frozen=True)
class LinearFit:
    """A fitted line or plane; with ``log_link`` the logarithm of the prediction is one."""

    intercept: float
    weights: np.ndarray
    log_link: bool = False

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def value(self, *features: Column) -> Column:
        score = F.lit(float(self.intercept))
        for w, x in zip(self.weights, features):
            score = score + F.lit(float(w)) * x
        return F.exp(score) if self.log_link else score

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` and ``prediction``."""
        return df.withColumn("prediction", self.value(*[F.col(c) for c in feature_columns(df)]))


@dataclass(frozen=True)
class ElasticNet:
    """Least squares with penalties on the coefficients of standardized features and label.

    ``reg_param`` 0 is plain least squares, ``elastic_net`` 0 ridge, 1 lasso, as with Spark's
    linear regression. Applied to a table, or to its moments. A feature that does not vary has
    the coefficient 0; of features that say the same each gets a part.
    """

    reg_param: float = 0.0
    elastic_net: float = 0.0

    def __post_init__(self) -> None:
        if self.reg_param < 0 or not 0 <= self.elastic_net <= 1:
            raise ValueError("reg_param is at least 0, elastic_net from 0 to 1")

    def __call__(self, training: DataFrame) -> LinearFit:
        return self.solve(moments(training))

    def solve(self, m: Moments) -> LinearFit:
        if not m.rows:
            raise ValueError("no rows to fit")
        deviations = np.sqrt(np.maximum(np.diag(m.spread), 0.0) / m.rows)
        weights = np.zeros(len(m.means) - 1)
        varying = np.flatnonzero(deviations[:-1] > 0)
        if len(varying) and deviations[-1] > 0:
            picked = np.append(varying, len(weights))
            scale = deviations[picked]
            related = m.spread[np.ix_(picked, picked)] / m.rows / np.outer(scale, scale)
            penalty = self.reg_param / scale[-1]
            ridge, lasso = penalty * (1 - self.elastic_net), penalty * self.elastic_net
            inner = related[:-1, :-1] + ridge * np.eye(len(varying))
            if lasso:
                standard = _descend(inner, related[:-1, -1], lasso)
            else:
                standard = np.linalg.lstsq(inner, related[:-1, -1], rcond=1e-12)[0]
            weights[varying] = standard * scale[-1] / scale[:-1]
        return LinearFit(float(m.means[-1] - weights @ m.means[:-1]), weights)


def _descend(inner: np.ndarray, outer: np.ndarray, lasso: float) -> np.ndarray:
    """Coordinate descent: each coefficient in turn to its best, given the others."""
    x = np.zeros(len(outer))
    for _ in range(MAX_ROUNDS):
        moved = 0.0
        for j in range(len(x)):
            pull = outer[j] - inner[j] @ x + inner[j, j] * x[j]
            best = np.sign(pull) * max(abs(pull) - lasso, 0.0) / inner[j, j]
            moved, x[j] = max(moved, abs(best - x[j])), best
        if moved <= TOLERANCE:
            break
    return x


def predicted_moments(fit: LinearFit, month_id: float, starts: Moments) -> Moments:
    """The moments of one month's predictions, a row for each category.

    ``starts`` are those of the categories' own rows: features (id, [category_idx]) of which
    only the category index counts, and a label that does not count.
    """
    p = len(fit.weights)
    means = starts.means.copy()
    means[0] = month_id
    spread = np.zeros_like(starts.spread)
    if p > 1:
        spread[1:p, 1:p] = starts.spread[1:p, 1:p]
        spread[p, :p] = spread[:p, p] = spread[:p, :p] @ fit.weights
        spread[p, p] = fit.weights @ spread[:p, :p] @ fit.weights
    means[p] = fit.intercept + fit.weights @ means[:p]
    return Moments(starts.rows, means, spread)

"""Linear regression on chosen features, and the search for the best features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import sqrt
from operator import add

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

Coefficients = tuple[float, list[float]]

# A deviation below this share of the mean is rounding: the column is constant.
CONSTANT = 1e-13
# 2**n groups of missing values come to the driver.
MOST_CANDIDATES = 12


def assemble(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """Rows without a null in the columns, with the columns gathered into a vector."""
    kept = df.na.drop(subset=list(columns))
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(kept)


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> LinearRegressionModel:
    """Least squares on the rows where neither the label nor a feature is null."""
    rows = assemble(df.select(*features, label).na.drop(), features, "temp")
    return LinearRegression(featuresCol="temp", labelCol=label).fit(rows)


def predicted(features: Sequence[str], coefficients: Coefficients) -> Column:
    """The fitted value as a plain expression, null where a feature is null."""
    intercept, slopes = coefficients
    value = F.lit(float(intercept))
    for name, slope in zip(features, slopes):
        value = value + F.lit(float(slope)) * F.col(name)
    return value


def mean_absolute_error(label: str, value: Column) -> Column:
    """Aggregate: mean of |label - value| over the rows where both are known."""
    return F.avg(F.abs(F.col(label) - value))


def model_report(df: DataFrame, features: Sequence[str], label: str, coefficients: Coefficients) -> DataFrame:
    """A row per term of a fitted model, with the mean error on the rows of ``df``."""
    intercept, slopes = coefficients
    error = df.agg(mean_absolute_error(label, predicted(features, coefficients)).alias("mae"))
    terms = [("intercept", intercept), *zip(features, slopes)]
    rows = F.array(*(
        F.struct(F.lit(term).alias("term"), F.lit(float(c)).alias("coefficient")) for term, c in terms
    ))
    return error.select(F.inline(rows), "mae")


@dataclass(frozen=True)
class _Moments:
    """Of the rows with the same columns missing: their number, means and sums of products of deviations."""

    missing: frozenset[str]
    n: int
    means: np.ndarray
    spread: np.ndarray


def _moments(df: DataFrame, columns: Sequence[str], label: str) -> list[_Moments]:
    """One pass: means and sums of products of deviations, per set of missing columns.

    Each set of features drops only the rows where one of its own is null. Grouping by which
    columns are null serves all the sets at once: at most 2**n short rows for n candidates, so
    ``MOST_CANDIDATES`` bounds them. Spark's covariances carry deviations from running means,
    which keeps the digits of columns far from zero.
    """
    if len(columns) > MOST_CANDIDATES:
        raise ValueError(f"at most {MOST_CANDIDATES} candidates: their missing values make up to 2**n groups")
    names = [*columns, label]
    value = {name: F.col(name).cast("double") for name in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    missing = reduce(add, (F.col(name).isNull().cast("int") * 2**i for i, name in enumerate(columns)))
    rows = df.filter(F.col(label).isNotNull()).groupBy(missing.alias("_missing")).agg(
        F.count("*").alias("_n"),
        *(F.avg(value[name]).alias(name) for name in names),
        *(F.covar_pop(value[a], value[b]).alias(f"{a}*{b}") for a, b in pairs),
    ).collect()
    found = []
    for row in rows:
        spread = np.zeros((len(names), len(names)))
        for a, b in pairs:
            i, j = names.index(a), names.index(b)
            spread[i, j] = spread[j, i] = (row[f"{a}*{b}"] or 0.0) * row["_n"]
        absent = frozenset(name for i, name in enumerate(columns) if row["_missing"] & 2**i)
        found.append(_Moments(absent, row["_n"], np.array([row[name] or 0.0 for name in names]), spread))
    return found


def _merged(groups: Sequence[_Moments], at: Sequence[int]) -> tuple[int, np.ndarray, np.ndarray]:
    """The moments of all the groups' rows together, for the columns at some positions."""
    n, mean, spread = 0, np.zeros(len(at)), np.zeros((len(at), len(at)))
    for group in groups:
        gap = group.means[at] - mean
        spread += group.spread[np.ix_(at, at)] + np.outer(gap, gap) * (n * group.n / (n + group.n))
        mean += gap * (group.n / (n + group.n))
        n += group.n
    return n, mean, spread


def _solve(moments: Sequence[_Moments], columns: Sequence[str], features: Sequence[str]) -> Coefficients:
    """Least-squares coefficients from the rows where every feature is known."""
    at = [list(columns).index(name) for name in features] + [len(columns)]
    n, mean, spread = _merged([m for m in moments if not m.missing & set(features)], at)
    deviation = np.sqrt(np.maximum(np.diag(spread), 0.0) / max(n, 1))
    varies = deviation > CONSTANT * np.abs(mean)
    scale = np.where(varies, deviation, 1.0)
    correlation = np.where(np.outer(varies, varies), spread / max(n, 1) / np.outer(scale, scale), 0.0)
    slopes, *_ = np.linalg.lstsq(correlation[:-1, :-1], correlation[:-1, -1], rcond=None)
    slopes = slopes * scale[-1] / scale[:-1]
    return float(mean[-1] - slopes @ mean[:-1]), [float(s) for s in slopes]


def least_squares(df: DataFrame, features: Sequence[str], label: str) -> Coefficients:
    """Coefficients of one regression from a single pass of aggregation, without vectors."""
    return _solve(_moments(df, features, label), features, features)


def feature_search(df: DataFrame, candidates: Sequence[str], label: str, size: int = 3) -> DataFrame:
    """Training error of the regression on every set of ``size`` candidates.

    Two passes over the data whatever the number of sets: one for the moments, from which each
    set's coefficients follow, and one for the errors of all sets. Only moments, a few hundred
    numbers, reach the driver.
    """
    sets = list(combinations(candidates, size))
    moments = _moments(df, candidates, label)
    errors = df.agg(*(
        mean_absolute_error(label, predicted(features, _solve(moments, candidates, features))).alias(f"_mae{i}")
        for i, features in enumerate(sets)
    ))
    rows = [
        F.struct(F.lit(",".join(features)).alias("features"), F.col(f"_mae{i}").alias("mae"))
        for i, features in enumerate(sets)
    ]
    return errors.select(F.inline(F.array(*rows)))


def _swept(a: np.ndarray, k: int) -> np.ndarray:
    """The sweep operator on column k: what is swept in is regressed on, and sweeping again takes it out."""
    out = a - np.outer(a[:, k], a[k, :]) / a[k, k]
    out[k, :], out[:, k] = a[k, :] / a[k, k], -a[:, k] / a[k, k]
    out[k, k] = 1 / a[k, k]
    return out


def stepwise(df: DataFrame, candidates: Sequence[str], label: str, steps: int | None = None, tolerance: float = 1e-9) -> DataFrame:
    """Candidates in the order in which each explains most of what is left of the label: (step, feature, r_squared).

    The moments of one pass hold all that a regression on any of the candidates needs; each step is a sweep of their
    correlation matrix on the driver, so the data are read once whatever the number of steps. Only rows
    where the label and every candidate are known count, so that steps can be compared. A candidate that
    others already determine, by ``tolerance``, or that does not vary, is never chosen; ties go to the
    candidate named first.
    """
    moments = _moments(df, candidates, label)
    n, mean, spread = _merged([m for m in moments if not m.missing], range(len(candidates) + 1))
    deviation = np.sqrt(np.maximum(np.diag(spread), 0.0) / max(n, 1))
    varies = deviation > CONSTANT * np.abs(mean)
    scale = np.where(varies, deviation, 1.0)
    swept = np.where(np.outer(varies, varies), spread / max(n, 1) / np.outer(scale, scale), 0.0)
    left, chosen = [i for i in range(len(candidates)) if varies[i]] if varies[-1] else [], []
    while left and (steps is None or len(chosen) < steps):
        gains = {i: swept[i, -1] ** 2 / swept[i, i] for i in left if swept[i, i] > tolerance}
        if not gains:
            break
        best = max(gains, key=gains.get)
        swept = _swept(swept, best)
        left.remove(best)
        chosen.append((len(chosen) + 1, candidates[best], float(1 - swept[-1, -1])))
    return df.sparkSession.createDataFrame(chosen, "step INT, feature STRING, r_squared DOUBLE")


def best_features(searched: DataFrame) -> DataFrame:
    """The feature set with the smallest error."""
    return searched.orderBy("mae", "features").limit(1)

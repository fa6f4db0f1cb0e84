"""k-means on scaled columns, with its score and centres.

Rows that agree in the clustered columns are the same point. They are counted once, in one pass,
and everything after works on the counted points: the objective of k-means is unchanged by the
weights, and flags, months and airport positions leave few points however many flights there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import sqrt
from operator import add

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from flightlens.session import materialize

SEEDS = (1, 2, 3)


def scaled_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns and their scaled values as plain numbers, without going through vectors."""
    kept = df.select(*columns).na.drop()
    found = kept.agg(*(F.stddev_samp(name).alias(name) for name in columns)).first()
    return kept.withColumns({_scaled(name): _unit(name, found[name]) for name in columns})


@dataclass(frozen=True)
class Clusters:
    """A fitted clustering: clusters are numbered by their sorted centres."""

    columns: tuple[str, ...]
    deviations: tuple[float, ...]
    points: DataFrame
    model: KMeansModel

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the nearest centre, to rows that have the clustered columns.

        The centres are a few numbers, so they become part of the expression: each row is looked
        at once, and nothing is shuffled.
        """
        axes = [_unit(name, s) for name, s in zip(self.columns, self.deviations)]

        def distance(center: Sequence[float]) -> Column:
            gaps = [x - F.lit(float(c)) for x, c in zip(axes, center)]
            return reduce(add, (gap * gap for gap in gaps))

        options = [
            F.struct(distance(center), F.lit(number).alias("number"))
            for number, center in enumerate(self.scaled_centers())
        ]
        kept = df.na.drop(subset=list(self.columns))
        return kept.withColumn("prediction", F.array_min(F.array(*options))["number"])

    def scaled_centers(self) -> list[list[float]]:
        """Centres in units of the deviations, in order."""
        centers = self.model.clusterCenters()
        return sorted([float(x) for x in center] for center in centers)

    def centers(self) -> DataFrame:
        """Cluster centres, in scaled and in original units."""
        spark: SparkSession = self.points.sparkSession
        rows = [
            (number, *center, *(c * s for c, s in zip(center, self.deviations)))
            for number, center in enumerate(self.scaled_centers())
        ]
        names = [*map(_scaled, self.columns), *self.columns]
        schema = ", ".join(["prediction INT", *(f"{name} DOUBLE" for name in names)])
        return spark.createDataFrame(rows, schema)

    def sizes(self) -> DataFrame:
        """Rows per cluster."""
        return self.assign(self.points).groupBy("prediction").agg(F.sum("weight").alias("members"))

    def silhouette(self) -> DataFrame:
        """Mean silhouette over all rows, by squared Euclidean distance.

        The mean squared distance from a point to a cluster needs only the cluster's count, sum
        and sum of squared norms. A point is compared with all other rows, so of the rows that
        share its position only the row itself is left out.
        """
        spots = self.assign(self.points)
        axes = [_unit(name, s) for name, s in zip(self.columns, self.deviations)]
        norm = reduce(add, (x * x for x in axes))
        weight = F.col("weight")
        clusters = spots.groupBy("prediction").agg(
            F.sum(weight).alias("n"), F.sum(norm * weight).alias("norms"),
            *(F.sum(x * weight).alias(f"sum{i}") for i, x in enumerate(axes)),
        ).collect()

        def distance(row: Row) -> Column:
            dot = reduce(add, (x * float(row[f"sum{i}"]) for i, x in enumerate(axes)))
            return norm + float(row["norms"]) / row["n"] - dot * 2 / row["n"]

        def mine(row: Row) -> Column:
            return F.col("prediction") == row["prediction"]

        own = F.coalesce(*(
            F.when(mine(row), distance(row) * (row["n"] / (row["n"] - 1))) for row in clusters if row["n"] > 1
        ), F.lit(None).cast("double"))
        others = [F.when(~mine(row), distance(row)) for row in clusters]
        other = F.array_min(F.array(*others))
        score = F.coalesce(F.try_divide(other - own, F.greatest(own, other)), F.lit(0.0))
        total = F.sum(score * weight) / F.sum(weight)
        return spots.agg(F.lit(len(self.scaled_centers())).alias("k"), total.alias("silhouette"))


def _scaled(name: str) -> str:
    return f"scaled_{name}"


def _unit(name: str, deviation: float) -> Column:
    """The column in units of its deviation; a constant column becomes 0, as in the scaler."""
    return F.col(name).cast("double") / F.lit(deviation) if deviation else F.lit(0.0)


def _with_features(df: DataFrame, columns: Sequence[str], deviations: Sequence[float]) -> DataFrame:
    scaled = {_scaled(name): _unit(name, s) for name, s in zip(columns, deviations)}
    rows = df.withColumns(scaled)
    return VectorAssembler(inputCols=list(scaled), outputCol="features").transform(rows)


def _deviations(points: DataFrame, columns: Sequence[str]) -> tuple[float, ...]:
    """Sample standard deviation of each column over all rows, from the counted points."""
    total = F.sum("weight")
    mean = points.agg(
        total.alias("n"),
        *((F.sum(F.col(c) * F.col("weight")) / total).alias(c) for c in columns),
    ).first()
    squares = points.agg(*(
        F.sum((F.col(c) - F.lit(float(mean[c]))) * (F.col(c) - F.lit(float(mean[c]))) * F.col("weight")).alias(c)
        for c in columns
    )).first()
    return tuple(sqrt(squares[c] / (mean["n"] - 1)) if mean["n"] > 1 else 0.0 for c in columns)


def fit_clusters(df: DataFrame, columns: Sequence[str], k: int, seeds: Sequence[int] = SEEDS) -> Clusters:
    """k-means on the scaled columns: the cheapest of a few starts, clusters in order of centre."""
    return fit_cluster_counts(df, columns, [k], seeds)[k]


def fit_cluster_counts(
    df: DataFrame, columns: Sequence[str], ks: Iterable[int], seeds: Sequence[int] = SEEDS,
) -> dict[int, Clusters]:
    """A clustering for each number of clusters, all from one count of the points.

    A single start can end in a poorer local optimum that depends on the partitioning. Every fit
    runs until no centre moves or for 100 iterations, whichever comes first.
    """
    columns = tuple(columns)
    counted = df.select(*columns).na.drop().groupBy(*columns).agg(F.count("*").alias("weight"))
    points = materialize(counted, "counted-points")
    deviations = _deviations(points, columns)
    rows = _with_features(points, columns, deviations).select("features", "weight").persist()
    found = {}
    for k in ks:
        fits = [
            KMeans(
                k=k, featuresCol="features", predictionCol="prediction", weightCol="weight", seed=seed, tol=0.0, maxIter=100,
            ).fit(rows) for seed in seeds
        ]
        best = min(fits, key=lambda model: model.summary.trainingCost)
        found[k] = Clusters(columns, deviations, points, best)
    rows.unpersist()
    return found

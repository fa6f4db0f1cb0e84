import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as registered
from flightlens import fixtures as fx
from flightlens.operators.clustering import fit_clusters, scaled_columns
from flightlens.operators.regression import (
    assemble,
    best_features,
    feature_search,
    fit_linear,
    least_squares,
    mean_absolute_error,
    predicted,
    stepwise,
)
from flightlens.plans.constants import REGRESSION_CANDIDATES


def scale_features(df, columns):
    """Spark ML's own scaling: ``data`` (the columns as a vector) and ``features`` (to unit deviation)."""
    rows = assemble(df, columns, "data")
    return StandardScaler(inputCol="data", outputCol="features").fit(rows).transform(rows)


@pytest.fixture(scope="module")
def edges(spark, tables):
    return fx.flight_edges(spark, tables, (*REGRESSION_CANDIDATES, "flights")).persist()


@pytest.mark.parametrize("features", list(combinations(REGRESSION_CANDIDATES, 3))[::3])
def test_search_agrees_with_spark_ml(edges, features):
    """Same coefficients and same error, on the rows complete in this set's own columns."""
    model = fit_linear(edges, features, "flights")
    intercept, slopes = least_squares(edges, features, "flights")
    assert np.allclose([intercept, *slopes], [model.intercept, *model.coefficients], rtol=1e-6, atol=1e-10)
    rows = edges.na.drop(subset=list(features))
    ml = model.transform(_assembled(rows, features)).agg(F.avg(F.abs(F.col("flights") - F.col("prediction")))).first()[0]
    search = {r.features: r.mae for r in feature_search(edges, REGRESSION_CANDIDATES, "flights").collect()}
    assert search[",".join(features)] == pytest.approx(ml, abs=1e-9)


def _assembled(rows, features):
    from flightlens.operators.regression import assemble
    return assemble(rows, features, "temp")


def test_search_covers_all_triples(edges):
    searched = feature_search(edges, REGRESSION_CANDIDATES, "flights")
    rows = searched.collect()
    assert [r.features for r in rows] == [",".join(c) for c in combinations(REGRESSION_CANDIDATES, 3)]
    best = best_features(searched).collect()
    assert len(best) == 1 and best[0].mae == min(r.mae for r in rows)


def test_nulls_count_per_feature_set(spark):
    """A null in c removes rows only for sets that use c; a null label removes them always."""
    source = random.Random(5)
    rows = []
    for i in range(400):
        a, b, c = source.uniform(0, 9), source.uniform(1e6, 1e6 + 9), source.uniform(-9, 9)
        y = 2 * a - 3 * b + c + 7
        rows.append((a, b if i % 5 else None, c if i % 3 else None, y if i % 7 else None))
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    for features in (("a", "b"), ("a", "c"), ("a", "b", "c")):
        kept = [r for r in rows if r[3] is not None and all(r["abc".index(f)] is not None for f in features)]
        design = np.array([[1.0, *(r["abc".index(f)] for f in features)] for r in kept])
        expected, *_ = np.linalg.lstsq(design, np.array([r[3] for r in kept]), rcond=None)
        intercept, slopes = least_squares(df, features, "y")
        assert np.allclose(slopes, expected[1:], rtol=1e-6)
        error = df.agg(mean_absolute_error("y", predicted(features, (intercept, slopes)))).first()[0]
        assert error == pytest.approx(np.mean(np.abs(design @ expected - [r[3] for r in kept])), abs=1e-5)
        mae = {r.features: r.mae for r in feature_search(df, features, "y", len(features)).collect()}
        assert mae[",".join(features)] == pytest.approx(error)


def test_constant_and_repeated_features(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 4.0, 3.0 * i + 1) for i in range(20)], "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    intercept, slopes = least_squares(df, ("a", "b", "c"), "y")
    error = df.agg(mean_absolute_error("y", predicted(("a", "b", "c"), (intercept, slopes)))).first()[0]
    assert error == pytest.approx(0, abs=1e-9) and slopes[2] == 0


def test_scaling_agrees_with_the_scaler(spark):
    df = spark.createDataFrame([(i % 2, i % 12, float(i) if i else None, 5) for i in range(50)], "a INT, b INT, c DOUBLE, k INT")
    columns = ("a", "b", "c", "k")
    ml = scale_features(df, columns).select(vector_to_array("features").alias("f")).collect()
    ours = scaled_columns(df, columns).select(*(f"scaled_{c}" for c in columns)).collect()
    assert len(ours) == 49
    assert np.allclose(sorted(tuple(r.f) for r in ml), sorted(tuple(r) for r in ours))


def _blobs(spark, copies=1):
    source = random.Random(3)
    rows = [(source.gauss(cx, 0.4), source.gauss(cy, 0.4)) for cx, cy in ((0, 0), (9, 9)) for _ in range(60)]
    return spark.createDataFrame([row for row in rows for _ in range(copies)], "x DOUBLE, y DOUBLE")


def test_two_blobs(spark):
    clusters = fit_clusters(_blobs(spark), ("x", "y"), 2)
    assert sorted(r.members for r in clusters.sizes().collect()) == [60, 60]
    assert clusters.silhouette().first().silhouette > 0.9
    centers = clusters.centers().orderBy("prediction").collect()
    assert [round(c.x) for c in centers] == [0, 9]


@pytest.mark.parametrize("k, copies", [(2, 1), (3, 4)])
def test_silhouette_agrees_with_the_evaluator_on_all_rows(spark, k, copies):
    rows = _blobs(spark, copies)
    clusters = fit_clusters(rows, ("x", "y"), k)
    scaled = scale_features(clusters.assign(rows), ("x", "y")).withColumn("prediction", F.col("prediction").cast("double"))
    expected = ClusteringEvaluator().evaluate(scaled)
    assert clusters.silhouette().first().silhouette == pytest.approx(expected, abs=1e-9)


def test_silhouette_of_a_cluster_of_one(spark):
    rows = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (50.0,)], "x DOUBLE")
    clusters = fit_clusters(rows, ("x",), 2)
    scaled = scale_features(clusters.assign(rows), ("x",)).withColumn("prediction", F.col("prediction").cast("double"))
    expected = ClusteringEvaluator().evaluate(scaled)
    assert clusters.silhouette().first().silhouette == pytest.approx(expected, abs=1e-9)


def test_flight_clusters(spark, tables):
    """Centres are the means of their members; counting equal rows does not worsen the objective."""
    queries = registered.queries()
    rows = queries["kmeans_predictions"](spark, tables).persist()
    flights, airports = registered._clustering_inputs(spark, tables)
    from flightlens.plans.models import flight_clusters
    clusters = flight_clusters(flights, airports)
    means = {r.prediction: r for r in rows.groupBy("prediction").agg(
        F.avg("Cancelled").alias("c"), F.avg("Month").alias("m"), F.avg("Latitude").alias("l"), F.count("*").alias("n")
    ).collect()}
    for center in clusters.centers().collect():
        mine = means[center.prediction]
        assert (center.Cancelled, center.Month, center.Latitude) == pytest.approx((mine.c, mine.m, mine.l), abs=1e-6)
    assert {r.prediction: r.members for r in clusters.sizes().collect()} == {p: m.n for p, m in means.items()}
    assert rows.count() == queries["flights_at_airports_in_box"](spark, tables).count()

    scaled = scale_features(rows.drop("prediction"), ("Cancelled", "Month", "Latitude"))
    plain = min(
        KMeans(k=2, featuresCol="features", seed=seed).fit(scaled).summary.trainingCost for seed in (1, 2, 3)
    )
    assert clusters.model.summary.trainingCost <= plain * 1.01
    assert -1 <= clusters.silhouette().first().silhouette <= 1


def test_several_counts_of_clusters_from_one_count_of_points(spark, monkeypatch):
    from flightlens.operators import clustering
    calls = []
    monkeypatch.setattr(clustering, "materialize", lambda df, name: calls.append(name) or df.persist())
    found = clustering.fit_cluster_counts(_blobs(spark), ("x", "y"), (2, 3))
    assert calls == ["counted-points"] and {k: len(c.scaled_centers()) for k, c in found.items()} == {2: 2, 3: 3}
    assert sorted(r.members for r in found[2].sizes().collect()) == [60, 60]


def test_stepwise_against_least_squares(spark):
    """Each step takes the candidate with the largest r squared of a fit on all chosen so far and itself."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4))
    x[:, 3] = x[:, 0] + x[:, 1]  # determined by two others
    y = 3 * x[:, 1] + x[:, 0] + 0.3 * x[:, 2] + rng.normal(size=300)
    rows = [(*map(float, a), 5.0, float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, fixed DOUBLE, y DOUBLE")
    got = [tuple(r) for r in stepwise(df, ["a", "b", "c", "d", "fixed"], "y").orderBy("step").collect()]

    def r_squared(columns):
        design = np.column_stack([np.ones(300), x[:, columns]])
        left = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
        return 1 - left.var() / y.var()

    chosen = []
    for step, feature, found in got:
        best = max(r_squared([*chosen, i]) for i in range(4) if i not in chosen)
        chosen.append("abcd".index(feature))
        assert math.isclose(found, best, abs_tol=1e-9) and math.isclose(found, r_squared(chosen), abs_tol=1e-9) and step == len(chosen)
    assert len(got) == 3
    assert stepwise(df, ["fixed"], "y").count() == 0 and stepwise(df, ["a", "b"], "y", steps=1).count() == 1

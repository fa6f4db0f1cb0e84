"""The modelling reports: what predicts the number of flights, and clusters of flights."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from flightlens.operators.clustering import Clusters, fit_cluster_counts, fit_clusters, scaled_columns
from flightlens.operators.regression import best_features, feature_search, fit_linear, least_squares, model_report
from flightlens.plans.constants import (
    CLUSTER_COLUMNS,
    CLUSTER_COUNT,
    REGRESSION_CANDIDATES,
    REGRESSION_LABEL,
)
from flightlens.plans.delays import flights_at_airports


def flight_count_search(edges: DataFrame, candidates: Sequence[str] = REGRESSION_CANDIDATES) -> DataFrame:
    """Error of predicting the flights of an edge, for every three of the candidates."""
    return feature_search(edges, candidates, REGRESSION_LABEL)


def best_flight_count_features(edges: DataFrame, candidates: Sequence[str] = REGRESSION_CANDIDATES) -> DataFrame:
    return best_features(flight_count_search(edges, candidates))


def flight_count_model(edges: DataFrame, features: Sequence[str]) -> DataFrame:
    """One regression fitted by Spark ML: its coefficients and training error."""
    model = fit_linear(edges, features, REGRESSION_LABEL)
    coefficients = (model.intercept, [float(c) for c in model.coefficients])
    return model_report(edges, features, REGRESSION_LABEL, coefficients)


def delay_temperature_model(pairs: DataFrame) -> DataFrame:
    """Delay predicted from the temperatures at both ends."""
    features, label = ("origin_temperature", "destination_temperature"), "delay"
    return model_report(pairs, features, label, least_squares(pairs, features, label))


def _clustered_flights(flights: DataFrame, airports: DataFrame) -> DataFrame:
    return flights_at_airports(flights, airports, columns=CLUSTER_COLUMNS)


def scaled_flights(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Cancellation, month and latitude of flights, scaled to unit deviation."""
    return scaled_columns(_clustered_flights(flights, airports), CLUSTER_COLUMNS)


def flight_clusters(flights: DataFrame, airports: DataFrame, k: int = CLUSTER_COUNT) -> Clusters:
    return fit_clusters(_clustered_flights(flights, airports), CLUSTER_COLUMNS, k)


def flight_cluster_counts(flights: DataFrame, airports: DataFrame, ks: Iterable[int]) -> dict[int, Clusters]:
    """Clusterings of the same flights into several numbers of clusters, from one pass over them."""
    return fit_cluster_counts(_clustered_flights(flights, airports), CLUSTER_COLUMNS, ks)


def flight_predictions(flights: DataFrame, airports: DataFrame, k: int = CLUSTER_COUNT) -> DataFrame:
    """Flights with the number of their cluster."""
    rows = _clustered_flights(flights, airports)
    return fit_clusters(rows, CLUSTER_COLUMNS, k).assign(rows)

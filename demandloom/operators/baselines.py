"""Forecasters that are plain column expressions over the features."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column

# A forecaster maps feature name -> Column to a prediction Column.  The same
# function scores a feature frame and drives the recursive forecast.
ExpressionForecaster = Callable[[Mapping[str, Column]], Column]


def naive(features: Mapping[str, Column]) -> Column:
    return features["lag_1"]


def seasonal_naive(features: Mapping[str, Column]) -> Column:
    return features["lag_7"]


def rolling_mean(features: Mapping[str, Column]) -> Column:
    return features["rolling_mean_7"]


BASELINES: dict[str, ExpressionForecaster] = {
    "naive_lag_1": naive,
    "seasonal_naive_lag_7": seasonal_naive,
    "rolling_mean_7": rolling_mean,
}

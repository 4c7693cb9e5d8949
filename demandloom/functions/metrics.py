"""Forecast error metrics as aggregate expressions.

They are plain aggregates, so one pass gives them globally or per window,
model, store ... and every metric combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.schemas import SERIES_KEYS


def _error(actual: Column, predicted: Column) -> Column:
    return predicted.cast("double") - actual.cast("double")


def _ratio(numerator: Column, denominator: Column, what: str, on_zero: str) -> Column:
    if on_zero == "error":
        stop = F.raise_error(F.lit(f"{what} is undefined: its denominator is zero")).cast("double")
        return F.when(denominator == 0, stop).otherwise(numerator / denominator)
    return F.when(denominator != 0, numerator / denominator)


def wmape(actual: Column, predicted: Column, on_zero: str = "error") -> Column:
    """Sum of absolute errors over the (signed) sum of actuals."""
    return _ratio(
        F.sum(F.abs(_error(actual, predicted))), F.sum(actual.cast("double")), "WMAPE", on_zero)


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(_error(actual, predicted)))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(_error(actual, predicted), 2)))


def bias(actual: Column, predicted: Column, on_zero: str = "error") -> Column:
    """Signed relative error, a secondary metric without a fixed definition elsewhere."""
    return _ratio(F.sum(_error(actual, predicted)), F.sum(actual.cast("double")), "bias", on_zero)


def series_scale(
    history: DataFrame, keys: Sequence[str] = SERIES_KEYS, date_col: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Mean squared first difference per series over the whole history given.

    The window holds one series; the grain (one row per series and day) bounds it.
    """
    w = Window.partitionBy(*keys).orderBy(date_col)
    step = F.col(target).cast("double") - F.lag(F.col(target).cast("double")).over(w)
    return (
        history.select(*keys, date_col, target)
        .withColumn("_step", step)
        .groupBy(*keys)
        .agg(F.avg(F.pow("_step", 2)).alias("scale"), F.count(F.lit(1)).alias("train_rows"))
    )


def rmsse_by_series(
    scored: DataFrame, history: DataFrame, keys: Sequence[str] = SERIES_KEYS,
    date_col: str = "date", target: str = "sales", prediction: str = "prediction",
    on_undefined: str = "error",
) -> DataFrame:
    """RMSSE per series; short history or zero scale is an error, or a null row."""
    mse = (
        scored.groupBy(*keys)
        .agg(F.avg(F.pow(_error(F.col(target), F.col(prediction)), 2)).alias("mse"),
             F.count(F.lit(1)).alias("test_rows"))
    )
    scale = series_scale(history, keys, date_col, target)
    defined = (F.coalesce(F.col("train_rows"), F.lit(0)) >= 2) & (F.col("scale") > 0)
    value = F.when(defined, F.sqrt(F.col("mse") / F.col("scale")))
    if on_undefined == "error":
        value = F.when(
            ~F.coalesce(defined, F.lit(False)),
            F.raise_error(F.lit("RMSSE needs two observations and a non-zero scale")).cast("double"),
        ).otherwise(value)
    return mse.join(scale, list(keys), "left").select(
        *keys, "test_rows", F.coalesce("train_rows", F.lit(0)).alias("train_rows"),
        "scale", value.alias("rmsse"))


def wrmsse(
    per_series: DataFrame, weights: DataFrame, keys: Sequence[str] = SERIES_KEYS,
    weight: str = "weight",
) -> DataFrame:
    """Weighted mean of per-series RMSSE in one row.

    Series on one side only, no series at all, negative weights and a zero
    weight sum are errors.
    """
    both = per_series.select(*keys, "rmsse").join(
        weights.select(*keys, F.col(weight).cast("double").alias("_w")), list(keys), "full_outer")
    total = F.sum("_w")

    def stop(text: str) -> Column:
        return F.raise_error(F.lit(text)).cast("double")

    value = (
        F.when(F.count(F.lit(1)) == 0, stop("WRMSSE needs at least one series"))
        .when(F.count_if(F.col("rmsse").isNull() | F.col("_w").isNull()) > 0,
              stop("WRMSSE needs one value and one weight per series"))
        .when(F.count_if(F.col("_w") < 0) > 0, stop("WRMSSE weights must not be negative"))
        .when(total == 0, stop("WRMSSE is undefined: the weights sum to zero"))
        .otherwise(F.sum(F.col("rmsse") * F.col("_w")) / total)
    )
    return both.agg(F.count(F.lit(1)).alias("series_count"), value.alias("wrmsse"))

"""Forecast run monitoring, freshness and serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_KEYS = ("generated_at", "model_name", "model_version", "feature_set_name")


def run_monitoring(forecasts: DataFrame) -> DataFrame:
    """One row per forecast run."""
    return forecasts.groupBy(*RUN_KEYS).agg(
        F.min("forecast_date").alias("min_forecast_date"),
        F.max("forecast_date").alias("max_forecast_date"),
        F.count(F.lit(1)).alias("forecast_row_count"),
        F.count_distinct("store_id", "item_id").alias("forecast_series_count"))


def latest_batch(forecasts: DataFrame) -> DataFrame:
    """Rows of the newest batch; the bound is a scalar, so it filters the scan."""
    newest = forecasts.agg(F.max("generated_at")).scalar()
    return forecasts.where(F.col("generated_at") == newest)


def latest_freshness(forecasts: DataFrame) -> DataFrame:
    """Monitoring of the newest batch plus its length in days, both ends included."""
    return run_monitoring(latest_batch(forecasts)).withColumn(
        "forecast_horizon_days", F.datediff("max_forecast_date", "min_forecast_date") + 1)


def fetch_freshness(freshness: DataFrame) -> DataFrame:
    return freshness.orderBy(F.desc_nulls_first("generated_at"))


def fetch_run_monitoring(monitoring: DataFrame, limit: int | None = 50) -> DataFrame:
    """Newest runs first; the other run keys break ties."""
    if limit is None:
        return monitoring
    return monitoring.orderBy(F.desc_nulls_first("generated_at"), *RUN_KEYS[1:]).limit(limit)


def fetch_forecast_rows(forecasts: DataFrame, limit: int | None = 500) -> DataFrame:
    """Newest batch first, then by day; a distributed top-k, not a sort.

    Without a limit, the whole latest batch.
    """
    if limit is None:
        return latest_batch(forecasts)
    return forecasts.orderBy(
        F.desc_nulls_first("generated_at"), "forecast_date", "store_id", "item_id",
        *RUN_KEYS[1:]).limit(limit)


def snapshot_metadata(freshness: DataFrame, monitoring: DataFrame, rows: DataFrame,
                      run_id: str) -> DataFrame:
    """One metadata row; without a fresh batch the row count falls back to the rows.

    A batch written by several models has several freshness rows; the first in
    run-key order describes the snapshot.
    """
    first = freshness.agg(F.min_by(
        F.struct(*freshness.columns), F.struct(*[F.col(c) for c in RUN_KEYS[1:]])).alias("f"))
    counted_rows = rows.agg(F.count(F.lit(1))).scalar()
    counted_runs = monitoring.agg(F.count(F.lit(1))).scalar()
    return first.select(
        F.lit(run_id).alias("snapshot_run_id"), F.lit(run_id).alias("refreshed_at"),
        F.col("f.generated_at").alias("source_generated_at"), "f.model_name", "f.model_version",
        "f.feature_set_name",
        F.coalesce("f.forecast_row_count", counted_rows).alias("forecast_row_count"),
        "f.forecast_series_count", "f.forecast_horizon_days",
        counted_runs.alias("monitoring_row_count"))

"""Batch prediction and the published snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators import models, monitoring, recursion
from demandloom.sinks import snapshots
from demandloom.sinks.forecasts import ForecastTable


@dataclass(frozen=True)
class PredictionConfig:
    history_rows: int = recursion.HISTORY_ROWS
    horizon: int = recursion.HORIZON
    feature_set: str = S.DEFAULT_FEATURE_SET
    checkpoint_every: int = 7


def predict(
    spark: SparkSession, extract: DataFrame, model_root: str, model_name: str,
    table: ForecastTable, generated_at: datetime, config: PredictionConfig = PredictionConfig(),
) -> str:
    """Score the next days with the newest model version and overwrite the horizon."""
    model, version = models.load_latest_model(spark, model_root, model_name)
    forecast = recursion.forecast_model(
        extract, model, S.feature_columns(config.feature_set), config.horizon,
        config.history_rows, config.checkpoint_every)
    table.overwrite(recursion.with_run_metadata(
        forecast, model_name, version, config.feature_set, generated_at))
    return version


def export_snapshot(forecasts: DataFrame, root: str, run_id: str, cache: str | None = None,
                    monitoring_limit: int | None = None, row_limit: int | None = None) -> None:
    """Freshness, monitoring and the latest batch of the forecast table, plus metadata.

    Limits are the caller's choice; ``truncated`` in the metadata tells whether the
    published rows are fewer than the batch.
    """
    runs = monitoring.run_monitoring(forecasts)
    freshness = monitoring.fetch_freshness(monitoring.latest_freshness(forecasts))
    recent_runs = monitoring.fetch_run_monitoring(runs, monitoring_limit)
    rows = monitoring.fetch_forecast_rows(forecasts, row_limit)
    metadata = monitoring.snapshot_metadata(freshness, recent_runs, rows, run_id).withColumn(
        "truncated", F.col("forecast_row_count") > rows.agg(F.count(F.lit(1))).scalar())
    snapshots.publish(
        {snapshots.FRESHNESS: freshness, snapshots.MONITORING: recent_runs, snapshots.ROWS: rows},
        metadata, root, run_id, cache)

"""Training: extract -> features -> complete cases -> backtest -> refit -> store."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators import backtest, features, models
from demandloom.operators.splits import BacktestConfig
from demandloom.session import scratch_path
from demandloom.sinks.tables import refresh_path


@dataclass(frozen=True)
class TrainingRun:
    model: PipelineModel
    version: str
    params: DataFrame
    windows: DataFrame
    metrics: DataFrame
    importance: DataFrame


def modeling_frame(extract: DataFrame, feature_set: str) -> DataFrame:
    """Complete cases with only the columns the fits read."""
    columns = S.feature_columns(feature_set)
    ready = features.complete_cases(features.build_features(extract), feature_set)
    return ready.select(*S.GRAIN, *columns, "sales")


def train(spark: SparkSession, extract: DataFrame, config: models.TreeConfig, model_root: str,
          parallelism: int = 1) -> TrainingRun:
    """One training run; its records are small DataFrames to write or show.

    The modeling frame is stored in the shared folder, because every window
    and the final fit read it again and a lost executor must not recompute it.
    """
    columns = S.feature_columns(config.feature_set)
    modeling = refresh_path(
        modeling_frame(extract, config.feature_set), scratch_path(spark, "modeling"))
    windows = backtest.backtest_model(
        modeling, columns, models.estimator_factory(config),
        BacktestConfig(config.horizon_days, config.n_windows), parallelism,
        history=extract.select(*S.GRAIN, "sales"))
    model = models.fit(modeling, config)
    version = models.save_model(model, model_root, config.name)
    settings = {**asdict(config), "feature_count": len(columns),
                "feature_columns": ",".join(columns)}
    params = spark.createDataFrame(
        [(k, str(v)) for k, v in sorted(settings.items())], "name string, value string")
    averages = backtest.mean_metrics(windows).withColumn(
        "modeling_rows", modeling.agg(F.count(F.lit(1))).scalar())
    return TrainingRun(model, version, params, windows, averages,
                       models.feature_importance(model, columns))

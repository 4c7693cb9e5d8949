"""Publish dashboard snapshots: versioned history, and a pointer to the latest run."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "run_id string, published_at string"

# Dataset names inside a snapshot.
FRESHNESS, MONITORING, ROWS, METADATA = (
    "latest_forecast_freshness", "forecast_run_monitoring", "forecast_rows", "snapshot_metadata")


def history_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/history/{run_id}"


def pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/latest"


def latest_path(root: str, spark: SparkSession) -> str:
    """Folder of the newest published run, or of none: the pointer names it.

    Each publication adds one line to the pointer's folder; the last run by its
    time of publication counts.
    """
    try:
        rows = spark.read.schema(_POINTER).json(pointer_path(root))
        newest = rows.orderBy(F.desc("published_at"), F.desc("run_id")).head()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return history_path(root, newest["run_id"]) if newest else f"{history_path(root, 'none')}"


def _write(frames: Mapping[str, DataFrame], metadata: DataFrame, base: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    metadata.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{base}/{METADATA}")


def publish(frames: Mapping[str, DataFrame], metadata: DataFrame, root: str, run_id: str,
            cache: str | None = None) -> None:
    """History first, then the cache as a copy of it, then the pointer to the new run.

    The queries run once.  Readers see the whole previous run or the whole new one:
    the pointer is a single small file, written last, and a failed run never gets there.
    """
    spark = metadata.sparkSession
    target = history_path(root, run_id)
    _write(frames, metadata, target)
    if cache:
        stored = {name: spark.read.schema(df.schema).parquet(f"{target}/{name}")
                  for name, df in frames.items()}
        _write(stored, spark.read.schema(metadata.schema).json(f"{target}/{METADATA}"), cache)
    now = datetime.now(timezone.utc).isoformat()
    spark.createDataFrame([(run_id, now)], _POINTER).coalesce(1).write.mode("append").json(pointer_path(root))

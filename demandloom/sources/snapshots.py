"""Read published snapshots, falling back to a cache and then to nothing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONITORING_SCHEMA = T.StructType([
    T.StructField("generated_at", T.TimestampType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("feature_set_name", T.StringType()),
    T.StructField("min_forecast_date", T.DateType()),
    T.StructField("max_forecast_date", T.DateType()),
    T.StructField("forecast_row_count", T.LongType()),
    T.StructField("forecast_series_count", T.LongType()),
])
FRESHNESS_SCHEMA = T.StructType(
    MONITORING_SCHEMA.fields + [T.StructField("forecast_horizon_days", T.IntegerType())])
METADATA_SCHEMA = T.StructType([
    T.StructField("snapshot_run_id", T.StringType()),
    T.StructField("refreshed_at", T.StringType()),
    T.StructField("source_generated_at", T.TimestampType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("feature_set_name", T.StringType()),
    T.StructField("forecast_row_count", T.LongType()),
    T.StructField("forecast_series_count", T.LongType()),
    T.StructField("forecast_horizon_days", T.IntegerType()),
    T.StructField("monitoring_row_count", T.LongType()),
])


def read_with_fallback(
    spark: SparkSession, latest: str, cache: str | None, schema: T.StructType,
    fmt: str = "parquet",
) -> tuple[DataFrame, str]:
    """(frame, "latest" | "cache" | "unavailable"); unavailable is an empty frame."""
    for path, label in ((latest, "latest"), (cache, "cache")):
        if not path:
            continue
        try:
            return spark.read.schema(schema).format(fmt).load(path), label
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema), "unavailable"


def read_snapshot_metadata(
    spark: SparkSession, latest: str, cache: str | None = None,
) -> tuple[DataFrame, str]:
    """One metadata row; when nothing is published, nulls and zero counts."""
    df, label = read_with_fallback(spark, latest, cache, METADATA_SCHEMA, "json")
    if label == "unavailable":
        zero = {f.name for f in METADATA_SCHEMA if f.name.endswith(("_count", "_days"))}
        df = spark.range(1).select(*[
            F.lit(0 if f.name in zero else None).cast(f.dataType).alias(f.name)
            for f in METADATA_SCHEMA])
    return df, label

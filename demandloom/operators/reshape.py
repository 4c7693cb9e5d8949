"""Wide to long, nested to flat, long to wide, and provenance stamping."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions.scalar import to_double

_DAY_COLUMN = re.compile(r"d_\d+")  # fixed pattern of the day columns


def day_columns(columns: Sequence[str], strict: bool = False) -> list[str]:
    """Day columns in file order: prefix ``d_`` on load, full pattern in checks."""
    if strict:
        return [c for c in columns if _DAY_COLUMN.fullmatch(c)]
    return [c for c in columns if c.startswith("d_")]


def wide_sales_to_long(wide: DataFrame, last_days: int | None = None) -> DataFrame:
    """One row per (series row, day); unreadable sales count as 0, decimals are cut.

    All days, unless ``last_days`` asks for the newest ones only.  Dropping day columns before the melt prunes them at the scan.  The melt is
    an explode of one array: with thousands of day columns that runs an order
    of magnitude faster than ``unpivot``, which expands one projection per
    column, and one SQL expression spares a driver call per column.
    """
    days = day_columns(wide.columns)
    if last_days:
        days = days[-last_days:]
    cells = F.expr("array(" + ", ".join(f"`{c}`" for c in days) + ")")
    names = F.from_json(F.lit(json.dumps(days)), "array<string>")
    long = wide.select(*S.SALES_ID_COLUMNS, F.posexplode(cells).alias("_i", "cell"))
    number = F.coalesce(to_double(F.col("cell")), F.lit(0.0))
    return long.select(
        *S.SALES_ID_COLUMNS, F.element_at(names, F.col("_i") + 1).alias("d"),
        number.cast("bigint").alias("sales"))


def flatten_weather(documents: DataFrame) -> DataFrame:
    """Parallel day arrays -> one row per location and date, staging layout.

    Arrays shorter than the time array are padded with null; the quality gate
    rejects such documents before they get here.
    """
    daily = F.arrays_zip(*[F.col(f"daily.{n}").alias(n) for n in ("time", *S.WEATHER_MEASURES)])
    flat = documents.select(
        "location", "ingestion_metadata", F.posexplode(daily).alias("_i", "day"),
        F.size("daily.time").alias("_n"))
    # The time array leads: surplus entries of longer arrays have no date.
    flat = flat.where(F.col("_i") < F.col("_n"))
    picked = {
        "ingest_date": "ingestion_metadata.ingest_date",
        "source_name": "ingestion_metadata.source_name",
        "provider": "ingestion_metadata.provider",
        "schema_version": "ingestion_metadata.schema_version",
        "location_id": "location.location_id",
        "state_id": "location.state_id",
        "location_label": "location.label",
        "location_timezone": "location.timezone",
        "latitude": "location.latitude",
        "longitude": "location.longitude",
        "weather_date": "day.time",
        **{m: f"day.{m}" for m in S.WEATHER_MEASURES},
    }
    return flat.select(*[F.col(path).alias(name) for name, path in picked.items()])


def flatten_macro(documents: DataFrame) -> DataFrame:
    """Observation structs -> one row per series and observation, staging layout."""
    flat = documents.select(
        "series_metadata", "ingestion_metadata", F.explode("observations").alias("o"))
    picked = {
        "ingest_date": "ingestion_metadata.ingest_date",
        "source_name": "ingestion_metadata.source_name",
        "provider": "ingestion_metadata.provider",
        "schema_version": "ingestion_metadata.schema_version",
        "series_id": "series_metadata.series_id",
        "feature_name": "series_metadata.feature_name",
        "series_label": "series_metadata.label",
        "frequency": "series_metadata.frequency",
        "units": "series_metadata.units",
        "observation_date": "o.date",
        "observation_value": "o.value",
    }
    return flat.select(*[F.col(path).alias(name) for name, path in picked.items()])


def features_to_columns(long: DataFrame, features: Sequence[str], value: str,
                        key: str = "date") -> DataFrame:
    """Long (date, feature, value) -> one column per feature.

    The list is fixed, so there is no extra job to discover it, and the pivot
    combines map-side.
    """
    return long.groupBy(key).pivot("feature_name", list(features)).agg(F.max(value))


def stamp(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Attach constant provenance columns."""
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def stamp_from_registry(df: DataFrame, registry: DataFrame, on: str) -> DataFrame:
    """Attach registry metadata; Spark broadcasts the registry if it is small."""
    extra = [c for c in registry.columns if c == on or c not in df.columns]
    return df.join(registry.select(*extra), on, "left")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by an explicit order.

    ``max_by`` combines map-side, so a hot key is one row per task before the
    shuffle.  Over a struct it is a sort-based aggregation: each map task sorts
    its rows by key first.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)

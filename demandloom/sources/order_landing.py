"""Land the retail entities of the order tables as files, the way providers deliver them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.plans.refresh import Landed
from demandloom.session import scratch_path
from demandloom.sources.order_tables import INGEST_DATE, OrderTables

_LANDED: dict[tuple[str, str], Landed] = {}


def _headed(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def land(t: OrderTables) -> Landed:
    """Write every landed file of one day; once per session and folder of tables.

    A provider's document is one object per file: there is one per location and
    per series, both fixed lists.
    """
    key = (t.spark.sparkContext.applicationId, t.root)
    if key in _LANDED:
        return _LANDED[key]
    locations = tuple(r[0] for r in t.weather_raw.select("location_id").distinct().collect())  # regions
    files = Landed(scratch_path(t.spark, "landing"), INGEST_DATE, locations=locations)
    _headed(t.calendar_raw, files.retail("calendar.csv"))
    _headed(t.prices_raw.select(*S.PRICES_RAW.names), files.retail("sell_prices.csv"))
    _headed(t.wide_sales, files.retail("sales_train_validation.csv"))
    keep_nulls = {"ignoreNullFields": "false"}
    measures = [F.col(f"daily.{m}").cast("array<double>").alias(m) for m in S.WEATHER_MEASURES]
    weather = t.weather_documents.withColumns({
        "daily": F.struct("daily.time", *measures), "latitude": F.lit(None).cast("double"),
        "longitude": F.lit(None).cast("double"), "timezone": F.lit("UTC")})
    for location, path in zip(files.locations, files.weather()):
        weather.where(F.col("location.location_id") == location).coalesce(1).write.options(**keep_nulls).json(path)
    for series, path in zip(files.series, files.macro()):
        t.macro_documents.where(F.col("series_metadata.series_id") == series).coalesce(1).write.options(
            **keep_nulls).json(path)
    for keyword in files.keywords:
        _headed(t.keyword_file(keyword), files.keyword(keyword))
    _LANDED[key] = files
    return files


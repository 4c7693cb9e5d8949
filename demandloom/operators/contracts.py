"""Contract tests on Silver and Gold tables: failing rows, empty when kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom import schemas as S


def duplicate_keys(df: DataFrame, keys, count_name: str = "row_count") -> DataFrame:
    """Keys that occur more than once; counts combine map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def grain_unique(training: DataFrame) -> DataFrame:
    return duplicate_keys(training, S.GRAIN)


def price_key_unique(prices: DataFrame) -> DataFrame:
    return duplicate_keys(prices, ("store_id", "item_id", "wm_yr_wk"), "n")


def sales_non_negative(training: DataFrame) -> DataFrame:
    return training.where(F.col("sales") < 0)


def price_coverage(priced: DataFrame, max_null_share: float = 0.20) -> DataFrame:
    """A row if too many fact rows lack a price, nothing otherwise."""
    stats = priced.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("sell_price").isNull()).alias("null_prices"))
    share = F.when(F.col("total_rows") > 0, F.col("null_prices") / F.col("total_rows"))
    return stats.withColumn("null_share", share).where(F.col("null_share") > max_null_share)


_FACT = ("id", "item_id", "store_id")
# Columns that must not be null, per table.
NOT_NULL = {
    "silver_calendar": (
        "d", "date", "wm_yr_wk", "weekday", "year", "month", "day", "day_of_week"),
    "silver_sell_prices": ("store_id", "item_id", "wm_yr_wk", "sell_price"),
    "silver_sales": (*S.SALES_ID_COLUMNS, "d", "date", "sales"),
    "silver_sales_with_prices": (*_FACT, "d", "date", "wm_yr_wk", "sales"),
    "silver_weather_daily": ("location_id", "state_id", "weather_date"),
    "silver_sales_with_weather": (*_FACT, "state_id", "d", "date", "sales"),
    "silver_macro_series": ("series_id", "feature_name", "observation_date"),
    "silver_macro_daily_aligned": ("date", "feature_name"),
    "silver_trends_interest": ("feature_name", "trend_date"),
    "silver_trends_daily_aligned": ("date", "feature_name"),
    "silver_sales_with_external_features": (*_FACT, "state_id", "d", "date", "sales"),
    "gold_training_daily": ("store_id", "item_id", "date", "wm_yr_wk", "sales"),
    "gold_training_daily_with_weather": ("store_id", "item_id", "date", "sales"),
    "gold_feature_mart": ("id", "item_id", "store_id", "date", "sales"),
    "forecast_run_monitoring": (
        "generated_at", "model_name", "model_version", "feature_set_name",
        "min_forecast_date", "max_forecast_date", "forecast_row_count", "forecast_series_count"),
    "latest_forecast_freshness": (
        "generated_at", "model_name", "model_version", "feature_set_name",
        "min_forecast_date", "max_forecast_date", "forecast_row_count", "forecast_series_count",
        "forecast_horizon_days"),
}
UNIQUE = {"silver_calendar": ("d",)}


def column_contract(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, test_name, failures) of a table's column rules.

    All not-null rules of a table are one aggregate pass.
    """
    not_null = NOT_NULL.get(table, ())
    unique = UNIQUE.get(table, ())
    if not not_null and not unique:
        raise ValueError(f"no contract for table {table!r}")
    parts = []
    if not_null:
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        parts.append(wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test_name"),
                     F.col(c).alias("failures")) for c in not_null]))))
    for c in unique:
        repeated = duplicate_keys(df.where(F.col(c).isNotNull()), [c])
        parts.append(repeated.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c).alias("column_name"), F.lit("unique").alias("test_name"), "failures"))
    both = reduce(DataFrame.unionByName, parts)
    return both.select(F.lit(table).alias("table_name"), "column_name", "test_name", "failures")

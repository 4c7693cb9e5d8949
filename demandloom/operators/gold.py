"""Daily feature mart and its training projections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from demandloom import schemas as S
from demandloom.operators import silver


def feature_mart(
    sales_fact: DataFrame, calendar_dim: DataFrame, prices: DataFrame, weather: DataFrame,
    macro_aligned: DataFrame, trends_aligned: DataFrame,
) -> DataFrame:
    """One row per (store, item, date) with price and external features.

    Prices and external features hang off the same fact, so they are attached
    in one pass; joining two enriched copies of the fact on the grain would
    give the same rows (the grain is unique, see ``contracts.grain_unique``)
    at the cost of shuffling the fact twice.
    """
    priced = silver.with_prices(sales_fact, calendar_dim, prices)
    return (
        priced.join(silver.weather_lookup(weather), ["state_id", "date"], "left")
        .join(silver.macro_by_day(macro_aligned), "date", "left")
        .join(silver.trends_by_day(trends_aligned), "date", "left")
        .select(*S.MART_COLUMNS))


def feature_mart_from_parts(external: DataFrame, priced: DataFrame) -> DataFrame:
    """The mart from two separately stored Silver tables (fact-to-fact join)."""
    return external.join(
        priced.select(*S.GRAIN, "wm_yr_wk", "sell_price"), list(S.GRAIN), "left",
    ).select(*S.MART_COLUMNS)


def training_daily(priced: DataFrame) -> DataFrame:
    return priced.select(
        *S.GRAIN, "state_id", "cat_id", "dept_id", "wm_yr_wk", "sales", "sell_price")


def training_daily_with_weather(with_weather: DataFrame) -> DataFrame:
    return with_weather.select(
        *S.GRAIN, "state_id", "cat_id", "dept_id", "sales", *S.WEATHER_MEASURES)

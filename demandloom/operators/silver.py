"""Typed, filtered dimension and fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions.scalar import iso_weekday
from demandloom.operators.asof import latest_on_each_day
from demandloom.operators.reshape import features_to_columns


def calendar(raw: DataFrame) -> DataFrame:
    """Calendar dimension; day_of_week is 1 = Monday .. 7 = Sunday."""
    day = F.col("date").cast("date")
    return raw.select(
        "d", day.alias("date"), F.col("wm_yr_wk").cast("int").alias("wm_yr_wk"), "weekday",
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        iso_weekday(day).alias("day_of_week"),
    ).dropna(subset=["d", "date", "wm_yr_wk", "weekday"])


def sell_prices(raw: DataFrame) -> DataFrame:
    """Weekly price per (store, item); only positive prices with a full key."""
    return raw.select(
        "store_id", "item_id", F.col("wm_yr_wk").cast("int").alias("wm_yr_wk"),
        F.col("sell_price").cast(S.MONEY).alias("sell_price"),
    ).dropna().where(F.col("sell_price") > 0)


def sales(long_raw: DataFrame, calendar_dim: DataFrame) -> DataFrame:
    """Daily sales fact with its real date.

    Days that the calendar lacks and negative or missing sales drop out, so an
    inner join says it all.
    """
    units = F.col("sales").cast("int")
    fact = long_raw.withColumn("sales", units).where(F.col("sales") >= 0)
    return fact.join(calendar_dim.select("d", "date"), "d", "inner").select(
        *S.SALES_ID_COLUMNS, "d", "date", "sales")


def weather_daily(raw: DataFrame) -> DataFrame:
    numbers = ("latitude", "longitude", *S.WEATHER_MEASURES)
    casts = {"ingest_date": "date", "weather_date": "date", **{n: "double" for n in numbers}}
    return _typed(raw, S.WEATHER_RAW.names, casts).dropna(
        subset=["location_id", "state_id", "weather_date"])


def macro_series(raw: DataFrame) -> DataFrame:
    """Macro observations; ``.`` marks a missing value, any other bad text fails."""
    known = raw.withColumn("observation_value", F.nullif("observation_value", F.lit(".")))
    casts = {"ingest_date": "date", "observation_date": "date", "observation_value": S.MONEY}
    return _typed(known, S.MACRO_RAW.names, casts).dropna(
        subset=["series_id", "feature_name", "observation_date"])


def trends_interest(raw: DataFrame) -> DataFrame:
    casts = {"ingest_date": "date", "trend_date": "date", "interest_value": "int"}
    return _typed(raw, S.TRENDS_RAW.names, casts).dropna(subset=["feature_name", "trend_date"])


def _typed(raw: DataFrame, names, casts) -> DataFrame:
    return raw.select(*[
        F.col(n).cast(casts[n]).alias(n) if n in casts else F.col(n) for n in names])


def sales_dates(sales_fact: DataFrame) -> DataFrame:
    """The days that have sales, the spine of the daily alignments."""
    return sales_fact.select("date").distinct()


def sales_date_range(long_raw: DataFrame, calendar_dim: DataFrame) -> DataFrame:
    """First and last dated sales day in one row; no dated sales is an error.

    Day codes are made distinct before the join, so it sees one row per day.
    """
    days = long_raw.select("d").distinct().join(calendar_dim.select("d", "date"), "d")
    stop = F.raise_error(F.lit("no sales day has a calendar date")).cast("date")
    return days.agg(
        F.coalesce(F.min("date"), stop).alias("min_date"),
        F.coalesce(F.max("date"), stop).alias("max_date"))


def macro_daily_aligned(sales_fact: DataFrame, macro: DataFrame) -> DataFrame:
    """Latest known macro value on every sales day and feature."""
    return macro_on_days(sales_dates(sales_fact), macro)


def macro_on_days(days: DataFrame, macro: DataFrame) -> DataFrame:
    """Latest known macro value on each of the given days."""
    return latest_on_each_day(
        days, macro, feature="feature_name", observed="observation_date",
        value="observation_value", tiebreak="ingest_date")


def trends_daily_aligned(sales_fact: DataFrame, trends: DataFrame) -> DataFrame:
    """Search interest restricted to days with sales."""
    return trends.select(
        F.col("trend_date").alias("date"), "feature_name",
        F.col("trend_date").alias("source_trend_date"), "interest_value",
    ).join(sales_dates(sales_fact), "date", "inner").select(
        "date", "feature_name", "source_trend_date", "interest_value")


def weather_lookup(weather: DataFrame) -> DataFrame:
    return weather.select("state_id", F.col("weather_date").alias("date"), *S.WEATHER_MEASURES)


def macro_by_day(aligned: DataFrame) -> DataFrame:
    return features_to_columns(aligned, S.MACRO_FEATURES, "observation_value")


def trends_by_day(aligned: DataFrame) -> DataFrame:
    return features_to_columns(aligned, S.TRENDS_FEATURES, "interest_value")


def with_prices(sales_fact: DataFrame, calendar_dim: DataFrame, prices: DataFrame) -> DataFrame:
    """Attach the retail week of the day and the price of that week."""
    weeks = sales_fact.join(calendar_dim.select("d", "wm_yr_wk"), "d", "left")
    return weeks.join(prices, ["store_id", "item_id", "wm_yr_wk"], "left").select(
        *S.SALES_ID_COLUMNS, "d", "date", "wm_yr_wk", "sales", "sell_price")


def with_weather(sales_fact: DataFrame, weather: DataFrame) -> DataFrame:
    return sales_fact.join(weather_lookup(weather), ["state_id", "date"], "left").select(
        *S.SALES_ID_COLUMNS, "d", "date", "sales", *S.WEATHER_MEASURES)


def with_external_features(
    sales_fact: DataFrame, weather: DataFrame, macro_aligned: DataFrame, trends_aligned: DataFrame,
) -> DataFrame:
    """Star join of the fact with weather, macro and search interest.

    The three right sides have at most one row per (state,) day.  They carry no
    hint: Spark broadcasts them while they stay under its size threshold and
    shuffles them beyond it.
    """
    return (
        sales_fact.join(weather_lookup(weather), ["state_id", "date"], "left")
        .join(macro_by_day(macro_aligned), "date", "left")
        .join(trends_by_day(trends_aligned), "date", "left")
        .select(*S.SALES_ID_COLUMNS, "d", "date", "sales", *S.EXTERNAL_FEATURES))

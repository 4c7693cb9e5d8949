"""Dashboard aggregates over forecast rows, and profiles of the feature mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions.scalar import window_label

# -- forecast pages -----------------------------------------------------------


def filter_forecasts(forecasts: DataFrame, first_day=None, last_day=None,
                     stores: Sequence[str] = (), items: Sequence[str] = ()) -> DataFrame:
    """Closed date interval and value lists; an empty list filters nothing."""
    out = forecasts
    if first_day is not None and last_day is not None:
        out = out.where(F.col("forecast_date").between(
            F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    if stores:
        out = out.where(F.col("store_id").isin(list(stores)))
    if items:
        out = out.where(F.col("item_id").isin(list(items)))
    return out


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values of a column as text."""
    value = F.col(column).cast("string").alias("value")
    return df.select(value).dropna().distinct().orderBy("value")


def kpi_summary(forecasts: DataFrame) -> DataFrame:
    """Headline numbers; all zero for an empty selection."""
    total = F.coalesce(F.sum("prediction"), F.lit(0.0))
    days = F.count_distinct("forecast_date")
    forecasts = forecasts.groupBy("store_id", "item_id", "forecast_date").agg(
        F.sum("prediction").alias("prediction"))
    return forecasts.agg(
        total.alias("total_forecast"),
        F.when(days > 0, total / days).otherwise(0.0).alias("average_daily_forecast"),
        F.count_distinct("store_id").alias("store_count"),
        F.count_distinct("item_id").alias("product_count"))


def totals_by_date(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("forecast_date").agg(
        F.sum("prediction").alias("forecast_demand")).orderBy("forecast_date")


def totals_by(forecasts: DataFrame, key: str) -> DataFrame:
    """Total per store or item, rounded, largest first."""
    total = F.sum("prediction")
    return (
        forecasts.groupBy(key).agg(total.alias("_t"))
        .select(key, F.round("_t", 2).alias("forecast_demand"), "_t")
        .orderBy(F.desc("_t"), key).drop("_t"))


def top_by(forecasts: DataFrame, key: str, n: int) -> DataFrame:
    """The n largest stores or items by forecast total."""
    return (
        forecasts.groupBy(key).agg(F.sum("prediction").alias("forecast_demand"))
        .orderBy(F.desc("forecast_demand"), key).limit(n))


def daily_trend(forecasts: DataFrame) -> DataFrame:
    """Daily totals and the change from the previous day, both rounded.

    The ordered window sees one row per forecast day, after aggregation.
    """
    daily = forecasts.groupBy("forecast_date").agg(
        F.round(F.sum("prediction"), 2).alias("forecast_demand"))
    previous = F.lag("forecast_demand").over(Window.orderBy("forecast_date"))
    return daily.withColumn(
        "day_over_day_change", F.round(F.col("forecast_demand") - previous, 2))


def trend_direction(forecasts: DataFrame) -> DataFrame:
    """Compare the totals of the first and last day; null for fewer than two days."""
    daily = forecasts.groupBy("forecast_date").agg(F.sum("prediction").alias("t"))
    ends = daily.agg(
        F.min_by("t", "forecast_date").alias("first_total"),
        F.max_by("t", "forecast_date").alias("last_total"), F.count(F.lit(1)).alias("days"))
    direction = (
        F.when(F.col("days") < 2, None)
        .when(F.col("last_total") > F.col("first_total"), "rises")
        .when(F.col("last_total") < F.col("first_total"), "softens").otherwise("stable"))
    return ends.select("days", "first_total", "last_total", direction.alias("direction"))


def forecast_detail(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(
        "forecast_date", "store_id", "item_id", F.round("prediction", 2).alias("forecast_demand"))


def forecast_window(forecasts: DataFrame) -> DataFrame:
    first, last = F.min("forecast_date"), F.max("forecast_date")
    return forecasts.agg(
        first.alias("first_day"), last.alias("last_day"), window_label(first, last).alias("label"))


# -- profiles of the feature mart ---------------------------------------------


def mart_profile(mart: DataFrame, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """Row count, distinct keys and date range.

    ``exact=False`` swaps the distinct counts for sketches: one map-side pass
    with no exchange of keys.
    """
    def distinct(*cols: str):
        if exact:
            return F.count_distinct(*cols)
        key = F.struct(*cols) if len(cols) > 1 else F.col(cols[0])
        return F.approx_count_distinct(F.xxhash64(key), rsd)

    keys = (*S.SERIES_KEYS, "dept_id", "cat_id", "state_id")
    if exact:
        # One row per series first, combined map-side: the distinct counts then
        # multiply rows of that small table, not of the fact.
        mart = mart.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"))
        rows, lo, hi = F.coalesce(F.sum("n"), F.lit(0)), F.min("lo"), F.max("hi")
    else:
        rows, lo, hi = F.count(F.lit(1)), F.min("date"), F.max("date")
    return mart.agg(
        rows.alias("row_count"), distinct(*S.SERIES_KEYS).alias("series_count"),
        distinct("item_id").alias("item_count"), distinct("dept_id").alias("dept_count"),
        distinct("cat_id").alias("cat_count"), distinct("store_id").alias("store_count"),
        distinct("state_id").alias("state_count"), lo.alias("min_date"), hi.alias("max_date"))


def target_profile(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("sales").alias("non_null_sales_rows"),
        F.min("sales").alias("min_sales"), F.max("sales").alias("max_sales"),
        F.avg("sales").alias("avg_sales"),
        F.count_if(F.col("sales") < 0).alias("negative_sales_rows"),
        F.count_if(F.col("sales") == 0).alias("zero_sales_rows"))


def null_profile(mart: DataFrame, columns: Sequence[str] = ("sell_price", *S.EXTERNAL_FEATURES),
                 ) -> DataFrame:
    return mart.agg(F.count(F.lit(1)).alias("total_rows"), *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def target_distribution(mart: DataFrame) -> DataFrame:
    """Mean, deviation and exact interpolated percentiles of sales.

    Rows are first counted per distinct value, map-side combined; everything
    else works on the small set of distinct sales figures.
    """
    x, n = F.col("x"), F.col("n")
    counted = mart.where(F.col("sales").isNotNull()).groupBy(
        F.col("sales").cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    total, first, second = F.sum(n), F.sum(x * n), F.sum(x * x * n)
    spread = counted.agg(
        (first / total).alias("avg_sales"),
        F.when(total > 1, F.sqrt((second - first * first / total) / (total - 1))).alias("std_sales"),
        F.percentile("x", [0.5, 0.9, 0.99], n).alias("p"))
    names = ("median_sales", "p90_sales", "p99_sales")
    return spread.select(
        "avg_sales", "std_sales", *[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(names)])


def daily_totals(mart: DataFrame) -> DataFrame:
    return mart.groupBy("date").agg(F.sum("sales").alias("total_daily_sales")).orderBy("date")


def store_sparsity(mart: DataFrame) -> DataFrame:
    zero = F.count_if(F.col("sales") == 0)
    rows = F.count(F.lit(1))
    return mart.groupBy("store_id").agg(
        rows.alias("row_count"), F.avg("sales").alias("avg_sales"),
        zero.alias("zero_sales_rows"), (zero * 100.0 / rows).alias("zero_sales_pct"),
    ).orderBy("store_id")


def series_per_store(mart: DataFrame) -> DataFrame:
    return mart.groupBy("store_id").agg(
        F.count_distinct("item_id").alias("item_count"), F.count(F.lit(1)).alias("row_count"),
    ).orderBy("store_id")


def grain_check(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(*S.GRAIN).alias("distinct_store_item_date_rows"))


def target_correlation(mart: DataFrame, columns: Sequence[str] = (
        "sell_price", *S.WEATHER_MEASURES, *S.TRENDS_FEATURES)) -> DataFrame:
    """Pairwise-complete correlation of sales with numeric columns, one pass."""
    wide = mart.agg(*[
        F.corr(F.col("sales").cast("double"), F.col(c).cast("double")).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation"))
                      for c in columns])
    return wide.select(F.inline(pairs)).orderBy(F.desc_nulls_last("correlation"), "feature")


def sample_rows(df: DataFrame, one_in: int = 100, keys: Sequence[str] = S.SERIES_KEYS) -> DataFrame:
    """About one row in ``one_in``: whole series, chosen by a hash of their keys, so
    every run shows the same rows."""
    return df.where(F.pmod(F.crc32(F.concat_ws("|", *keys).cast("binary")), F.lit(one_in)) == 0)

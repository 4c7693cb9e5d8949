"""Leakage-safe calendar, lag, rolling and price features.

Lags and rolling means count rows of a series, not days.  A series holds at
most one row per calendar day (``contracts.grain_unique``), which bounds every
window below by the length of the calendar, however hot the store or item is:
raw rows are summed to that grain, with map-side combining, before they get here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions.scalar import to_double

LAGS = (1, 7, 28)
ROLLS = (7, 28)
NUMERIC_INPUTS = ("sell_price", *S.EXTERNAL_FEATURES)
REQUIRED = (*S.GRAIN, "sales", "sell_price")


def series_window(date_col: str = "date"):
    return Window.partitionBy(*S.SERIES_KEYS).orderBy(date_col)


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Optional numeric inputs become doubles; text that is no number is null."""
    present = [c for c in NUMERIC_INPUTS if c in df.columns]
    return df.withColumns({c: to_double(F.col(c)) for c in present})


def calendar_features(day: Column) -> dict[str, Column]:
    """day_of_week is 0 = Monday here; week_of_year is the ISO week."""
    return {
        "day_of_week": F.weekday(day),
        "day_of_month": F.dayofmonth(day),
        "week_of_year": F.weekofyear(day),
        "month": F.month(day),
    }


def price_features(w) -> dict[str, Column]:
    """Missing flag, and the price filled forward, then backward, then with 0.

    Only rows before the first known price are still empty after the forward
    fill, and for those the next known price is the first one of the series:
    a whole-partition ``first``, which costs one pass where a frame that runs
    to the end of the series would rescan it for every row.
    """
    price = F.col("sell_price")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        "sell_price_missing_flag": price.isNull().cast("int"),
        "sell_price_filled": F.coalesce(
            F.last(price, ignorenulls=True).over(so_far),
            F.first(price, ignorenulls=True).over(whole), F.lit(0.0)),
    }


def lag_features(w) -> dict[str, Column]:
    units = F.col("sales").cast("double")
    return {f"lag_{n}": F.lag(units, n).over(w) for n in LAGS}


def rolling_features(w) -> dict[str, Column]:
    """Mean of the n rows before the current one; null unless all n are known."""
    units = F.col("sales").cast("double")
    out = {}
    for n in ROLLS:
        before = w.rowsBetween(-n, -1)
        full = F.count(units).over(before) == n
        out[f"rolling_mean_{n}"] = F.when(full, F.avg(units).over(before))
    return out


def build_features(df: DataFrame) -> DataFrame:
    """All input columns plus every engineered feature.

    Every window shares one partitioning and order, so there is one exchange
    and one sort, and none if the input is already distributed by series.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"build_features needs columns {missing}")
    typed = coerce_numeric(df).withColumn("date", F.col("date").cast("date"))
    w = series_window()
    return typed.withColumns({
        **price_features(w), **calendar_features(F.col("date")), **lag_features(w),
        **rolling_features(w)})


def complete_cases(features: DataFrame, feature_set: str = S.DEFAULT_FEATURE_SET) -> DataFrame:
    """Rows whose features of the named set are all known (null and NaN drop)."""
    return features.dropna(subset=S.feature_columns(feature_set))


def is_complete(features: DataFrame, feature_set: str) -> Column:
    """The same rule as a predicate, for several sets in one pass."""
    kinds = dict(features.dtypes)
    out = F.lit(True)
    for c in S.feature_columns(feature_set):
        known = F.col(c).isNotNull()
        if kinds[c] in ("double", "float"):
            known = known & ~F.isnan(c)
        out = out & known
    return out


def last_rows(df: DataFrame, n: int = 60) -> DataFrame:
    """The last n rows of each series by date."""
    latest_first = Window.partitionBy(*S.SERIES_KEYS).orderBy(F.desc("date"))
    return (
        df.withColumn("_rn", F.row_number().over(latest_first))
        .where(F.col("_rn") <= n).drop("_rn"))


def latest_row(df: DataFrame) -> DataFrame:
    """The last row of each series; combines map-side."""
    rest = [c for c in df.columns if c not in S.SERIES_KEYS]
    return (
        df.groupBy(*S.SERIES_KEYS).agg(F.max_by(F.struct(*rest), "date").alias("_r"))
        .select(*S.SERIES_KEYS, "_r.*").select(*df.columns))

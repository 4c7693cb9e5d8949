"""Bounded training extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom import schemas as S

DEFAULT_HISTORY_DAYS = 365
DEFAULT_SERIES = 500


def recent(df: DataFrame, days: int | None, date_col: str = "date") -> DataFrame:
    """The last ``days`` days up to the newest date in the data (not today)."""
    if days is None:
        return df
    newest = df.agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) > F.date_sub(newest, days))


def series_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(*S.SERIES_KEYS).agg(F.sum("sales").alias("total_sales"))


def top_series(df: DataFrame, n: int) -> DataFrame:
    """The n best-selling series; ties go to the smaller (store, item)."""
    return series_totals(df).orderBy(F.desc("total_sales"), *S.SERIES_KEYS).limit(n)


def top_series_subset(df: DataFrame, n: int = 20) -> DataFrame:
    """All rows of the n best-selling series; the keys are broadcast if Spark finds them small."""
    chosen = top_series(df, n).select(*S.SERIES_KEYS)
    return df.join(chosen, list(S.SERIES_KEYS), "left_semi")


def training_extract(
    mart: DataFrame, limit_series: int | None = DEFAULT_SERIES,
    history_days: int | None = DEFAULT_HISTORY_DAYS,
) -> DataFrame:
    """Bound the history first, then rank series inside it.

    ``history_days=None`` ranks over the full history; ``limit_series=None``
    keeps every series.
    """
    base = recent(mart.select(*S.MART_COLUMNS), history_days)
    return base if limit_series is None else top_series_subset(base, limit_series)

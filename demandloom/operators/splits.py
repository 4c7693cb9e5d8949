"""Rolling time-series splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BacktestConfig:
    horizon_days: int = 28
    n_windows: int = 5
    date_column: str = "date"
    target_column: str = "sales"


def window_number(day: Column, newest: Column, config: BacktestConfig) -> Column:
    """1-based test window of a day, 1 = newest; n_windows + 1 = older than all.

    Test windows touch each other, so the training rows of window w are
    exactly the rows whose number is above w.
    """
    age = F.floor(F.datediff(newest, day) / F.lit(config.horizon_days)) + F.lit(1)
    return F.least(age, F.lit(config.n_windows + 1)).cast("int")


def with_window(df: DataFrame, config: BacktestConfig = BacktestConfig()) -> DataFrame:
    newest = df.agg(F.max(config.date_column)).scalar()
    return df.withColumn("window", window_number(F.col(config.date_column), newest, config))


def split_bounds(df: DataFrame, config: BacktestConfig = BacktestConfig()) -> DataFrame:
    """window, test_start, test_end for every window; a table of n_windows rows."""
    h = config.horizon_days
    newest = df.agg(F.max(config.date_column).cast("date").alias("_newest"))
    numbered = newest.select("_newest", F.explode(
        F.sequence(F.lit(1), F.lit(config.n_windows))).alias("window"))
    test_end = F.date_sub("_newest", (F.col("window") - 1) * h)
    return numbered.select(
        "window", F.date_sub(test_end, h - 1).alias("test_start"), test_end.alias("test_end"))


def train_test(df: DataFrame, window: int, config: BacktestConfig = BacktestConfig(),
               ) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one window."""
    if not 1 <= window <= config.n_windows:
        raise ValueError(f"window must be within 1..{config.n_windows}")
    if "window" not in df.columns:
        # Bounds on the day itself reach the scan and prune files or partitions.
        day, h = F.col(config.date_column), config.horizon_days
        newest = df.agg(F.max(config.date_column).cast("date")).scalar()
        start, end = F.date_sub(newest, window * h - 1), F.date_sub(newest, (window - 1) * h)
        return df.where(day < start), df.where(day.between(start, end))
    numbered = df
    return (numbered.where(F.col("window") > window).drop("window"),
            numbered.where(F.col("window") == window).drop("window"))


def hold_out(df: DataFrame, horizon_days: int = 28) -> tuple[DataFrame, DataFrame]:
    """A single split: the last ``horizon_days`` days are the test rows."""
    return train_test(df, 1, BacktestConfig(horizon_days=horizon_days, n_windows=1))


def splits_summary(df: DataFrame, config: BacktestConfig = BacktestConfig()) -> DataFrame:
    """Bounds and row counts per window, from one pass over the data."""
    day = F.col(config.date_column).cast("date")
    partial = (
        with_window(df.select(config.date_column), config).groupBy("window")
        .agg(F.min(day).alias("lo"), F.max(day).alias("hi"), F.count(F.lit(1)).alias("n")))
    return summarise_windows(partial, config)


def summarise_windows(partial: DataFrame, config: BacktestConfig, scores=()) -> DataFrame:
    """Fold per-window-number rows (lo, hi, n, scores) into train / test statistics.

    ``partial`` has at most n_windows + 1 rows.  They are gathered into one
    array, so the pass that made them is not repeated for train and test.
    """
    gathered = partial.agg(F.collect_list(F.struct(*partial.columns)).alias("p"))
    per_window = gathered.select(
        "p", F.explode(F.sequence(F.lit(1), F.lit(config.n_windows))).alias("window"))
    older = F.filter("p", lambda x: x["window"] > F.col("window"))
    own = F.filter("p", lambda x: x["window"] == F.col("window"))
    folded = per_window.select(
        "window", older.alias("older"), F.get(own, F.lit(0)).alias("own"))
    train_rows = F.aggregate("older", F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    return folded.select(
        "window",
        F.array_min(F.transform("older", lambda x: x["lo"])).alias("train_start_date"),
        F.array_max(F.transform("older", lambda x: x["hi"])).alias("train_end_date"),
        F.col("own.lo").alias("test_start_date"), F.col("own.hi").alias("test_end_date"),
        train_rows.alias("train_rows"), F.coalesce("own.n", F.lit(0)).alias("test_rows"),
        *[F.col(f"own.{c}").alias(c) for c in scores])

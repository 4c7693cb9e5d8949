"""Rolling backtests: one-step-ahead, on features built from actual sales."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions import metrics as M
from demandloom.operators.baselines import BASELINES, ExpressionForecaster
from demandloom.operators.features import is_complete
from demandloom.operators.splits import (
    BacktestConfig, splits_summary, summarise_windows, train_test, window_number, with_window,
)
from demandloom.session import scratch_path
from demandloom.sinks.tables import refresh_path

RESULT_COLUMNS = (
    "window", "train_start_date", "train_end_date", "test_start_date", "test_end_date",
    "train_rows", "test_rows", "wmape", "mae", "rmse",
)


def _required(rows: str, what: str) -> Column:
    text = F.concat(F.lit(f"backtest window has an empty {what} set: window "), F.col("window"))
    return F.when(F.col(rows) > 0, F.col(rows)).otherwise(F.raise_error(text).cast("bigint"))


def _guarded(summary: DataFrame) -> DataFrame:
    """Empty train or test windows stop the backtest when it is evaluated."""
    return summary.withColumns({
        "train_rows": _required("train_rows", "training"),
        "test_rows": _required("test_rows", "test")})


def backtest_expression(
    modeling: DataFrame, forecaster: ExpressionForecaster,
    config: BacktestConfig = BacktestConfig(),
) -> DataFrame:
    """Metrics of a closed-form forecaster, all windows in one pass.

    There is nothing to fit, so each row is scored once and reduced map-side
    to one partial result per window number.
    """
    actual = F.col(config.target_column).cast("double")
    day = F.col(config.date_column).cast("date")
    feature_map = {c: F.col(c) for c in modeling.columns}
    scored = with_window(modeling, config).withColumn("_p", forecaster(feature_map).cast("double"))
    partial = scored.groupBy("window").agg(
        F.min(day).alias("lo"), F.max(day).alias("hi"), F.count(F.lit(1)).alias("n"),
        M.wmape(actual, F.col("_p"), on_zero="null").alias("wmape"),
        M.mae(actual, F.col("_p")).alias("mae"), M.rmse(actual, F.col("_p")).alias("rmse"))
    undefined = F.raise_error(F.lit("WMAPE is undefined: actuals sum to zero")).cast("double")
    return _guarded(summarise_windows(partial, config, ("wmape", "mae", "rmse"))).withColumn(
        "wmape", F.coalesce("wmape", undefined)).select(*RESULT_COLUMNS)


def assembled(estimator: Estimator, features: Sequence[str]) -> Pipeline:
    """Feature vector plus estimator; unknown features become NaN, not errors."""
    vector = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[vector, estimator])


def score_window(
    modeling: DataFrame, features: Sequence[str], factory: Callable[[], Estimator], window: int,
    config: BacktestConfig = BacktestConfig(),
) -> DataFrame:
    """Fit a fresh model on one window's training rows; its scored test rows."""
    train, test = train_test(modeling, window, config)
    label = F.col(config.target_column).cast("double").alias(config.target_column)
    keep = [c for c in (*S.SERIES_KEYS, config.date_column) if c in modeling.columns]
    extra = [c for c in features if c not in keep]
    model = assembled(factory(), features).fit(train.select(*extra, label))
    return model.transform(test.select(*keep, *extra, label)).select(
        *keep, config.target_column, "prediction")


def backtest_model(
    modeling: DataFrame, features: Sequence[str], factory: Callable[[], Estimator],
    config: BacktestConfig = BacktestConfig(), parallelism: int = 1, history: DataFrame | None = None,
) -> DataFrame:
    """One row per window for an estimator: a distributed fit per window.

    Give it a stored or cached frame; every fit reads it again.  With ``history`` (grain and sales), the scored
    rows of all windows are stored, and the primary metric is one more column, ``wrmsse``.
    """
    spark = modeling.sparkSession
    stored = scratch_path(spark, "scored") if history is not None else None
    numbered = with_window(modeling, config)
    # n_windows rows: bounds and counts of every window, from one pass
    windows = {r["window"]: r for r in splits_summary(modeling, config).collect()}
    for w, r in sorted(windows.items()):
        for part in ("test", "train"):
            if not r[f"{part}_rows"]:
                raise ValueError(f"backtest window {w} has an empty {part}ing set")

    def one(window: int) -> tuple:
        scored = score_window(numbered, features, factory, window, config)
        if stored:
            scored = refresh_path(scored, f"{stored}/window-{window}")
        actual, predicted = F.col(config.target_column), F.col("prediction")
        scores = scored.agg(
            M.wmape(actual, predicted).alias("wmape"), M.mae(actual, predicted).alias("mae"),
            M.rmse(actual, predicted).alias("rmse")).first()
        row = {**windows[window].asDict(), **scores.asDict()}
        return tuple(row[c] for c in RESULT_COLUMNS)

    with ThreadPool(min(parallelism, config.n_windows)) as pool:
        rows = pool.map(one, range(1, config.n_windows + 1))
    result = spark.createDataFrame(
        rows, "window int, train_start_date date, train_end_date date, test_start_date date, "
              "test_end_date date, train_rows bigint, test_rows bigint, "
              "wmape double, mae double, rmse double")
    if not stored:
        return result
    scored = spark.read.parquet(*[f"{stored}/window-{w}" for w in windows]).withColumn("model_name", F.lit("model"))
    newest = max(r["test_end_date"] for r in windows.values())
    primary = window_wrmsse(scored, history, F.lit(newest), config).select(F.col("window").alias("of"), "wrmsse")
    return result.join(primary, F.col("window") == F.col("of"), "left").drop("of")


def window_rmsse(
    scored: DataFrame, history: DataFrame, newest: Column, config: BacktestConfig = BacktestConfig(),
) -> DataFrame:
    """(model_name, window, series keys, rmsse, weight) of every series scored in a window.

    ``scored`` has model_name, the series keys, day, actual and prediction of any
    rows; those of the test windows count.  Scale and weight come from ``history``
    before each window: its mean squared first difference, and the sales of the
    last horizon before the window.  One pass sums the history by series and
    window number; a series has at most n_windows + 2 of these sums, and a window
    folds the older ones.  A series with fewer than two rows or no scale has a null rmsse.
    """
    n, h, keys = config.n_windows, config.horizon_days, list(S.SERIES_KEYS)
    day, target = F.col(config.date_column), F.col(config.target_column).cast("double")

    def number(top: int) -> Column:
        return F.least(F.floor(F.datediff(newest, day) / h) + 1, F.lit(top)).cast("int")

    step = target - F.lag(target).over(Window.partitionBy(*keys).orderBy(day))
    parts = history.select(*keys, number(n + 2).alias("part"), target.alias("y"), (step * step).alias("sq")).groupBy(
        *keys, "part").agg(F.sum("sq").alias("sq"), F.count("sq").alias("steps"), F.count(F.lit(1)).alias("rows"),
                           F.sum("y").alias("y"))
    per_series = parts.groupBy(*keys).agg(F.collect_list(F.struct("part", "sq", "steps", "rows", "y")).alias("p"))

    def total(field: str, of) -> Column:
        return F.aggregate(F.filter("p", of), F.lit(0.0), lambda a, x: a + F.coalesce(x[field].cast("double"), F.lit(0.0)))

    def older(x: Column) -> Column:
        return x["part"] > F.col("window")

    known = per_series.select(*keys, "p", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("window")).select(
        *keys, "window", (total("sq", older) / F.nullif(total("steps", older), F.lit(0.0))).alias("scale"),
        total("rows", older).alias("rows"),
        total("y", lambda x: x["part"] == F.col("window") + 1).alias("weight"))
    error = F.col("prediction").cast("double") - target
    mse = scored.withColumn("window", number(n + 1)).where(F.col("window").between(1, n)).groupBy(
        "model_name", "window", *keys).agg(F.avg(error * error).alias("mse"))
    value = F.when((F.col("rows") >= 2) & (F.col("scale") > 0), F.sqrt(F.col("mse") / F.col("scale")))
    return mse.join(known, [*keys, "window"], "left").select("model_name", "window", *keys, value.alias("rmsse"), "weight")


def window_wrmsse(
    scored: DataFrame, history: DataFrame, newest: Column, config: BacktestConfig = BacktestConfig(),
) -> DataFrame:
    """(model_name, window, series_count, undefined_series, wrmsse), the primary metric.

    See ``window_rmsse``; a series without a value is counted as undefined and takes no part in the mean.
    """
    joined = window_rmsse(scored, history, newest, config)
    weight = F.sum(F.when(F.col("rmsse").isNotNull(), F.col("weight")))
    return joined.groupBy("model_name", "window").agg(
        F.count("rmsse").alias("series_count"), F.count_if(F.col("rmsse").isNull()).alias("undefined_series"),
        (F.sum(F.col("rmsse") * F.col("weight")) / F.nullif(weight, F.lit(0.0))).alias("wrmsse"))


def mean_metrics(result: DataFrame) -> DataFrame:
    """Averages over the windows of one backtest."""
    primary = [F.avg("wrmsse").alias("avg_wrmsse")] if "wrmsse" in result.columns else []
    return result.agg(
        *primary, F.avg("wmape").alias("avg_wmape"), F.avg("mae").alias("avg_mae"),
        F.avg("rmse").alias("avg_rmse"), F.count(F.lit(1)).alias("backtest_windows"))


def ablation_grid(
    features: DataFrame, feature_sets: Sequence[str] = tuple(S.FEATURE_SETS),
    forecasters: Mapping[str, ExpressionForecaster] = BASELINES,
    config: BacktestConfig = BacktestConfig(),
) -> DataFrame:
    """Feature sets x closed-form models x windows, in one pass over the features.

    Each row is tagged with the sets it is complete for and reduced map-side;
    a set's windows are anchored to the newest day of its own complete cases.
    """
    actual = F.col(config.target_column).cast("double")
    tags = F.filter(
        F.array(*[F.when(is_complete(features, s), F.lit(s)) for s in feature_sets]),
        lambda s: s.isNotNull())
    feature_map = {c: F.col(c) for c in features.columns}
    models = list(forecasters)
    slim = features.select(
        F.col(config.date_column).alias("day"), actual.alias("y"),
        *[f(feature_map).cast("double").alias(f"p{i}") for i, f in enumerate(forecasters.values())],
        F.explode(tags).alias("feature_set_name"))
    # Per-day sums: at most one row per set and calendar day reaches the split.
    sums = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")]
    for i in range(len(models)):
        err = F.col(f"p{i}") - F.col("y")
        sums += [F.sum(F.abs(err)).alias(f"abs{i}"), F.sum(err * err).alias(f"sq{i}")]
    daily = slim.groupBy("feature_set_name", "day").agg(*sums)
    # a set has one row per calendar day here, so the window stays small
    newest = F.max("day").over(Window.partitionBy("feature_set_name"))
    numbered = daily.withColumn("_newest", newest).withColumn(
        "window", window_number(F.col("day"), F.col("_newest"), config))
    per_window = (
        numbered.where(F.col("window") <= config.n_windows)
        .groupBy("feature_set_name", "window")
        .agg(F.sum("n").alias("n"), F.sum("y").alias("y"),
             *[F.sum(c).alias(c) for i in range(len(models)) for c in (f"abs{i}", f"sq{i}")]))
    stacked = per_window.select(
        "feature_set_name", "window", "n", "y",
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("model_name"), F.col(f"abs{i}").alias("a"),
                     F.col(f"sq{i}").alias("s")) for i, m in enumerate(models)])).alias("m"))
    return stacked.select(
        "feature_set_name", "m.model_name", "window", F.col("n").alias("test_rows"),
        F.when(F.col("y") != 0, F.col("m.a") / F.col("y")).alias("wmape"),
        (F.col("m.a") / F.col("n")).alias("mae"), F.sqrt(F.col("m.s") / F.col("n")).alias("rmse"))


def ablation_with_models(
    features: DataFrame, factories: Mapping[str, Callable[[], Estimator]],
    feature_sets: Sequence[str] = tuple(S.FEATURE_SETS),
    config: BacktestConfig = BacktestConfig(), parallelism: int = 1,
) -> DataFrame:
    """The same grid for fitted models: a distributed fit per cell."""
    cells = []
    for name in feature_sets:
        columns = S.feature_columns(name)
        modeling = features.dropna(subset=columns)
        for model, factory in factories.items():
            cells.append(
                backtest_model(modeling, columns, factory, config, parallelism)
                .select(F.lit(name).alias("feature_set_name"), F.lit(model).alias("model_name"),
                        "window", "test_rows", "wmape", "mae", "rmse"))
    return reduce(DataFrame.unionByName, cells)


def rank_candidates(
    grid: DataFrame, metric: str = "wmape",
    baselines: Sequence[str] = ("seasonal_naive_lag_7", "rolling_mean_7"),
) -> DataFrame:
    """Apply the selection rules to a grid of (feature set, model, window) rows.

    Average metric decides; ``std`` and ``worst`` show stability; a candidate
    beats the baselines if it is better than the best of them in every window
    of its feature set.  The grid has one row per cell, so the rank is over a
    few dozen rows.
    """
    per_window = Window.partitionBy("feature_set_name", "window")
    best_baseline = F.min(F.when(F.col("model_name").isin(list(baselines)), F.col(metric)))
    summary = (
        grid.withColumn("_floor", best_baseline.over(per_window))
        .groupBy("feature_set_name", "model_name")
        .agg(F.count(F.lit(1)).alias("windows"), F.avg(metric).alias(f"avg_{metric}"),
             F.stddev_samp(metric).alias(f"std_{metric}"), F.max(metric).alias(f"worst_{metric}"),
             F.count_if(F.col(metric) < F.col("_floor")).alias("windows_beating_baselines")))
    # Averages equal to nine places tie; names decide then.
    place = F.row_number().over(Window.orderBy(
        F.round(f"avg_{metric}", 9).asc_nulls_last(), "feature_set_name", "model_name"))
    return summary.withColumn(
        "beats_baselines", F.col("windows_beating_baselines") == F.col("windows"),
    ).withColumn("rank", place)

"""Recursive multi-step forecasts without per-step joins or shuffles.

The history of a series is folded once into one state row: its last 28 sales
(an array), its last date, and the frozen context of its last row.  Each step
appends a prediction to the array, so lags and rolling means of later days see
earlier predictions, and no step needs another exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions.scalar import to_double
from demandloom.operators.baselines import ExpressionForecaster
from demandloom.operators.features import LAGS, ROLLS, calendar_features, last_rows
from demandloom.session import cut_lineage

DEPTH = max(*LAGS, *ROLLS)
HISTORY_ROWS = 60
HORIZON = 28
FORECAST_COLUMNS = ("store_id", "item_id", "forecast_date", "forecast_step", "prediction")


def series_state(history: DataFrame, history_rows: int = HISTORY_ROWS) -> DataFrame:
    """One row per series: ``sales_tail``, ``last_date``, frozen context.

    At most ``history_rows`` rows of a series are gathered.  Series shorter
    than the longest lag are padded with nulls in front.  The carried price is
    the last known one in that history, else 0, and the missing flag tells
    whether the last row itself lacked a price.
    """
    context = [c for c in S.EXTERNAL_FEATURES if c in history.columns]
    tail = last_rows(
        history.select(*S.SERIES_KEYS, F.col("date").cast("date").alias("date"),
                       F.col("sales").cast("double").alias("sales"),
                       to_double(F.col("sell_price")).alias("sell_price"),
                       *[to_double(F.col(c)).alias(c) for c in context]),
        history_rows)
    by_date = F.sort_array(F.collect_list(F.struct("date", "sales")))
    folded = tail.groupBy(*S.SERIES_KEYS).agg(
        by_date.alias("_h"), F.max("date").alias("last_date"),
        F.max_by(F.struct("sell_price", *context), "date").alias("_ctx"),
        F.max_by("sell_price", F.when(F.col("sell_price").isNotNull(), F.col("date")))
        .alias("_known_price"))
    units = F.transform("_h", lambda r: r["sales"])
    padding = F.array_repeat(F.lit(None).cast("double"), DEPTH)
    padded = F.concat(padding, units)
    return folded.select(
        *S.SERIES_KEYS, "last_date", F.slice(padded, -DEPTH, DEPTH).alias("sales_tail"),
        F.coalesce("_known_price", F.lit(0.0)).alias("sell_price_filled"),
        F.col("_ctx.sell_price").isNull().cast("int").alias("sell_price_missing_flag"),
        *[F.col(f"_ctx.{c}").alias(c) for c in context])


def _mean_of_last(tail: Column, n: int) -> Column:
    """Mean of the last n entries; null as soon as one of them is unknown."""
    total = F.aggregate(F.slice(tail, -n, n), F.lit(0.0), lambda a, x: a + x)
    return total / F.lit(float(n))


def step_features(tail: Column, day: Column, carried: Mapping[str, Column]) -> dict[str, Column]:
    """Every model feature of the next day, from the state alone."""
    return {
        **calendar_features(day),
        **{f"lag_{n}": F.element_at(tail, -n) for n in LAGS},
        **{f"rolling_mean_{n}": _mean_of_last(tail, n) for n in ROLLS},
        **carried,
    }


def _carried(state: DataFrame) -> dict[str, Column]:
    fixed = {*S.SERIES_KEYS, "last_date", "sales_tail"}
    return {c: F.col(c) for c in state.columns if c not in fixed}


def _as_rows(series: DataFrame, predictions: Column) -> DataFrame:
    """Array of predictions -> one row per forecast day."""
    rows = series.select(
        *S.SERIES_KEYS, "last_date", F.posexplode(predictions).alias("_i", "prediction"))
    step = (F.col("_i") + 1).cast("int")
    return rows.select(
        *S.SERIES_KEYS, F.date_add("last_date", step).alias("forecast_date"),
        step.alias("forecast_step"), "prediction")


def forecast_expression(
    history: DataFrame, forecaster: ExpressionForecaster, horizon: int = HORIZON,
    history_rows: int = HISTORY_ROWS,
) -> DataFrame:
    """Recursive forecast of a closed-form forecaster: one fold per series row."""
    state = series_state(history, history_rows)
    carried = _carried(state)

    def advance(acc: Column, step: Column) -> Column:
        day = F.date_add(F.col("last_date"), step)
        value = forecaster(step_features(acc["tail"], day, carried)).cast("double")
        tail = F.concat(F.slice(acc["tail"], 2, DEPTH - 1), F.array(value))
        return F.struct(tail.alias("tail"), F.concat(acc["out"], F.array(value)).alias("out"))

    start = F.struct(
        F.col("sales_tail").alias("tail"), F.array().cast("array<double>").alias("out"))
    folded = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), start, advance, lambda acc: acc["out"])
    return _as_rows(state.withColumn("_p", folded), F.col("_p"))


def forecast_model(
    history: DataFrame, model: Transformer, features: Sequence[str], horizon: int = HORIZON,
    history_rows: int = HISTORY_ROWS, checkpoint_every: int = 7,
) -> DataFrame:
    """Recursive forecast of a fitted ``pyspark.ml`` model.

    Each step is narrow: features from the array, ``transform``, append.  The
    lineage is cut with a reliable checkpoint every few steps, which bounds the
    plan and what a lost executor costs.  Nothing is clipped or rounded before
    it is fed back.
    """
    state = cut_lineage(series_state(history, history_rows))
    carried = _carried(state)
    kept = [*S.SERIES_KEYS, "last_date", "sales_tail", *carried, "_out"]
    running = state.withColumn("_out", F.array().cast("array<double>"))
    for step in range(1, horizon + 1):
        day = F.date_add("last_date", step)
        derived = {
            k: v for k, v in step_features(F.col("sales_tail"), day, carried).items()
            if k in features and k not in carried}
        scored = model.transform(running.withColumns(derived))
        running = scored.withColumns({
            "sales_tail": F.concat(F.slice("sales_tail", 2, DEPTH - 1), F.array("prediction")),
            "_out": F.concat("_out", F.array("prediction")),
        }).select(*kept)
        if step % checkpoint_every == 0 and step < horizon:
            running = cut_lineage(running)
    return _as_rows(running, F.col("_out"))


def with_run_metadata(
    forecast: DataFrame, model_name: str, model_version: str, feature_set: str, generated_at,
) -> DataFrame:
    """Forecast rows in the column order of the forecast table."""
    stamped = forecast.withColumns({
        "model_name": F.lit(model_name), "model_version": F.lit(model_version),
        "feature_set_name": F.lit(feature_set),
        "generated_at": F.lit(generated_at).cast("timestamp"),
    })
    return stamped.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in S.FORECAST_TABLE])

"""

``queries()`` runs every operator over the whole given tables; ``oracle_sql()``
holds independent SQL for DuckDB.  On both sides doubles are rounded to six
places, dates are text and lists are joined, so values compare exactly.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.regression import LinearRegression  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_queries  # noqa: E402
from demandloom import schemas as S  # noqa: E402
from demandloom.functions import metrics as M  # noqa: E402
from demandloom.functions import scalar as X  # noqa: E402
from demandloom.operators import (  # noqa: E402
    asof, audit, backtest, baselines, boosting, contracts, extract, features, forest, gold, linear_grid, models,
    monitoring, order_stats, quality, recursion, reports, reshape, silver, splits, stability,
)
from demandloom.plans import prediction, refresh, training  # noqa: E402
from demandloom.plans.training import modeling_frame  # noqa: E402
from demandloom.session import scratch_path  # noqa: E402
from demandloom.sinks import manifest  # noqa: E402
from demandloom.sinks import snapshots as published  # noqa: E402
from demandloom.sinks.forecasts import ForecastTable, overwrite_horizon  # noqa: E402
from demandloom.sinks.tables import refresh_path, write_extract  # noqa: E402
from demandloom.sources import landing, snapshots  # noqa: E402
from demandloom.sources.order_landing import land  # noqa: E402
from demandloom.sources.order_tables import OrderTables  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]

# The configured depth, features and windows, with fewer trees: README has the times
# measured at the configured number of trees.
SMALL_BOOSTING = replace(models.GRADIENT_BOOSTING, trees=20, learning_rate=0.3)
SMALL_FOREST = replace(models.RANDOM_FOREST, trees=20)


def present(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Comparable output: rounded doubles, dates as text, lists joined."""
    out = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(kind, T.ArrayType):
            c = F.concat_ws(",", c)
        out.append(c.alias((rename or {}).get(f.name, f.name)))
    return df.select(*out)


WINDOW = {"window": "window_no"}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily feature mart with price, weather, macro and search values."""
    return OrderTables(spark, SMALLEST).mart


def _on(build: Callable[[OrderTables], DataFrame], rename: dict[str, str] | None = None) -> Query:
    return lambda spark, sf: present(build(OrderTables(spark, sf)), rename)


def _cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


# -- reshaping ----------------------------------------------------------------

MACRO_COLUMNS = ("series_id", "feature_name", "series_label", "frequency", "units",
                 "observation_date", "observation_value")
TRENDS_COLUMNS = ("keyword", "feature_name", "label", "geo", "trend_date", "interest_value")
WEATHER_COLUMNS = ("location_id", "state_id", "weather_date", *S.WEATHER_MEASURES)


def _keyword_files(t: OrderTables) -> DataFrame:
    parts = []
    for keyword, *_ in S.TRENDS_KEYWORDS:
        raw = t.keyword_file(keyword)
        parts.append(landing.normalise_trends(raw, landing.interest_column(raw.columns, keyword)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return silver.trends_interest(out).select(*TRENDS_COLUMNS)


def _date_chunks(t: OrderTables) -> DataFrame:
    bounds = t.sales.groupBy("store_id").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    return landing.date_chunks(bounds, 180).select(
        "store_id", "chunk_index", "chunk_start", "chunk_end")


def _dedup(t: OrderTables) -> DataFrame:
    events = t.table("events").withColumn("day", F.col("ts").cast("date"))
    return reshape.keep_last(events, ["event_type", "day"], ["ts", "event_id"]).select(
        "event_type", "day", "event_id", "user_id", "value")


def _asof_window(t: OrderTables) -> DataFrame:
    """The window form of the as-of alignment; same rows as the daily form."""
    macro = t.macro.where("observation_value is not null")
    days = t.sales_days
    per_feature = None
    for feature in S.MACRO_FEATURES:
        probes = days.withColumn("feature_name", F.lit(feature))
        per_feature = probes if per_feature is None else per_feature.unionByName(probes)
    found = asof.latest_at_or_before(
        per_feature, macro, ["feature_name"], "date", "observation_date", ["observation_value"])
    return found.where("observation_date is not null").select(
        "date", "feature_name", F.col("observation_date").alias("source_observation_date"),
        "observation_value")


# -- round trips through landed files and sinks -------------------------------


def _landed(name: str, columns: Sequence[str] | None = None) -> Query:
    """A Silver table built from the landed files."""
    def build(t: OrderTables) -> DataFrame:
        table = refresh.build_silver(refresh.staging(t.spark, land(t)))[name]
        return table.select(*columns) if columns else table
    return _on(build)


def _landed_gates(t: OrderTables) -> DataFrame:
    out = None
    for name, report in refresh.quality_reports(t.spark, land(t)).items():
        part = report.select(F.lit(name).alias("dataset"), "passed")
        out = part if out is None else out.unionByName(part)
    return out


def _table_roundtrip(t: OrderTables) -> DataFrame:
    """Three batches through the forecast sink, each overwriting its horizon."""
    table = ForecastTable(t.spark, scratch_path(t.spark, "forecast-table"))
    for version in ("1", "2", "3"):
        table.overwrite(t.forecasts.where(F.col("model_version") == version))
    return table.read()


def _snapshot_roundtrip(t: OrderTables) -> DataFrame:
    root = scratch_path(t.spark, "snapshot")
    prediction.export_snapshot(t.forecasts, root, "20240131T040500Z")
    rows, label = snapshots.read_with_fallback(
        t.spark, f"{published.latest_path(root, t.spark)}/{published.ROWS}", None, S.FORECAST_TABLE)
    return rows.withColumn("read_from", F.lit(label))


def _extract_roundtrip(t: OrderTables) -> DataFrame:
    path = scratch_path(t.spark, "extract")
    write_extract(extract.training_extract(t.stored_mart, None), path, rows_per_file=25_000)
    return landing.read_extract(t.spark, path)


def _extract_manifest(t: OrderTables) -> DataFrame:
    """Rows of some stores from a verified extract, and the rows its manifest counts."""
    path = scratch_path(t.spark, "extract-manifest")
    rows = manifest.write_extract_with_manifest(
        extract.training_extract(t.stored_mart, None), path, rows_per_file=25_000)
    found = manifest.read_verified(t.spark, path, {"store_id": ("NATION_1", "NATION_2")})
    return found.withColumn("manifest_rows", rows.agg(F.sum("rows")).scalar())


def _mart_roundtrip(t: OrderTables) -> DataFrame:
    path = scratch_path(t.spark, "loaded-mart")
    t.stored_mart.write.parquet(path)
    return landing.load_mart(t.spark, path)


# -- models -------------------------------------------------------------------


def _modeling(t: OrderTables) -> DataFrame:
    """Complete cases, stored once: splits and every fit read them again."""
    if "modeling" not in t.__dict__:
        t.modeling = t._stored("modeling", modeling_frame(t.unpriced, S.DEFAULT_FEATURE_SET))
    return t.modeling


def _first_window(t: OrderTables) -> tuple[DataFrame, DataFrame]:
    return splits.hold_out(_modeling(t))


def _seasonal(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", baselines.seasonal_naive({"lag_7": F.col("lag_7")}))


def _metrics_by_store(t: OrderTables) -> DataFrame:
    y, p = F.col("sales"), F.col("prediction")
    return _seasonal(_first_window(t)[1]).groupBy("store_id").agg(
        M.wmape(y, p).alias("wmape"), M.mae(y, p).alias("mae"), M.rmse(y, p).alias("rmse"))


def _bias(t: OrderTables) -> DataFrame:
    return _seasonal(_first_window(t)[1]).groupBy("store_id").agg(
        M.bias(F.col("sales"), F.col("prediction")).alias("bias"))


def _before_first_window(t: OrderTables) -> DataFrame:
    """Full history before the newest test window of the complete cases."""
    start = splits.split_bounds(_modeling(t)).where("window = 1").select("test_start").scalar()
    return t.stored_sales.where(F.col("date") < start)


def _rmsse(t: OrderTables) -> DataFrame:
    return M.rmsse_by_series(
        _seasonal(_first_window(t)[1]), _before_first_window(t), on_undefined="null")


def _wrmsse(t: OrderTables) -> DataFrame:
    # per-series values feed both the weights and the mean
    every = refresh_path(_rmsse(t), scratch_path(t.spark, "rmsse"))
    per_series = every.where("rmsse is not null")
    history = _before_first_window(t)
    start = splits.split_bounds(_modeling(t)).where("window = 1").select("test_start").scalar()
    recent = F.when(F.col("date") >= F.date_sub(start, 28), F.col("sales")).otherwise(0)
    totals = history.groupBy(*S.SERIES_KEYS).agg(F.sum(recent).alias("weight"))
    weights = totals.join(per_series.select(*S.SERIES_KEYS), list(S.SERIES_KEYS), "left_semi")
    undefined = every.agg(F.count_if(F.col("rmsse").isNull())).scalar()
    return M.wrmsse(per_series, weights).withColumn("undefined_series", undefined)


def _backtest_wrmsse(t: OrderTables) -> DataFrame:
    """WRMSSE of the closed-form forecasters in every window of the complete cases."""
    frame = _modeling(t)
    lags = {c: F.col(c) for c in frame.columns}
    scored = frame.select(*S.GRAIN, "sales", F.explode(F.array(*[
        F.struct(F.lit(name).alias("model_name"), f(lags).cast("double").alias("prediction"))
        for name, f in baselines.BASELINES.items()])).alias("m")).select(*S.GRAIN, "sales", "m.*")
    return backtest.window_wrmsse(scored, t.stored_sales, frame.agg(F.max("date")).scalar())


def _ranking_wrmsse(t: OrderTables) -> DataFrame:
    grid = _backtest_wrmsse(t).withColumn("feature_set_name", F.lit(S.DEFAULT_FEATURE_SET))
    return backtest.rank_candidates(grid, metric="wrmsse")


def _recursive(forecaster: baselines.ExpressionForecaster) -> Query:
    return _on(lambda t: recursion.forecast_expression(t.unpriced, forecaster))


def _ranking_stability(t: OrderTables) -> DataFrame:
    """The closed-form forecasters by WRMSSE, with the middle 95 % of their gap to the best baseline."""
    frame = _modeling(t)
    lags = {c: F.col(c) for c in frame.columns}
    scored = frame.select(*S.GRAIN, "sales", F.explode(F.array(*[
        F.struct(F.lit(name).alias("model_name"), f(lags).cast("double").alias("prediction"))
        for name, f in baselines.BASELINES.items()])).alias("m")).select(*S.GRAIN, "sales", "m.*")
    per_series = backtest.window_rmsse(scored, t.stored_sales, frame.agg(F.max("date")).scalar())
    return stability.rank_stable(per_series, ("seasonal_naive_lag_7", "rolling_mean_7"))


def _recursive_gbt(t: OrderTables) -> DataFrame:
    """Boosted trees as one expression: 28 steps in one fold."""
    model = models.fit(_modeling(t), SMALL_BOOSTING)
    trees = forest.from_model(model, S.feature_columns(SMALL_BOOSTING.feature_set))
    return recursion.forecast_expression(t.unpriced, trees.predict)


#: Edges of the small leaf-wise model, which has a SQL twin.
LEAFWISE_EDGES = (1, 2, 5, 10, 20, 30, 40)


def _recursive_leafwise(t: OrderTables) -> DataFrame:
    config = boosting.LeafwiseConfig(trees=2, leaves=2, learning_rate=0.5, least_rows=1)
    trees = boosting.fit_leafwise(_modeling(t), ["lag_1", "lag_7"], "sales", config,
                                  {"lag_1": LEAFWISE_EDGES, "lag_7": LEAFWISE_EDGES})
    return recursion.forecast_expression(t.unpriced, trees.predict)


def _backtest_linear_wrmsse(t: OrderTables) -> DataFrame:
    return backtest.backtest_model(_modeling(t), ["lag_7"], _linear, history=t.stored_sales)


def _linear() -> LinearRegression:
    return LinearRegression(labelCol="sales", solver="normal")


def _backtest_linear(t: OrderTables) -> DataFrame:
    return backtest.backtest_model(_modeling(t), ["lag_7"], _linear)


def _recursive_linear(t: OrderTables) -> DataFrame:
    rows = _modeling(t).select("lag_7", F.col("sales").cast("double").alias("sales"))
    model = backtest.assembled(_linear(), ["lag_7"]).fit(rows)
    rows = recursion.forecast_model(t.unpriced, model, ["lag_7"])
    # An unknown lag makes the line's value NaN.
    return rows.withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))


def _predicted_batch(t: OrderTables) -> DataFrame:
    """The prediction plan with the newest of two stored versions, through the forecast table."""
    rows = _modeling(t).select("lag_7", "lag_28", F.col("sales").cast("double").alias("sales"))
    root = scratch_path(t.spark, "models")
    for column in ("lag_28", "lag_7"):
        models.save_model(backtest.assembled(_linear(), [column]).fit(rows), root, "linear")
    table = ForecastTable(t.spark, scratch_path(t.spark, "predicted"))
    prediction.predict(t.spark, t.unpriced, root, "linear", table, datetime(2024, 1, 31, 4, 5))
    return table.read().select(
        "store_id", "item_id", "forecast_date", "forecast_step",
        F.when(~F.isnan("prediction"), F.col("prediction")).alias("prediction"), "model_version")


def _training_run(t: OrderTables) -> DataFrame:
    """The training plan with three small trees: its windows, stored version, settings and importances."""
    config = replace(models.GRADIENT_BOOSTING, trees=3, max_depth=3, learning_rate=0.3)
    run = training.train(t.spark, t.unpriced, config, scratch_path(t.spark, "trained"), config.n_windows)
    importance = run.importance.agg(
        F.count(F.lit(1)).alias("importance_rows"), F.sum("importance").alias("importance_total"))
    return run.windows.select("window", "train_rows", "test_rows").withColumns({
        "model_version": F.lit(run.version),
        "modeling_rows": run.metrics.select("modeling_rows").scalar(),
        "feature_count": run.params.where("name = 'feature_count'").select("value").scalar(),
        "importance_rows": importance.select("importance_rows").scalar(),
        "importance_total": importance.select("importance_total").scalar()})


def _linear_grid(t: OrderTables) -> DataFrame:
    stored = t._stored("sales-features", t.sales_features)
    return linear_grid.ablation_linear(stored, {
        "lag_7": ("lag_7",), "lag_28": ("lag_28",), "rolling_mean_28": ("rolling_mean_28",),
        "lag_7_and_rolling_mean_28": ("lag_7", "rolling_mean_28")})


def _linear_sets(t: OrderTables) -> DataFrame:
    """All six feature sets; no SQL, as DuckDB solves no systems of equations."""
    return linear_grid.ablation_linear(
        t._stored("mart-features", t.features), {n: S.feature_columns(n) for n in S.FEATURE_SETS})


def _backtest_model(config: models.TreeConfig) -> Query:
    return _on(lambda t: backtest.backtest_model(
        _modeling(t), S.feature_columns(config.feature_set),
        models.estimator_factory(config),
        splits.BacktestConfig(config.horizon_days, config.n_windows), parallelism=config.n_windows), WINDOW)


def _importance(t: OrderTables) -> DataFrame:
    model = models.fit(_modeling(t), SMALL_FOREST)
    return models.feature_importance(model, S.feature_columns(SMALL_FOREST.feature_set))


# -- forecasts, quality, reports ----------------------------------------------


def _latest(t: OrderTables) -> DataFrame:
    return monitoring.latest_batch(t.forecasts)


def _horizon(t: OrderTables) -> DataFrame:
    old = t.forecasts.where("model_version <> '3'")
    return overwrite_horizon(old, t.forecasts.where("model_version = '3'"))


def _snapshot_metadata(t: OrderTables) -> DataFrame:
    return monitoring.snapshot_metadata(
        t.freshness, monitoring.run_monitoring(t.forecasts), t.forecasts, "20240131T040500Z")


def _audit_state(t: OrderTables) -> DataFrame:
    return audit.latest_state(t.run_events).select(
        "run_id", "source_name", "status", "row_value",
        F.length("message").alias("message_length"), "message")


def _compacted_audit(t: OrderTables) -> DataFrame:
    """The same state through a log that is compacted twice while events arrive."""
    events = t.run_events.select("*", F.col("event_ts.ts").cast("timestamp").alias("at")).drop(
        "event_ts").withColumnRenamed("at", "event_ts")
    log = audit.EventLog(t.spark, scratch_path(t.spark, "audit"), events.schema)
    early = F.col("event_ts") < F.lit("2024-01-12").cast("timestamp")
    log.append(events.where(early))
    log.compact(date(2024, 1, 10))
    log.append(events.where(~early))
    log.compact(date(2024, 1, 20))
    return log.state().select(
        "run_id", "source_name", "status", "row_value",
        F.length("message").alias("message_length"), "message")


def _flagged_prices(t: OrderTables) -> DataFrame:
    week = t.week_of(t.day_number(F.col("date"))).alias("wm_yr_wk")
    return t.lines.select("store_id", "item_id", week, "l_returnflag").distinct()


def _net_sales(t: OrderTables) -> DataFrame:
    units = F.col("l_quantity").cast("bigint")
    net = F.sum(F.when(F.col("l_returnflag") == "R", -units).otherwise(units))
    return t.lines.groupBy("store_id", "item_id", "date").agg(net.alias("sales"))


def _day_number() -> F.Column:
    return F.substring_index("d", "_", -1).cast("int")


def _dirty_calendar(t: OrderTables) -> DataFrame:
    n = _day_number()
    return t.calendar_raw.withColumns({
        "date": F.when(n % 400 == 0, "unknown").otherwise(F.col("date")),
        "wm_yr_wk": F.when(n % 30 == 0, None).otherwise(F.col("wm_yr_wk")),
        "weekday": F.when(n % 13 == 0, F.lower("weekday")).otherwise(F.col("weekday")),
        "d": F.when(n % 50 == 0, F.concat(F.lit("d_"), n - 1)).otherwise(F.col("d")),
    })


def _calendar_order(t: OrderTables) -> DataFrame:
    n = _day_number()
    day = F.col("date").cast("date")
    shuffled = t.calendar_raw.select(
        n.alias("n"), F.when(n % 100 == 0, F.date_sub(day, 2)).otherwise(day).alias("date"))
    verdict = quality.non_decreasing(shuffled, F.col("date"), F.col("n"))
    return shuffled.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "date_monotonic_non_decreasing", verdict)


def _calendar_file_order(t: OrderTables) -> DataFrame:
    """The calendar landed as three files of unequal length, and with the last days first."""
    n = _day_number()
    part = F.when(n <= 200, 1).when(n <= 1000, 2).otherwise(3)
    out = None
    for layout, of in (("in_order", part), ("last_days_first", 4 - part)):
        root = scratch_path(t.spark, "calendar-files")
        folders = [f"{root}/{k}" for k in (1, 2, 3)]
        for k, folder in enumerate(folders, 1):
            t.calendar_raw.where(of == k).repartition(1).sortWithinPartitions(n).write.option(
                "header", True).csv(folder)
        report = quality.tagged(
            quality.calendar_checks(landing.read_headed_csv(t.spark, folders)), {"layout": layout})
        out = report if out is None else out.unionByName(report)
    return out.select("layout", "rows", "date_monotonic_non_decreasing", "passed")


def _sampled(t: OrderTables) -> DataFrame:
    rows = t.stored_sales.select(*S.GRAIN, "sales")
    whole = order_stats.sample_n(rows, 1000).withColumn("part", F.lit("all"))
    return whole.unionByName(
        order_stats.sample_n(rows, 20, strata=("store_id",)).withColumn("part", F.lit("store")))


def _dirty_prices(t: OrderTables) -> DataFrame:
    week = F.col("wm_yr_wk").cast("int")
    return t.prices_raw.withColumns({
        "sell_price": F.when(week % 11 == 0, "-1").when(week % 7 == 0, "free")
        .when(week % 5 == 0, None).otherwise(F.col("sell_price")),
        "wm_yr_wk": F.when(week % 50 == 0, None).otherwise(F.col("wm_yr_wk")),
    })


def _macro_texts(t: OrderTables) -> DataFrame:
    """Macro documents as JSON text, some observations without date or value."""
    series = F.col("series_metadata.series_id")
    month = lambda o: F.month(o["date"].cast("date"))
    faulty = F.transform("observations", lambda o: F.struct(
        F.when((series == "PAYEMS") & (month(o) == 2), "").otherwise(o["date"]).alias("date"),
        F.when((series == "UNRATE") & (month(o) == 3), "").otherwise(o["value"]).alias("value")))
    docs = t.macro_documents.withColumn("observations", faulty)
    return docs.select(series.alias("series_id"), F.to_json(F.struct(*docs.columns)).alias("document"))


def _macro_report(t: OrderTables) -> DataFrame:
    return quality.macro_document_checks(_macro_texts(t), parts=("series_id",))


def _weather_texts(t: OrderTables) -> DataFrame:
    """Weather documents as JSON text, measures shifted so that some are negative."""
    def shifted(name: str, by: float) -> F.Column:
        return F.transform(f"daily.{name}", lambda v: v.cast("double") - F.lit(by))

    daily = F.struct(
        "daily.time", *[shifted(m, 0.0).alias(m) for m in S.WEATHER_MEASURES[:2]],
        shifted("precipitation_sum", 4.0).alias("precipitation_sum"),
        shifted("wind_speed_10m_max", 100.0).alias("wind_speed_10m_max"))
    docs = t.weather_documents.withColumns({
        "daily": daily, "latitude": F.lit(0.0), "longitude": F.lit(0.0), "timezone": F.lit("UTC")})
    text = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    return docs.select(F.col("location.location_id").alias("location_id"), text.alias("document"))


def _trends_report(t: OrderTables) -> DataFrame:
    out = None
    for keyword, *_ in S.TRENDS_KEYWORDS:
        report = quality.tagged(
            quality.trends_checks(t.keyword_file(keyword)), {"keyword": keyword})
        out = report if out is None else out.unionByName(report)
    return out


def _keyless_macro_texts(t: OrderTables) -> DataFrame:
    """Macro documents in which each series lacks something: a label, the ingestion part, values, all observations."""
    series, none = F.col("series_metadata.series_id"), F.lit(None).cast("string")
    meta = F.col("series_metadata")
    valueless = F.transform("observations", lambda o: F.struct(
        o["date"].alias("date"), F.when(F.month(o["date"].cast("date")) != 2, o["value"]).alias("value")))
    docs = t.macro_documents.withColumns({
        "series_metadata": F.when(series == "CPIAUCSL", meta.withField("label", none)).otherwise(meta),
        "ingestion_metadata": F.when(series != "UNRATE", F.col("ingestion_metadata")),
        "observations": F.when(series == "FEDFUNDS", valueless).when(
            series != "PAYEMS", F.col("observations"))})
    return docs.select(series.alias("series_id"), F.to_json(F.struct(*docs.columns)).alias("document"))


def _trends_faults(t: OrderTables) -> DataFrame:
    """Keyword files without a fixed column, without a value column, with two of them, and with bad values."""
    month = F.month(F.col("date").cast("date"))
    faults = {
        "walmart": lambda f, k: f.drop("geo"),
        "grocery store": lambda f, k: f.drop(k),
        "discount store": lambda f, k: f.withColumn("interest", F.col(f"`{k}`")),
        "cleaning supplies": lambda f, k: f.withColumn(
            k, F.when(month == 1, "-1").when(month == 2, "none").otherwise(F.col(f"`{k}`"))),
    }
    out = None
    for keyword, fault in faults.items():
        report = quality.tagged(
            quality.trends_checks(fault(t.keyword_file(keyword), keyword)), {"keyword": keyword})
        out = report if out is None else out.unionByName(report)
    return out


def _gate_verdicts(t: OrderTables) -> DataFrame:
    """Four gates through the quality log: each is started, judged and closed, and the state is read back."""
    log = audit.QualityLog(t.spark, scratch_path(t.spark, "gates"))
    for name, dataset, report in (
        ("calendar", "calendar", quality.calendar_checks(t.calendar_raw, _day_number())),
        ("calendar", "calendar_faults", quality.calendar_checks(_dirty_calendar(t), _day_number())),
        ("sell_prices", "sell_prices", quality.sell_price_checks(t.prices_raw)),
        ("macro_series", "macro_series", quality.suite_rollup(_macro_report(t), "series_id")),
    ):
        run_id = log.start(dataset, quality.SUITES[name].suite)
        try:
            quality.gate(report, log, run_id, name)
        except quality.DataQualityError:
            continue  # the log has the verdict
    counters = ("rows", "pk_nulls", "wm_yr_wk_nulls", "parts_failed")
    return log.state().select(
        "dataset_name", "suite_name", "status", F.substring_index("error_message", ";", 1).alias("message"),
        *[F.get_json_object("details_json", f"$.{c}").cast("bigint").alias(c) for c in counters])


def _stamped_weather(t: OrderTables) -> DataFrame:
    """Daily weather with the metadata of its registered location and the constants of its source."""
    station = F.element_at(F.array(F.lit("CA"), F.lit("TX"), F.lit("WI")), (F.length("state_id") % 3 + 1).cast("int"))
    rows = t.weather.select(
        F.col("state_id").alias("region"), station.alias("location_id"), "weather_date", "precipitation_sum")
    registered = reshape.stamp_from_registry(rows, S.weather_registry(t.spark), "location_id")
    return reshape.stamp(registered, S.SOURCE_CONTRACTS["weather"])


def _run_ids(t: OrderTables) -> DataFrame:
    hour = F.date_trunc("hour", "ts")
    return t.table("events").groupBy(X.run_id_text(hour).alias("run_id")).agg(F.count(F.lit(1)).alias("events"))


#: Codes as they may come, one per order priority: known, padded, missing, unknown, empty.
SHOWN_CODES = {
    "1-URGENT": ("gradient_boosted_trees", "latest", "full_feature_set"),
    "2-HIGH": (" random_forest ", "cache", "baseline_plus_price"),
    "3-MEDIUM": (None, " unavailable", "baseline_plus_weather"),
    "4-NOT SPECIFIED": ("prophet", "elsewhere", "baseline_plus_macro "),
    "5-LOW": ("", None, None),
}


def _labels_by_code(t: OrderTables) -> DataFrame:
    def code(i: int) -> F.Column:
        return reduce(lambda c, kv: c.when(F.col("o_orderpriority") == kv[0], F.lit(kv[1][i])),
                      SHOWN_CODES.items(), F.when(F.lit(False), F.lit("")))

    return t.table("orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")).select(
        "o_orderpriority", X.model_label(code(0)).alias("model_label"),
        X.data_source_label(code(1)).alias("data_source_label"),
        X.feature_set_label(code(2)).alias("feature_set_label"),
        X.int_text(F.col("n")).alias("orders_label"), X.float_text(F.col("top"), 2).alias("top_label"))


def _column_contracts(t: OrderTables) -> DataFrame:
    tables = {
        "silver_calendar": t.calendar, "silver_sell_prices": t.prices, "silver_sales": t.sales,
        "silver_sales_with_prices": t.priced, "silver_weather_daily": t.weather,
        "silver_sales_with_weather": silver.with_weather(t.sales, t.weather),
        "silver_macro_series": t.macro, "silver_macro_daily_aligned": t.macro_aligned,
        "silver_trends_interest": t.trends, "silver_trends_daily_aligned": t.trends_aligned,
        "silver_sales_with_external_features": t.external,
        "gold_training_daily": gold.training_daily(t.priced),
        "gold_training_daily_with_weather": gold.training_daily_with_weather(
            silver.with_weather(t.sales, t.weather)),
        "gold_feature_mart": t.stored_mart,
        "forecast_run_monitoring": monitoring.run_monitoring(t.forecasts),
        "latest_forecast_freshness": t.freshness,
    }
    out = None
    for name, df in tables.items():
        part = contracts.column_contract(df, name)
        out = part if out is None else out.unionByName(part)
    return out


def _labels(t: OrderTables) -> DataFrame:
    return monitoring.run_monitoring(t.forecasts).select(
        "model_version", X.model_label(F.col("model_name")).alias("model_label"),
        X.feature_set_label(F.col("feature_set_name")).alias("feature_set_label"),
        X.timestamp_text(F.col("generated_at")).alias("generated_label"),
        X.int_text(F.col("forecast_row_count")).alias("rows_label"))


def _training_data():
    """The query module of the training-data operators, if they are there at all.

    A missing folder is looked for, not an import error, so a fault inside them shows.
    """
    if all(map(importlib.util.find_spec, ("demandloom.llm", "corpus_pipeline"))):
        return importlib.import_module("demandloom.llm.queries")
    return None


def queries() -> dict[str, Query]:
    more = _training_data()
    return _retail_queries() | (more.queries() if more else {})


def _retail_queries() -> dict[str, Query]:
    key = ("store_id", "item_id", "date")
    q: dict[str, Query] = {
        # Silver
        "silver_calendar": _on(lambda t: t.calendar),
        "silver_sales": _on(lambda t: t.sales),
        "silver_prices": _on(lambda t: t.prices),
        "silver_weather": _on(lambda t: _cols(t.weather, WEATHER_COLUMNS)),
        "silver_trends": _on(lambda t: _cols(t.trends, TRENDS_COLUMNS)),
        "silver_macro_series": _on(lambda t: _cols(t.macro, MACRO_COLUMNS)),
        # reshaping and sources
        "wide_to_long_sales": _on(lambda t: reshape.wide_sales_to_long(t.wide_sales)),
        "wide_to_long_last_90": _on(lambda t: reshape.wide_sales_to_long(t.wide_sales, 90)),
        "flatten_weather_documents": _on(lambda t: _cols(
            silver.weather_daily(reshape.flatten_weather(t.weather_documents)), WEATHER_COLUMNS)),
        "flatten_macro_documents": _on(lambda t: _cols(
            silver.macro_series(reshape.flatten_macro(t.macro_documents)), MACRO_COLUMNS)),
        "normalise_keyword_files": _on(_keyword_files),
        "date_chunks": _on(_date_chunks),
        "weather_stamped": _on(_stamped_weather),
        "sales_date_range": _on(lambda t: silver.sales_date_range(t.sales_raw, t.calendar)),
        "dedup_keep_last": _on(_dedup),
        # landed files and sinks, there and back
        "landed_silver_calendar": _landed("silver_calendar"),
        "landed_silver_prices": _landed("silver_sell_prices"),
        "landed_silver_sales": _landed("silver_sales"),
        "landed_silver_weather": _landed("silver_weather_daily", WEATHER_COLUMNS),
        "landed_silver_macro_series": _landed("silver_macro_series", MACRO_COLUMNS),
        "landed_silver_trends": _landed("silver_trends_interest", TRENDS_COLUMNS),
        "landed_gates": _on(_landed_gates),
        "forecast_table_roundtrip": _on(_table_roundtrip),
        "snapshot_roundtrip": _on(_snapshot_roundtrip),
        "extract_roundtrip": _on(_extract_roundtrip),
        "mart_roundtrip": _on(_mart_roundtrip),
        "extract_manifest": _on(_extract_manifest),
        # alignment and joins
        "asof_macro_daily": _on(lambda t: t.macro_aligned),
        "asof_macro_window": _on(_asof_window),
        "trends_daily_aligned": _on(lambda t: t.trends_aligned),
        "macro_by_day": _on(lambda t: silver.macro_by_day(t.macro_aligned)),
        "external_features": _on(lambda t: t.external),
        "sales_with_prices": _on(lambda t: t.priced),
        "sales_with_weather": _on(lambda t: silver.with_weather(t.sales, t.weather)),
        # Gold
        "gold_feature_mart": _on(lambda t: t.mart),
        "gold_feature_mart_from_parts": _on(
            lambda t: gold.feature_mart_from_parts(t.external, t.priced)),
        "gold_training_daily": _on(lambda t: gold.training_daily(t.priced)),
        "gold_training_with_weather": _on(lambda t: gold.training_daily_with_weather(
            silver.with_weather(t.sales, t.weather))),
        # extracts
        "top_series_subset": _on(lambda t: extract.top_series_subset(t.stored_mart, 20)),
        "training_extract": _on(lambda t: extract.training_extract(t.stored_mart, 100)),
        "training_extract_all_series": _on(lambda t: extract.training_extract(t.stored_mart, None)),
        "series_key_counts": _on(lambda t: t.sales.groupBy(
            X.key_text("store_id", "item_id").alias("series_key")).agg(F.count(F.lit(1)).alias("n"))),
        "series_totals": _on(lambda t: extract.series_totals(t.sales)),
        # features
        "features_lag_rolling": _on(lambda t: _cols(
            t.sales_features, (*key, "sales", *S.LAG_FEATURES, *S.ROLLING_FEATURES))),
        "features_calendar": _on(lambda t: _cols(t.sales_features, (*key, *S.CALENDAR_FEATURES))),
        "features_price": _on(lambda t: _cols(
            t.priced_features, (*key, "sell_price", *reversed(S.PRICE_FEATURES)))),
        "last_n_history": _on(lambda t: _cols(features.last_rows(t.sales), (*key, "sales"))),
        "latest_series_row": _on(lambda t: _cols(features.latest_row(t.sales), (*key, "sales"))),
        # splits, metrics, backtests
        "rolling_splits_summary": _on(lambda t: splits.splits_summary(_modeling(t)), WINDOW),
        "rolling_split_bounds": _on(lambda t: splits.split_bounds(_modeling(t)), WINDOW),
        "hold_out_split": _on(_hold_out),
        "backtest_naive": _backtest_expression(baselines.naive),
        "backtest_seasonal_naive": _backtest_expression(baselines.seasonal_naive),
        "backtest_rolling_mean": _backtest_expression(baselines.rolling_mean),
        "metrics_by_store": _on(_metrics_by_store),
        "metrics_bias": _on(_bias),
        "metrics_rmsse": _on(_rmsse),
        "metrics_wrmsse": _on(_wrmsse),
        "ablation_grid": _on(lambda t: backtest.ablation_grid(t.features), WINDOW),
        "ablation_ranking": _on(
            lambda t: backtest.rank_candidates(backtest.ablation_grid(t.features))),
        "backtest_wrmsse": _on(_backtest_wrmsse, WINDOW),
        "ranking_wrmsse": _on(_ranking_wrmsse),
        "backtest_linear": _on(_backtest_linear, WINDOW),
        "recursive_linear": _on(_recursive_linear),
        "predicted_batch": _on(_predicted_batch),
        "training_run": _on(_training_run, WINDOW),
        "ablation_linear": _on(_linear_grid, WINDOW),
        "ablation_linear_sets": _on(_linear_sets, WINDOW),
        "backtest_gbt": _backtest_model(SMALL_BOOSTING),
        "backtest_random_forest": _backtest_model(SMALL_FOREST),
        "feature_importance": _on(_importance),
        # recursive forecasts and the forecast table
        "recursive_naive": _recursive(baselines.naive),
        "recursive_seasonal_naive": _recursive(baselines.seasonal_naive),
        "recursive_rolling_mean": _recursive(baselines.rolling_mean),
        "recursive_gbt": _on(_recursive_gbt),
        "recursive_leafwise": _on(_recursive_leafwise),
        "ranking_stability": _on(_ranking_stability),
        "backtest_linear_wrmsse": _on(_backtest_linear_wrmsse, WINDOW),
        "forecast_rows": _on(lambda t: t.forecast_runs),
        "forecast_horizon_overwrite": _on(_horizon),
        "forecast_run_monitoring": _on(lambda t: monitoring.run_monitoring(t.forecasts)),
        "forecast_freshness": _on(lambda t: t.freshness),
        "snapshot_recent_rows": _on(lambda t: monitoring.fetch_forecast_rows(t.forecasts, 500)),
        "snapshot_recent_runs": _on(lambda t: monitoring.fetch_run_monitoring(
            monitoring.run_monitoring(t.forecasts), 25)),
        "snapshot_metadata": _on(_snapshot_metadata),
        # audit
        "latest_successful_ingest": _on(lambda t: landing.latest_successful_run(t.ingestion_runs)),
        "audit_latest_state": _on(_audit_state),
        "audit_compacted_state": _on(_compacted_audit),
        # quality and contracts
        "dq_calendar": _on(lambda t: quality.calendar_checks(t.calendar_raw, _day_number())),
        "dq_calendar_faults": _on(
            lambda t: quality.calendar_checks(_dirty_calendar(t), _day_number())),
        "dq_calendar_order": _on(_calendar_order),
        "dq_calendar_file_order": _on(_calendar_file_order),
        "dq_sell_prices": _on(lambda t: quality.sell_price_checks(t.prices_raw)),
        "dq_sell_prices_faults": _on(lambda t: quality.sell_price_checks(_dirty_prices(t))),
        "dq_sales_wide": _on(lambda t: quality.wide_sales_checks(t.wide_sales)),
        "dq_macro": _on(_macro_report),
        "dq_weather": _on(lambda t: quality.weather_document_checks(
            _weather_texts(t), parts=("location_id",))),
        "dq_trends": _on(_trends_report),
        "dq_macro_missing_keys": _on(lambda t: quality.macro_document_checks(
            _keyless_macro_texts(t), parts=("series_id",))),
        "dq_trends_faults": _on(_trends_faults),
        "dq_failing_parts": _on(lambda t: quality.failing_parts(_macro_report(t), "series_id")),
        "dq_gate_verdicts": _on(_gate_verdicts),
        "dq_suite_rollup": _on(lambda t: quality.suite_rollup(_macro_report(t), "series_id")),
        "contract_grain_unique": _on(
            lambda t: contracts.grain_unique(gold.training_daily(t.priced))),
        "contract_duplicate_orders": _on(lambda t: contracts.duplicate_keys(
            t.table("lineitem"), ("l_orderkey", "l_linenumber"))),
        "contract_sales_non_negative": _on(lambda t: _cols(
            contracts.sales_non_negative(t.sales), (*key, "sales"))),
        # The same contracts where they fail: raw lines, weekly prices told apart by
        # return flag, returned units counted as negative.
        "contract_grain_faults": _on(lambda t: contracts.grain_unique(t.lines)),
        "contract_price_key_faults": _on(lambda t: contracts.price_key_unique(_flagged_prices(t))),
        "contract_sales_faults": _on(lambda t: _cols(
            contracts.sales_non_negative(_net_sales(t)), (*key, "sales"))),
        "contract_price_coverage": _on(lambda t: contracts.price_coverage(t.priced, 0.1)),
        "contract_price_key_unique": _on(lambda t: contracts.price_key_unique(t.prices)),
        "contract_columns": _on(_column_contracts),
        # profiles of the mart
        "eda_profile": _on(lambda t: reports.mart_profile(t.sales)),
        "eda_target_profile": _on(lambda t: reports.target_profile(t.sales)),
        "eda_null_profile": _on(lambda t: reports.null_profile(t.mart)),
        "eda_distribution": _on(lambda t: reports.target_distribution(t.sales)),
        "eda_distribution_external": _on(lambda t: order_stats.exact_distribution(
            t.stored_mart, ("sell_price", *S.WEATHER_MEASURES))),
        "sample_exact_rows": _on(_sampled),
        "eda_daily_totals": _on(lambda t: reports.daily_totals(t.sales)),
        "eda_store_sparsity": _on(
            lambda t: reports.store_sparsity(reshape.wide_sales_to_long(t.wide_sales))),
        "eda_series_per_store": _on(lambda t: reports.series_per_store(t.sales)),
        "eda_grain": _on(lambda t: reports.grain_check(t.sales)),
        "eda_correlation": _on(lambda t: reports.target_correlation(t.mart)),
        # dashboard
        "kpi_summary": _on(lambda t: reports.kpi_summary(_latest(t))),
        "forecast_totals_by_date": _on(lambda t: reports.totals_by_date(_latest(t))),
        "trend_direction": _on(lambda t: reports.trend_direction(_latest(t))),
        "daily_trend_dod": _on(lambda t: reports.daily_trend(_latest(t))),
        "top_stores": _on(lambda t: reports.top_by(_latest(t), "store_id", 10)),
        "top_products": _on(lambda t: reports.top_by(_latest(t), "item_id", 20)),
        "store_summary": _on(lambda t: reports.totals_by(_latest(t), "store_id")),
        "product_summary": _on(lambda t: reports.totals_by(_latest(t), "item_id")),
        "forecast_detail": _on(lambda t: reports.forecast_detail(_latest(t))),
        "forecast_filtered": _on(lambda t: reports.filter_forecasts(
            t.forecasts, "2001-10-01", "2001-11-15", ["NATION_1", "NATION_2"])),
        "filter_options": _on(lambda t: reports.filter_options(t.forecasts, "store_id")),
        "forecast_window": _on(lambda t: reports.forecast_window(_latest(t))),
        "display_labels": _on(_labels),
        "display_labels_by_code": _on(_labels_by_code),
        "snapshot_run_ids": _on(_run_ids),
    }
    for name in S.FEATURE_SETS:
        q[f"modeling_dataset_{name}"] = _modeling_query(name)
    return q


def _hold_out(t: OrderTables) -> DataFrame:
    train, test = _first_window(t)
    both = train.select(F.lit("train").alias("part"), "date").unionByName(
        test.select(F.lit("test").alias("part"), "date"))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_day"),
        F.max("date").alias("last_day"))


def _backtest_expression(forecaster: baselines.ExpressionForecaster) -> Query:
    return _on(lambda t: backtest.backtest_expression(_modeling(t), forecaster), WINDOW)


def _modeling_query(name: str) -> Query:
    columns = S.feature_columns(name)
    plain = name in (S.DEFAULT_FEATURE_SET, "baseline_plus_price")
    return lambda spark, sf: _modeling_rows(OrderTables(spark, sf), name, columns, plain)


def _modeling_rows(t: OrderTables, name: str, columns: list[str], plain: bool) -> DataFrame:
    frame = t.priced_features if plain else t.features
    ready = features.complete_cases(frame, name).select(*S.GRAIN, "sales", *columns)
    # Search values are whole numbers in the mart and doubles as features.
    return present(ready)


def oracle_sql() -> dict[str, str]:
    more = _training_data()
    return oracle_queries.build() | (more.oracle_sql() if more else {})

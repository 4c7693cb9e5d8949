import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from demandloom.functions import metrics as M
from demandloom.operators import backtest, baselines, features, splits
from tests.frames import DAY0, SCHEMA, mart_rows

CFG = splits.BacktestConfig(horizon_days=28, n_windows=3)


def days(spark, n):
    rows = [("S", "I", DAY0 + dt.timedelta(days=i), float(i)) for i in range(n)]
    return spark.createDataFrame(
        rows, "store_id string, item_id string, date date, sales double")


def test_split_bounds_of_120_days(spark):
    df = days(spark, 120)
    got = [(r.window, str(r.test_start), str(r.test_end))
           for r in splits.split_bounds(df, CFG).orderBy("window").collect()]
    assert got == [(1, "2024-04-02", "2024-04-29"), (2, "2024-03-05", "2024-04-01"),
                   (3, "2024-02-06", "2024-03-04")]
    rows = splits.splits_summary(df, CFG).orderBy("window").collect()
    assert [(r.train_rows, r.test_rows) for r in rows] == [(92, 28), (64, 28), (36, 28)]
    assert str(rows[0].train_end_date) == "2024-04-01"
    for w, size in ((1, 92), (2, 64), (3, 36)):
        train, test = splits.train_test(df, w, CFG)
        assert (train.count(), test.count()) == (size, 28)
    train, test = splits.hold_out(df)
    assert (train.count(), test.count()) == (92, 28)


def test_expression_backtest_matches_loop(spark):
    rows = mart_rows([("CA_1", "A"), ("TX_1", "B")], 180, lambda i: float((i * 7) % 13 + 1),
                     lambda i: 1.0)
    modeling = features.complete_cases(
        features.build_features(spark.createDataFrame(rows, SCHEMA))).cache()
    data = [(r.date, r.sales, r.lag_7) for r in modeling.collect()]
    newest = max(d for d, *_ in data)
    got = {r.window: r for r in
           backtest.backtest_expression(modeling, baselines.seasonal_naive, CFG).collect()}
    for w in (1, 2, 3):
        end = newest - dt.timedelta(days=(w - 1) * 28)
        start = end - dt.timedelta(days=27)
        test = [(y, p) for d, y, p in data if start <= d <= end]
        train = [d for d, *_ in data if d < start]
        r = got[w]
        assert (r.train_rows, r.test_rows) == (len(train), len(test))
        assert (r.train_start_date, r.train_end_date) == (min(train), max(train))
        assert math.isclose(r.wmape, sum(abs(y - p) for y, p in test) / sum(y for y, _ in test))
        assert math.isclose(r.mae, sum(abs(y - p) for y, p in test) / len(test))
        assert math.isclose(r.rmse, math.sqrt(sum((y - p) ** 2 for y, p in test) / len(test)))


def test_model_backtest_on_a_linear_target(spark):
    df = spark.createDataFrame(
        [(DAY0 + dt.timedelta(days=i), float(i), float(1000 + i % 5), float(i))
         for i in range(180)], "date date, feature_1 double, feature_2 double, sales double")
    out = backtest.backtest_model(
        df, ["feature_1", "feature_2"], lambda: LinearRegression(labelCol="sales"), CFG,
        parallelism=2).orderBy("window").collect()
    assert [(r.train_rows, r.test_rows) for r in out] == [(152, 28), (124, 28), (96, 28)]
    assert all(r.wmape < 1e-6 for r in out)


def test_empty_windows_are_errors(spark):
    df = days(spark, 30).withColumn("lag_7", F.col("sales"))
    with pytest.raises(PySparkException, match="empty training"):
        backtest.backtest_expression(df, baselines.seasonal_naive, CFG).collect()
    with pytest.raises(ValueError, match="empty"):
        backtest.backtest_model(df, ["lag_7"], lambda: LinearRegression(labelCol="sales"), CFG)


def test_wmape_of_zero_actuals_is_an_error(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, p double")
    with pytest.raises(PySparkException, match="WMAPE"):
        df.agg(M.wmape(F.col("y"), F.col("p"))).collect()
    assert df.agg(M.wmape(F.col("y"), F.col("p"), "null")).first()[0] is None


def test_rmsse_and_wrmsse(spark):
    history = spark.createDataFrame(
        [("S", i, DAY0 + dt.timedelta(days=k), v) for i, vs in
         {"A": [1.0, 3.0, 2.0], "B": [4.0, 4.0, 4.0], "C": [5.0]}.items()
         for k, v in enumerate(vs)], "store_id string, item_id string, date date, sales double")
    scored = spark.createDataFrame(
        [("S", i, 2.0, 4.0) for i in "ABC"],
        "store_id string, item_id string, sales double, prediction double")
    got = {r.item_id: r.rmsse for r in
           M.rmsse_by_series(scored, history, on_undefined="null").collect()}
    assert math.isclose(got["A"], math.sqrt(4.0 / 2.5))
    assert got["B"] is None and got["C"] is None
    with pytest.raises(PySparkException, match="RMSSE"):
        M.rmsse_by_series(scored, history).collect()

    values = spark.createDataFrame(
        [("S", "A", 1.0), ("S", "B", 3.0)], "store_id string, item_id string, rmsse double")

    def weights(*w):
        return spark.createDataFrame(
            [("S", i, x) for i, x in w], "store_id string, item_id string, weight double")

    assert M.wrmsse(values, weights(("A", 3.0), ("B", 1.0))).first().wrmsse == 1.5
    for bad, text in (((("A", 1.0),), "one weight per series"),
                      ((("A", 0.0), ("B", 0.0)), "sum to zero"),
                      ((("A", -1.0), ("B", 3.0)), "negative")):
        with pytest.raises(PySparkException, match=text):
            M.wrmsse(values, weights(*bad)).collect()
    with pytest.raises(PySparkException, match="at least one"):
        M.wrmsse(values.limit(0), weights(("A", 1.0)).limit(0)).collect()


def test_ablation_grid_equals_separate_backtests(spark):
    def price(i):
        return None if i < 60 else 2.0

    rows = mart_rows([("CA_1", "A")], 200, lambda i: float(i % 9 + 1), price)
    frame = features.build_features(spark.createDataFrame(rows, SCHEMA))
    # macro is unknown in the newest days, so that set ends earlier
    frame = frame.withColumn("cpi_all_items", F.when(
        F.col("date") < DAY0 + dt.timedelta(days=180), F.col("cpi_all_items"))).cache()
    sets = ("calendar_lag_rolling_baseline", "baseline_plus_macro")
    grid = backtest.ablation_grid(frame, sets, config=CFG).collect()
    assert len(grid) == 2 * 3 * 3
    for name in sets:
        single = {r.window: r for r in backtest.backtest_expression(
            features.complete_cases(frame, name), baselines.rolling_mean, CFG).collect()}
        for r in grid:
            if r.feature_set_name == name and r.model_name == "rolling_mean_7":
                want = single[r.window]
                assert r.test_rows == want.test_rows
                assert math.isclose(r.wmape, want.wmape) and math.isclose(r.rmse, want.rmse)


def test_ranking_applies_the_selection_rules(spark):
    cells = [("fs", m, w, v) for m, vs in {
        "seasonal_naive_lag_7": (0.5, 0.5), "rolling_mean_7": (0.6, 0.4), "good": (0.3, 0.3),
        "shaky": (0.1, 0.8)}.items() for w, v in enumerate(vs, 1)]
    grid = spark.createDataFrame(
        cells, "feature_set_name string, model_name string, window int, wmape double")
    got = {r.model_name: r for r in backtest.rank_candidates(grid).collect()}
    assert got["good"].rank == 1 and got["good"].beats_baselines
    assert got["shaky"].windows_beating_baselines == 1 and not got["shaky"].beats_baselines
    assert math.isclose(got["shaky"].worst_wmape, 0.8)


def test_model_grid_has_one_row_per_cell(spark):
    rows = mart_rows([("CA_1", "A")], 130, lambda i: float(i % 9 + 1), lambda i: 2.0)
    frame = features.build_features(spark.createDataFrame(rows, SCHEMA)).cache()
    sets = ("calendar_lag_rolling_baseline", "baseline_plus_price")
    grid = backtest.ablation_with_models(
        frame, {"linear": lambda: LinearRegression(labelCol="sales")}, sets,
        splits.BacktestConfig(horizon_days=14, n_windows=2))
    assert {(r.feature_set_name, r.model_name, r.window, r.test_rows) for r in grid.collect()} == {
        (s, "linear", w, 14) for s in sets for w in (1, 2)}
    assert backtest.rank_candidates(grid).count() == 2

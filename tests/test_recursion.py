import datetime as dt

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators import baselines, features, recursion
from demandloom.operators.backtest import assembled
from tests.frames import SCHEMA, feature_row, mart_rows, random_series, same

FOUR = [(s, i) for s in ("CA_1", "TX_1") for i in ("ITEM_1", "ITEM_2")]


def test_seasonal_naive_repeats_the_week(spark):
    rows = mart_rows(FOUR, 90, lambda i: float(i % 7 + 10), lambda i: 2.5)
    out = recursion.forecast_expression(
        spark.createDataFrame(rows, SCHEMA), baselines.seasonal_naive, horizon=7).collect()
    assert len(out) == 28
    assert {str(r.forecast_date) for r in out} == {
        str(dt.date(2024, 3, 31) + dt.timedelta(days=k)) for k in range(7)}
    for r in out:
        assert r.prediction == (90 + r.forecast_step - 1) % 7 + 10


def loop(rows, model, horizon):
    """Day by day with the row-by-row features, last 60 rows as history."""
    rows, out = list(rows[-60:]), []
    last_price = rows[-1][2]
    for _ in range(horizon):
        day = rows[-1][0] + dt.timedelta(days=1)
        rows.append((day, None, last_price))
        value = model(feature_row(rows, len(rows) - 1))
        rows[-1] = (day, value, last_price)
        out.append((day, value))
    return out


@pytest.fixture(scope="module")
def uneven(spark):
    """Series of different length and last day, with gaps and missing prices."""
    series = {f"I{k}": random_series(k, n, null_price=p)
              for k, (n, p) in enumerate([(90, 0.5), (61, 0.9), (12, 0.3), (3, 1.0), (40, 0.0)])}
    rows = [("S_1", item, *r) for item, part in series.items() for r in part]
    df = spark.createDataFrame(
        rows, "store_id string, item_id string, date date, sales double, sell_price double")
    return series, df


def blend(f):
    return f["lag_1"] * 0.5 + f["lag_7"] * 0.3 + f["sell_price_filled"] * 0.1 + f[
        "day_of_week"] * 0.01 + f["sell_price_missing_flag"]


@pytest.mark.parametrize("name", ["rolling_mean_7", "blend"])
def test_matches_day_by_day_loop(uneven, name):
    series, df = uneven
    column_model = blend if name == "blend" else baselines.rolling_mean

    def plain(f):
        if name == "blend":
            return None if f["lag_1"] is None or f["lag_7"] is None else blend(f)
        return f["rolling_mean_7"]

    got = {(r.item_id, r.forecast_date): r.prediction
           for r in recursion.forecast_expression(df, column_model, 28).collect()}
    assert len(got) == 28 * len(series)
    for item, part in series.items():
        for day, value in loop(part, plain, 28):
            assert same(got[(item, day)], value), (item, day)


def test_no_exchange_after_the_state(uneven):
    _, df = uneven
    plan = recursion.forecast_expression(df, baselines.rolling_mean, 28)
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert text.count("Exchange hashpartitioning") == 1


def test_model_recursion(spark):
    rows = mart_rows(FOUR, 90, lambda i: float((i * i) % 11 + 3), lambda i: 2.5 if i % 3 else None)
    df = spark.createDataFrame(rows, SCHEMA)
    columns = S.feature_columns("full_feature_set")
    train = features.complete_cases(features.build_features(df), "full_feature_set")
    model = assembled(DecisionTreeRegressor(labelCol="sales", maxDepth=4), columns).fit(train)

    def rows_of(every):
        out = recursion.forecast_model(df, model, columns, 9, checkpoint_every=every)
        return sorted(tuple(r) for r in out.select(*recursion.FORECAST_COLUMNS).collect())

    weekly, each = rows_of(7), rows_of(1)
    assert len(weekly) == 36 and weekly == each

    # one series, step by step through build_features
    one = [r for r in rows if r[4] == "CA_1" and r[1] == "ITEM_1"][-60:]
    want = []
    for _ in range(9):
        nxt = list(one[-1])
        nxt[7] = one[-1][7] + dt.timedelta(days=1)
        nxt[9] = None
        frame = features.build_features(spark.createDataFrame([*one, tuple(nxt)], SCHEMA))
        value = model.transform(frame.where(F.col("date") == nxt[7])).first().prediction
        nxt[9] = value
        one.append(tuple(nxt))
        want.append(value)
    got = [r[4] for r in weekly if r[:2] == ("CA_1", "ITEM_1")]
    assert all(same(a, b) for a, b in zip(got, want))


def test_short_series_are_still_scored(spark):
    rows = mart_rows([("CA_1", "LONG")], 90, float, lambda i: 1.0)
    df = spark.createDataFrame(rows, SCHEMA)
    columns = S.feature_columns()
    train = features.complete_cases(features.build_features(df))
    model = assembled(DecisionTreeRegressor(labelCol="sales"), columns).fit(train)
    short = spark.createDataFrame(mart_rows([("CA_1", "NEW")], 5, float, lambda i: 1.0), SCHEMA)
    out = recursion.forecast_model(df.unionByName(short), model, columns, 3)
    assert out.where("item_id = 'NEW' and prediction is not null").count() == 3


def test_run_metadata_follows_the_table_contract(uneven):
    _, df = uneven
    out = recursion.with_run_metadata(
        recursion.forecast_expression(df, baselines.naive, 2), "m", "7", "fs",
        dt.datetime(2024, 1, 1))
    assert out.columns == S.FORECAST_TABLE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in S.FORECAST_TABLE]

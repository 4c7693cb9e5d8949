import datetime as dt

import pytest

from demandloom import schemas as S
from demandloom.operators import features
from tests.frames import SCHEMA, feature_row, mart_rows, random_series, same

PRICES = [None, None, 2.5, 2.5, None]


@pytest.fixture(scope="module")
def forty_days(spark):
    rows = mart_rows([("CA_1", "ITEM_1")], 40, float, lambda i: PRICES[i % 5])
    return features.build_features(spark.createDataFrame(rows, SCHEMA)).cache()


def test_closed_form_lags_and_means(forty_days):
    for i, r in enumerate(forty_days.orderBy("date").collect()):
        assert r.lag_1 == (i - 1 if i >= 1 else None)
        assert r.lag_7 == (i - 7 if i >= 7 else None)
        assert r.lag_28 == (i - 28 if i >= 28 else None)
        assert r.rolling_mean_7 == (i - 4 if i >= 7 else None)
        assert same(r.rolling_mean_28, i - 14.5 if i >= 28 else None)
        assert r.sell_price_filled == 2.5


def test_complete_cases_and_price_flag(forty_days):
    assert features.complete_cases(forty_days).count() == 12
    assert features.complete_cases(forty_days, "full_feature_set").count() == 12
    assert forty_days.where("sell_price_missing_flag = 1").count() == 24
    counted = forty_days.where(features.is_complete(forty_days, "full_feature_set")).count()
    assert counted == 12


def test_all_input_columns_survive(forty_days):
    assert set(S.MART_COLUMNS) <= set(forty_days.columns)


def test_matches_row_by_row_reference(spark):
    """Gaps in dates, missing prices, short series: rows count, not days."""
    series = {("S_1", f"I{k}"): random_series(k, n, null_price=p)
              for k, (n, p) in enumerate([(80, 0.5), (27, 0.9), (1, 0.0), (40, 1.0), (29, 0.2)])}
    rows = [(store, item, *r) for (store, item), part in series.items() for r in part]
    df = spark.createDataFrame(
        rows, "store_id string, item_id string, date date, sales double, sell_price double")
    got = {(r.item_id, r.date): r for r in features.build_features(df).collect()}
    for (_, item), part in series.items():
        for i in range(len(part)):
            want, row = feature_row(part, i), got[(item, part[i][0])]
            for name, value in want.items():
                assert same(row[name], value), (item, i, name, row[name], value)


def test_text_inputs_are_coerced_and_nan_is_missing(spark):
    df = spark.createDataFrame(
        [("S", "I", dt.date(2024, 1, 1), 1.0, "abc", "7.5"),
         ("S", "I", dt.date(2024, 1, 2), 2.0, "NaN", "x"),
         ("S", "I", dt.date(2024, 1, 3), 2.0, "3.5", None)],
        "store_id string, item_id string, date date, sales double, sell_price string, "
        "cpi_all_items string")
    rows = features.build_features(df).orderBy("date").collect()
    assert [r.cpi_all_items for r in rows] == [7.5, None, None]
    assert [r.sell_price_missing_flag for r in rows] == [1, 1, 0]
    assert [r.sell_price_filled for r in rows] == [3.5, 3.5, 3.5]


def test_one_exchange_serves_all_windows(spark):
    df = spark.createDataFrame(
        mart_rows([("A_1", "I")], 3, float, lambda i: 1.0), SCHEMA)
    plan = features.build_features(df)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") == 1
    assert initial.count("Sort [") == 1
    assert "SinglePartition" not in initial


def test_unknown_set_and_missing_column(spark):
    with pytest.raises(ValueError, match="unknown feature set"):
        S.feature_columns("nope")
    df = spark.createDataFrame([("S", "I", 1.0)], "store_id string, item_id string, sales double")
    with pytest.raises(ValueError, match="date"):
        features.build_features(df)


def test_last_rows_and_latest_row(spark):
    rows = mart_rows([("CA_1", "A"), ("CA_1", "B")], 90, float, lambda i: 1.0)
    df = spark.createDataFrame(rows, SCHEMA)
    tail = features.last_rows(df, 60)
    assert tail.count() == 120 and tail.agg({"sales": "min"}).first()[0] == 30.0
    last = features.latest_row(df)
    assert last.columns == df.columns and {r.sales for r in last.collect()} == {89.0}

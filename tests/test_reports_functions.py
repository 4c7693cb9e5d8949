import datetime as dt
import math

from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions import scalar as X
from demandloom.operators import monitoring, reports, reshape
from tests.frames import SCHEMA, mart_rows

D = [dt.date(2024, 6, n) for n in (1, 2, 4)]


def forecasts(spark, rows):
    return spark.createDataFrame(
        rows, "forecast_date date, store_id string, item_id string, prediction double")


def sample(spark):
    return forecasts(spark, [(D[0], "A", "x", 1.005), (D[0], "B", "y", 2.0), (D[1], "A", "x", 4.0),
                             (D[2], "A", "y", 2.5)])


def test_kpis(spark):
    r = reports.kpi_summary(sample(spark)).first()
    assert math.isclose(r.total_forecast, 9.505) and (r.store_count, r.product_count) == (2, 2)
    assert math.isclose(r.average_daily_forecast, 9.505 / 3)
    assert tuple(reports.kpi_summary(sample(spark).limit(0)).first()) == (0.0, 0.0, 0, 0)


def test_trend(spark):
    df = sample(spark)
    rows = reports.daily_trend(df).orderBy("forecast_date").collect()
    assert [r.day_over_day_change for r in rows] == [None, 0.99, -1.5]
    assert reports.trend_direction(df).first().direction == "softens"
    assert reports.trend_direction(df.where(F.col("forecast_date") < D[2])).first().direction == "rises"
    same = forecasts(spark, [(D[0], "A", "x", 1.0), (D[1], "A", "x", 1.0)])
    assert reports.trend_direction(same).first().direction == "stable"
    assert reports.trend_direction(df.where(F.col("forecast_date") == D[0])).first().direction is None


def test_rankings_and_filters(spark):
    df = sample(spark)
    assert [r.store_id for r in reports.top_by(df, "store_id", 1).collect()] == ["A"]
    assert [(r.item_id, r.forecast_demand) for r in reports.totals_by(df, "item_id").collect()][1] == (
        "y", 4.5)
    assert reports.filter_forecasts(df).count() == 4
    assert reports.filter_forecasts(df, D[0], D[1], ["A"]).count() == 2
    assert reports.filter_forecasts(df, items=["y"]).count() == 2
    assert [r.value for r in reports.filter_options(df, "store_id").collect()] == ["A", "B"]
    assert reports.forecast_window(df).first().label == "Forecast window: 01 Jun 2024 to 04 Jun 2024"
    assert reports.forecast_window(df.limit(0)).first().label == "No forecast window available"


def test_profiles(spark):
    rows = mart_rows([("CA_1", "A"), ("TX_1", "B")], 50, lambda i: float(i % 10), lambda i: None)
    mart = spark.createDataFrame(rows, SCHEMA).withColumn("sales", F.col("sales").cast("int"))
    p = reports.mart_profile(mart).first()
    assert (p.row_count, p.series_count, p.item_count, p.state_count) == (100, 2, 2, 2)
    approx = reports.mart_profile(mart, exact=False).first()
    assert approx.series_count == 2 and approx.row_count == 100
    d = reports.target_distribution(mart).first()
    assert d.median_sales == 4.5 and math.isclose(d.p90_sales, 8.1 if d.p90_sales < 8.5 else 9.0)
    s = {r.store_id: r for r in reports.store_sparsity(mart).collect()}
    assert s["CA_1"].zero_sales_rows == 5 and s["CA_1"].zero_sales_pct == 10.0
    n = reports.null_profile(mart).first()
    assert n.null_sell_price == 100 and n.null_trends_walmart == 0
    c = [r.feature for r in reports.target_correlation(mart, ("sell_price",)).collect()]
    assert c == ["sell_price"]
    chosen = {(r.store_id, r.item_id) for r in reports.sample_rows(mart, 2).collect()}
    again = {(r.store_id, r.item_id) for r in reports.sample_rows(mart.orderBy(F.rand()), 2).collect()}
    assert chosen == again and reports.sample_rows(mart, 1).count() == 100
    assert reports.target_profile(mart).first().zero_sales_rows == 10


def test_monitoring_and_tiebreaks(spark):
    at = [dt.datetime(2024, 6, n) for n in (1, 2)]
    rows = [(D[i % 3], 1, "S", f"I{i % 2}", 1.0, "m", "1", "fs", at[i % 2]) for i in range(6)]
    df = spark.createDataFrame(rows, S.FORECAST_TABLE)
    got = monitoring.fetch_run_monitoring(monitoring.run_monitoring(df), 1).collect()
    assert len(got) == 1 and got[0].generated_at == at[1] and got[0].forecast_series_count == 1
    fresh = monitoring.fetch_freshness(monitoring.latest_freshness(df)).first()
    assert fresh.forecast_horizon_days == 4
    rows = monitoring.fetch_forecast_rows(df, 4).collect()
    assert [r.generated_at for r in rows] == [at[1]] * 3 + [at[0]]
    assert [r.forecast_date for r in rows[:3]] == D


def test_display_text(spark):
    df = spark.createDataFrame(
        [(1234567.8, "2024-01-31T04:05:00Z", " random_forest "), (-2.9, "soon", "?"),
         (None, "", None)], "n double, at string, m string")
    got = df.select(
        X.int_text(F.col("n")).alias("i"), X.float_text(F.col("n")).alias("f"),
        X.timestamp_text(F.col("at")).alias("t"), X.model_label(F.col("m")).alias("m"),
        X.feature_set_label(F.col("m")).alias("s"),
        X.data_source_label(F.lit("cache")).alias("d")).collect()
    assert [r.i for r in got] == ["1,234,567", "-2", "—"]
    assert [r.f for r in got] == ["1,234,567.8", "-2.9", "—"]
    assert [r.t for r in got] == ["31 Jan 2024, 04:05 UTC", "soon", "—"]
    assert [r.m for r in got] == ["Benchmark demand model"] + ["Demand forecasting model"] * 2
    assert {r.d for r in got} == {"Cached snapshot"}
    ts = spark.sql("select timestamp'2024-01-31 04:05:06' at")
    assert ts.select(X.run_id_text(F.col("at"))).first()[0] == "20240131T040506Z"
    key = spark.sql("select 'a' x, cast(null as string) y, 'b' z")
    assert tuple(key.select(X.key_text("x", "z"), X.key_text("x", "y")).first()) == ("a|b", None)


def test_stamping(spark):
    df = spark.createDataFrame([("UNRATE", 1.0), ("???", 2.0)], "series_id string, value double")
    got = {r.series_id: r for r in reshape.stamp_from_registry(
        reshape.stamp(df, {"provider": "fred"}), S.macro_registry(spark), "series_id").collect()}
    assert got["UNRATE"].feature_name == "unemployment_rate" and got["UNRATE"].provider == "fred"
    assert got["???"].label is None
    assert S.weather_registry(spark).count() == 3 and S.trends_registry(spark).count() == 4

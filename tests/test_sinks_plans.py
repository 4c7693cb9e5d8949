import datetime as dt
import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators import audit, baselines, extract, models, quality, recursion
from demandloom.plans import prediction, refresh, training
from demandloom.session import shared_dir
from demandloom.sinks import snapshots as publish
from demandloom.sinks import tables
from demandloom.sinks.forecasts import ForecastTable, overwrite_horizon
from demandloom.sources import landing, snapshots
from tests import landed
from tests.frames import SCHEMA, mart_rows

AT = dt.datetime(2024, 6, 1, 4, 0)


def batch(spark, days, value, version="1", item="A"):
    rows = [(d, i + 1, "S", item, value, "m", version, "fs", AT) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, S.FORECAST_TABLE)


def span(first, n, step=1):
    return [dt.date(2024, 6, first) + dt.timedelta(days=i * step) for i in range(n)]


def content(df):
    return sorted((str(r.forecast_date), r.item_id, r.prediction) for r in df.collect())


def test_horizon_overwrite_removes_the_closed_interval(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "forecasts"))
    assert table.read().count() == 0
    first = batch(spark, span(1, 10), 1.0)
    table.overwrite(first)
    # every other day of 3..9, another series: all of 3..9 goes
    second = batch(spark, span(3, 4, 2), 2.0, "2", "B")
    want = content(overwrite_horizon(first, second))
    table.overwrite(second)
    assert content(table.read()) == want
    assert [w[0][-2:] for w in want] == ["01", "02", "03", "05", "07", "09", "10"]
    table.overwrite(second)  # idempotent
    assert content(table.read()) == want
    assert table.read().columns == S.FORECAST_TABLE.names


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "forecasts"))
    table.overwrite(batch(spark, span(1, 4), 1.0))
    first_day = f"{tmp_path}/forecasts/data/batch=*/forecast_date=2024-06-01/*.parquet"
    before = set(glob.glob(first_day))
    table.overwrite(batch(spark, span(3, 2), 5.0))
    assert before and before == set(glob.glob(first_day))


def test_undated_rows_stop_the_overwrite_before_any_change(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "forecasts"))
    days = [dt.date(2024, 1, n) for n in range(1, 11)]
    full = [(d, 1, "S", "I", 1.0, "m", "1", "f", dt.datetime(2024, 1, 1)) for d in days]
    table.overwrite(spark.createDataFrame(full, S.FORECAST_TABLE))
    bad = [(days[2], 1, "S", "I", 2.0, "m", "2", "f", dt.datetime(2024, 1, 2)),
           (None, 2, "S", "I", 2.0, "m", "2", "f", dt.datetime(2024, 1, 2))]
    with pytest.raises(Exception, match="no forecast_date"):
        table.overwrite(spark.createDataFrame(bad, S.FORECAST_TABLE))
    assert table.read().count() == 10 and {r.prediction for r in table.read().collect()} == {1.0}
    for _ in range(2):  # the same batch twice
        table.overwrite(spark.createDataFrame(bad[:1], S.FORECAST_TABLE))
        assert sorted(r.prediction for r in table.read().collect()) == [1.0] * 9 + [2.0]


def test_empty_batch_is_an_error(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "forecasts"))
    with pytest.raises(ValueError, match="empty"):
        table.overwrite(batch(spark, [], 1.0))
    with pytest.raises(ValueError, match="lack columns"):
        table.overwrite(spark.range(1))


def test_extract_files(spark, tmp_path):
    rows = mart_rows([("CA_1", i) for i in "ABCD"], 100, float, lambda i: 1.0)
    df = spark.createDataFrame(rows, SCHEMA)
    back = tables.write_extract(df, str(tmp_path / "x"), rows_per_file=50)
    assert back.count() == 400
    assert all(spark.read.parquet(p).count() <= 50 for p in glob.glob(f"{tmp_path}/x/*.parquet"))
    tables.write_long_csv(df.select("id", "d", "sales"), str(tmp_path / "csv"))
    assert glob.glob(f"{tmp_path}/csv/*.csv.gz")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 400
    with pytest.raises(Exception):
        landing.read_extract(spark, str(tmp_path / "none"))


def test_extract_bounds_then_ranks(spark):
    # B sold most long ago, A sold most recently
    def rows(item, sales):
        return mart_rows([("CA_1", item)], 400, sales, lambda i: 1.0)

    df = spark.createDataFrame(
        rows("A", lambda i: 2.0) + rows("B", lambda i: 1000.0 if i < 30 else 1.0)
        + rows("C", lambda i: 0.5), SCHEMA)
    recent = extract.training_extract(df, 1, 365)
    assert recent.select("item_id").distinct().first()[0] == "A" and recent.count() == 365
    full = extract.training_extract(df, 1, None)
    assert full.select("item_id").distinct().first()[0] == "B" and full.count() == 400
    assert extract.training_extract(df, None, 10).count() == 30
    tie = spark.createDataFrame(rows("Z", lambda i: 1.0) + rows("Y", lambda i: 1.0), SCHEMA)
    assert extract.top_series(tie, 1).first().item_id == "Y"


def test_bucketed_table_needs_no_exchange_for_series_windows(spark, tmp_path):
    from demandloom.operators import features
    rows = mart_rows([("CA_1", i) for i in "ABCD"], 30, float, lambda i: 1.0)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS buckets LOCATION '{tmp_path}/db'")
    df = tables.refresh_table(spark.createDataFrame(rows, SCHEMA), "buckets.mart", buckets=4)
    plan = features.build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Initial Plan")[-1]
    assert features.build_features(df).count() == 120


def test_publish_and_read_back(spark, tmp_path):
    root, cache = str(tmp_path / "snap"), str(tmp_path / "cache")
    forecasts = batch(spark, span(1, 5), 2.0).unionByName(batch(spark, span(1, 5), 3.0, item="B"))
    prediction.export_snapshot(forecasts, root, "20240601T040000Z", cache)
    base = publish.latest_path(root, spark)
    fresh, label = snapshots.read_with_fallback(
        spark, f"{base}/{publish.FRESHNESS}", cache, snapshots.FRESHNESS_SCHEMA)
    row = fresh.first()
    assert label == "latest" and row.forecast_horizon_days == 5
    assert (row.forecast_row_count, row.forecast_series_count) == (10, 2)
    meta, label = snapshots.read_snapshot_metadata(spark, f"{base}/{publish.METADATA}")
    m = meta.first()
    assert label == "latest" and m.snapshot_run_id == "20240601T040000Z"
    assert (m.forecast_row_count, m.monitoring_row_count) == (10, 1)
    assert spark.read.parquet(f"{publish.history_path(root, '20240601T040000Z')}"
                              f"/{publish.ROWS}").count() == 10
    assert spark.read.parquet(f"{cache}/{publish.ROWS}").count() == 10


def test_snapshot_metadata_without_a_fresh_batch(spark):
    from demandloom.operators import monitoring
    none = batch(spark, [], 1.0)
    rows = batch(spark, span(1, 3), 1.0)
    m = monitoring.snapshot_metadata(
        monitoring.latest_freshness(none), monitoring.run_monitoring(none), rows, "r").first()
    assert (m.forecast_row_count, m.model_name, m.monitoring_row_count) == (3, None, 0)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    landed.write(f"{root}/landing")
    log = audit.QualityLog(spark, f"{root}/audit")
    files = refresh.Landed(f"{root}/landing", landed.DAY)
    built = refresh.run_refresh(spark, files, f"{root}/tables", log, last_days=None)
    return root, built, log, files


def test_refresh_end_to_end(lake):
    _, built, log, _ = lake
    assert {r.status for r in log.state().collect()} == {"PASSED"} and log.state().count() == 6
    mart = built["gold_feature_mart"]
    assert mart.columns == list(S.MART_COLUMNS) and mart.count() == 4 * 150
    row = mart.where("store_id = 'CA_1' and item_id = 'A' and date = date'2024-02-10'").first()
    assert row.wm_yr_wk == 11106 and float(row.sell_price) == 4.5
    assert row.temperature_2m_max == 20.5 and float(row.cpi_all_items) == 1.25  # February is '.'
    assert row.trends_walmart == 40
    missing = mart.where("sell_price is null").select("wm_yr_wk").distinct().collect()
    assert [r.wm_yr_wk for r in missing] == [11103]
    assert built["silver_macro_daily_aligned"].count() == 4 * 150


def test_stored_dimensions_are_broadcast_by_size(lake):
    """No hints: the stored dimensions are small, so Spark broadcasts them."""
    _, built, _, _ = lake
    mart = refresh.build_gold(built)["gold_feature_mart"]
    plan = mart._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_recent_extract_prunes_days_of_the_stored_mart(lake):
    _, built, _, _ = lake
    mart = built["gold_feature_mart"]
    recent = extract.recent(mart, 10)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "date_sub" in plan
    assert recent.count() == 4 * 10


def test_failing_gate_stops_the_refresh(spark, tmp_path):
    landed.write(f"{tmp_path}/landing", days=20)
    path = landing.landing_path(f"{tmp_path}/landing", "retail_sales", landed.DAY, "sell_prices.csv")
    with open(path, "a") as f:
        f.write("CA_1,A,11101,0\n")
    log = audit.QualityLog(spark, f"{tmp_path}/audit")
    with pytest.raises(quality.DataQualityError, match="sell_prices"):
        refresh.run_refresh(spark, refresh.Landed(f"{tmp_path}/landing", landed.DAY),
                            f"{tmp_path}/tables", log)
    assert not os.path.exists(f"{tmp_path}/tables")
    assert {r.dataset_name: r.status for r in log.state().collect()} == {
        "calendar": "PASSED", "sell_prices": "FAILED"}


def test_broken_contract_is_an_error(lake):
    _, built, _, _ = lake
    doubled = {**built, "gold_training_daily": built["gold_training_daily"].unionByName(
        built["gold_training_daily"].limit(1))}
    with pytest.raises(quality.DataQualityError, match="grain"):
        refresh.check_contracts(doubled)


def test_train_predict_publish(spark, lake):
    root, built, _, _ = lake
    data = tables.write_extract(
        extract.training_extract(built["gold_feature_mart"]), f"{root}/extract")
    tiny = models.TreeConfig("tiny", trees=3, max_depth=3, learning_rate=0.3, n_windows=2)
    run = training.train(spark, data, tiny, f"{root}/models")
    assert run.version == "1" and run.windows.count() == 2
    assert run.metrics.first().modeling_rows == 4 * (150 - 28)
    assert run.importance.count() == 9
    assert {r["name"] for r in run.params.collect()} >= {"trees", "seed", "feature_columns"}
    for _ in range(10):  # version 10 beats 9 as a number, not as text
        version = models.save_model(run.model, f"{root}/models", "tiny")
    assert version == "11"
    table = ForecastTable(spark, f"{root}/forecasts")
    config = prediction.PredictionConfig(horizon=7, checkpoint_every=3)
    assert prediction.predict(spark, data, f"{root}/models", "tiny", table, AT, config) == "11"
    once = content(table.read())
    assert len(once) == 4 * 7 and once[0][0] == "2024-05-30"
    prediction.predict(spark, data, f"{root}/models", "tiny", table, AT, config)
    assert content(table.read()) == once
    with pytest.raises(LookupError):
        models.load_latest_model(spark, f"{root}/models", "other")


def test_estimator_settings():
    gbt = models.estimator_factory(models.GRADIENT_BOOSTING)()
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSeed()) == (
        500, 6, 0.05, 42)
    forest = models.estimator_factory(models.RANDOM_FOREST)()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (200, 10, 42)


def fake_session(folder, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_checkpoint_folder_comes_from_the_session(spark):
    assert shared_dir(fake_session("hdfs://x/cp", "yarn")) == "hdfs://x/cp"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session(None, "spark://host:7077"))
    assert shared_dir(spark) == shared_dir(spark)  # local: one own folder


def test_forecast_of_a_stored_extract(spark, lake):
    _, built, _, _ = lake
    out = recursion.forecast_expression(built["gold_feature_mart"], baselines.naive, 3)
    assert out.count() == 12 and out.where(F.col("prediction").isNull()).count() == 0

"""Registered queries against their SQL on the smallest tables.

A spread of queries runs by default; ALL_QUERIES=1 runs every one.
"""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracle_queries
from tools_check import rows

ROOT = "/root/testdata/sf0.001"
SPREAD = (
    "silver_macro_series", "wide_to_long_last_90", "asof_macro_daily", "gold_feature_mart",
    "training_extract", "features_price", "modeling_dataset_full_feature_set",
    "rolling_splits_summary", "metrics_rmsse", "ablation_ranking", "recursive_rolling_mean",
    "forecast_horizon_overwrite", "dq_calendar_faults", "dq_suite_rollup", "dq_weather",
    "eda_distribution", "daily_trend_dod", "audit_latest_state", "backtest_linear", "backtest_wrmsse",
    "ranking_wrmsse", "recursive_linear", "contract_columns", "contract_grain_faults", "contract_sales_faults",
    "contract_price_key_faults", "dq_sales_wide", "eda_store_sparsity", "eda_profile", "landed_gates",
    "landed_silver_sales", "forecast_table_roundtrip", "snapshot_roundtrip", "metrics_wrmsse",
    "extract_manifest", "predicted_batch", "ablation_linear", "audit_compacted_state",
    "dq_macro_missing_keys", "dq_trends_faults", "dq_failing_parts", "dq_gate_verdicts", "weather_stamped",
    "training_run", "display_labels_by_code", "snapshot_run_ids",
    "dq_calendar_file_order", "eda_distribution_external", "sample_exact_rows",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{ROOT}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def chosen():
    every = oracle_queries.build()
    return sorted(every) if os.environ.get("ALL_QUERIES") else SPREAD


@pytest.mark.parametrize("name", chosen())
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, ROOT)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cur.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry._retail_queries()) - set(oracle_queries.build()) == {
        "backtest_gbt", "backtest_random_forest", "feature_importance", "recursive_gbt", "ablation_linear_sets"}


def test_entry_is_the_mart(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 23 and df.limit(1).count() == 1

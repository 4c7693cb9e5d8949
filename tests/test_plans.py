"""Plans of registered queries: what they must not scan, join or expand."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as entry
from demandloom.operators import splits
from demandloom.sources.order_tables import OrderTables

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["eda_distribution", "features_lag_rolling", "recursive_naive", "eda_grain"])
def test_sales_queries_join_no_prices(spark, name):
    text = plan(entry.queries()[name](spark, ROOT))
    assert "sell_price" not in text.split("== Physical Plan ==")[-1].split("Output")[0] or "prices" not in text
    assert "cents" not in text and "lineitem" not in text


def test_the_mart_reads_the_lines_through_one_stored_aggregate(spark):
    text = plan(OrderTables(spark, ROOT).mart)
    assert "lineitem" not in text and "staged-daily" in text


def test_profile_expands_series_only(spark):
    text = plan(entry.queries()["eda_profile"](spark, ROOT))
    tree = text.split("(1) ")[0]
    assert tree.index("Expand") < tree.rindex("HashAggregate")  # the fact is below an aggregate first


def test_window_bounds_reach_the_scan(spark):
    frame = entry._modeling(OrderTables(spark, ROOT))
    for part in splits.train_test(frame, 2):
        scan = plan(part.select("date", "sales"))
        assert "PushedFilters" in scan and "date" in scan.split("PushedFilters")[1][:400]

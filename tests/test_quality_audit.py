import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from demandloom.operators import audit, contracts, quality
from demandloom.operators.quality import SUITES

NAMES = quality.WEEKDAYS


def calendar(spark, n=20, **change):
    rows = []
    for i in range(n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        row = {"d": f"d_{i}", "date": day.isoformat(), "wm_yr_wk": "1", "weekday": NAMES[i % 7],
               "o": i}
        for column, values in change.items():
            if i in values:
                row[column] = values[i]
        rows.append(tuple(row.values()))
    return spark.createDataFrame(
        rows, "d string, date string, wm_yr_wk string, weekday string, o int")


def check(spark, **change):
    return quality.calendar_checks(calendar(spark, **change), F.col("o")).first()


def test_calendar_rules(spark):
    ok = check(spark)
    assert ok.passed and ok.pk_unique and ok.date_monotonic_non_decreasing and ok.rows == 20
    assert not check(spark, d={3: None}).passed
    assert check(spark, d={3: None}).pk_unique  # one null is a value of its own
    assert not check(spark, d={3: None, 4: None}).pk_unique
    assert not check(spark, d={3: "d_4"}).pk_unique
    bad = check(spark, date={3: "2024-13-45"})
    assert bad.date_parse_failures == 1 and bad.date_monotonic_non_decreasing is None
    assert not bad.passed
    back = check(spark, date={5: "2023-12-31"})
    assert back.date_monotonic_non_decreasing is False and not back.passed
    assert check(spark, date={5: "2024-01-05"}).passed  # equal neighbours are fine
    assert check(spark, weekday={2: "monday", 4: None}).weekday_invalid_count == 2
    assert check(spark, wm_yr_wk={2: None}).wm_yr_wk_nulls == 1


def test_calendar_missing_columns(spark):
    df = calendar(spark)
    no_key = quality.calendar_checks(df.drop("d")).first()
    assert no_key.missing_required_columns == ["d"] and no_key.pk_nulls is None
    assert no_key.pk_unique is False and not no_key.passed
    optional = quality.calendar_checks(df.drop("weekday")).first()
    assert optional.weekday_invalid_count is None and not optional.passed
    assert optional.missing_required_columns == ["weekday"]


def test_order_check_across_partitions(spark):
    up = spark.range(0, 1000, 1, 7).select(F.col("id").alias("v"))
    assert spark.range(1).select(quality.non_decreasing(up, F.col("v"))).first()[0]
    down = up.withColumn("v", F.when(F.col("v") == 700, 3).otherwise(F.col("v")))
    assert not spark.range(1).select(quality.non_decreasing(down, F.col("v"))).first()[0]
    # a drop exactly at a partition border
    border = spark.range(0, 8, 1, 2).select(F.when(F.col("id") < 4, 9).otherwise(1).alias("v"))
    assert not spark.range(1).select(quality.non_decreasing(border, F.col("v"))).first()[0]


def test_sell_price_rules(spark):
    schema = "store_id string, item_id string, wm_yr_wk string, sell_price string"

    def run(*rows):
        return quality.sell_price_checks(spark.createDataFrame(list(rows), schema)).first()

    assert run(("S", "I", "1", "2.5"), ("S", "I", "2", "2")).passed
    assert not run(("S", "I", "1", "2.5"), ("S", "I", "1", "2")).pk_unique
    assert run(("S", None, "1", "2.5")).pk_any_nulls == 1
    assert run(("S", "I", "1", "abc")).sell_price_non_numeric == 1
    assert run(("S", "I", "1", "NaN")).sell_price_non_numeric == 1
    r = run(("S", "I", "1", "0"), ("S", "I", "2", None))
    assert (r.sell_price_non_positive, r.sell_price_nulls) == (1, 1) and not r.passed
    df = spark.createDataFrame([("S", "2")], "store_id string, sell_price string")
    r = quality.sell_price_checks(df).first()
    assert r.item_id_nulls == -1 and r.pk_any_nulls is None and r.pk_unique is None


def test_wide_sales_rules(spark):
    ids = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string"

    def run(schema, *rows, sample=None):
        return quality.wide_sales_checks(spark.createDataFrame(list(rows), schema), sample).first()

    meta = ("a", "i", "e", "c", "s", "t")
    assert run(ids + ", d_1 string, d_x string", (*meta, "3", "x")).passed
    assert run(ids + ", d_1 string", (*meta, "-3")).d_negative_in_sample == 1
    assert run(ids + ", d_1 string", (*meta, None)).d_non_numeric_in_sample == 1
    none = run(ids, meta)
    assert none.d_column_count == 0 and none.d_non_numeric_in_sample is None and not none.passed
    many = ids + "".join(f", d_{i} string" for i in range(12))
    row = (*meta, *["1"] * 10, "x", "-1")
    every = run(many, row)
    assert (every.d_non_numeric_in_sample, every.d_negative_in_sample, every.passed) == (1, 1, False)
    assert run(many, row, sample=10).passed


META = {"source_name": "s", "provider": "p", "schema_version": "v1", "ingest_date": "2024-01-01"}
SERIES = {"series_id": "X", "feature_name": "f", "label": "l", "frequency": "m", "units": "u"}


def documents(spark, *payloads):
    return spark.createDataFrame(
        [(str(i), p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)],
        "file string, document string")


def test_macro_document_rules(spark):
    good = {"observations": [{"date": "2024-01-01", "value": "."}], "series_metadata": SERIES,
            "ingestion_metadata": META}
    faults = [
        {**good, "observations": []},
        {**good, "observations": {"a": 1}},
        {k: v for k, v in good.items() if k != "observations"},
        {**good, "observations": [{"date": "", "value": None}, {"value": "1"}, 5]},
        {**good, "series_metadata": {"series_id": "X"}},
        {**good, "ingestion_metadata": "text"},
    ]
    r = {x.file: x for x in
         quality.macro_document_checks(documents(spark, good, *faults)).collect()}
    assert r["0"].passed and r["0"].observation_count == 1
    assert not any(r[str(i)].passed for i in range(1, 7))
    assert r["1"].observation_count == 0
    assert r["2"].observation_count is None and r["2"].empty_date_count is None
    assert r["3"].missing_top_level_keys == ["observations"] and r["3"].observation_count == 0
    assert (r["4"].observation_count, r["4"].missing_observation_keys_count) == (3, 3)
    assert (r["4"].empty_date_count, r["4"].empty_value_count) == (2, 1)
    assert r["5"].missing_series_metadata_keys == ["feature_name", "frequency", "label", "units"]
    assert r["6"].missing_ingestion_metadata_keys == sorted(META)


def test_weather_document_rules(spark):
    daily = {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [1.0, None],
             "temperature_2m_min": [0.5, 1], "precipitation_sum": [0, 2.5],
             "wind_speed_10m_max": [1, 2]}
    place = {"location_id": "CA", "state_id": "CA", "label": "l", "latitude": 1, "longitude": 2,
             "timezone": "z"}
    good = {"latitude": 1, "longitude": 2, "timezone": "z", "daily": daily, "location": place,
            "ingestion_metadata": META}
    faults = [
        {**good, "daily": {**daily, "precipitation_sum": [0]}},
        {**good, "daily": {**daily, "precipitation_sum": [-1, -2], "wind_speed_10m_max": [None, -1]}},
        {**good, "daily": {k: [] for k in daily}},
        {**good, "daily": {k: v for k, v in daily.items() if k != "time"}},
        {**good, "daily": {**daily, "wind_speed_10m_max": "none"}},
        {k: v for k, v in good.items() if k != "location"},
    ]
    r = {x.file: x for x in
         quality.weather_document_checks(documents(spark, good, *faults)).collect()}
    assert r["0"].passed and r["0"].time_length == 2 and r["0"].aligned_series_lengths
    assert not any(r[str(i)].passed for i in range(1, 7))
    assert not r["1"].aligned_series_lengths
    assert (r["2"].precipitation_negative_count, r["2"].wind_negative_count) == (2, 1)
    assert r["3"].time_length == 0 and r["3"].aligned_series_lengths
    assert r["4"].missing_daily_keys == ["time"] and r["4"].time_length == 0
    assert r["5"].wind_speed_10m_max_length is None and r["5"].wind_negative_count is None
    assert len(r["6"].missing_location_keys) == 6


def test_trends_rules(spark):
    fixed = ("date", "keyword", "feature_name", "label", "geo", "source_name", "provider",
             "schema_version", "ingest_date")

    def run(values, extra=("k w",), drop=()):
        cols = [c for c in fixed if c not in drop] + list(extra)
        rows = [tuple(["x"] * (len(cols) - len(extra)) + [v] * len(extra)) for v in values]
        schema = ", ".join(f"`{c}` string" for c in cols)
        return quality.trends_checks(spark.createDataFrame(rows, schema)).first()

    assert run(["5", "0"]).passed and run(["5"], ("k", "IsPartial")).passed
    assert run(["5"], ("a", "b")).interest_column_name is None
    assert run(["-5", "x"]).interest_negative_count == 1 and run(["x"]).interest_nulls == 1
    assert not run([]).passed
    assert run(["5"], drop=("geo",)).missing_required_columns == ["geo"]


def test_rollup_and_gate(spark, tmp_path):
    reports = spark.createDataFrame(
        [("a", True), ("c", False), ("b", False)], "part string, passed boolean")
    r = quality.suite_rollup(reports, "part").first()
    assert (r.parts_checked, r.parts_failed, r.failing_parts, r.passed) == (3, 2, ["b", "c"], False)
    failing = {x.part: json.loads(x.details_json) for x in quality.failing_parts(reports, "part").collect()}
    assert failing == {p: {"part": p, "passed": False} for p in "bc"}
    none = quality.suite_rollup(reports.limit(0), "part").first()
    assert (none.parts_checked, none.parts_failed, none.failing_parts, none.passed) == (0, 0, [], True)
    unknown = spark.createDataFrame([("a", None)], "part string, passed boolean")
    assert not quality.suite_rollup(unknown, "part").first().passed
    log = audit.QualityLog(spark, str(tmp_path / "dq"))
    suite = SUITES["calendar"]
    first = log.start(suite.dataset, suite.suite, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    quality.gate(quality.calendar_checks(calendar(spark), F.col("o")), log, first, "calendar")
    second = log.start(suite.dataset, suite.suite)
    bad = quality.calendar_checks(calendar(spark, d={1: None}), F.col("o"))
    with pytest.raises(quality.DataQualityError):
        quality.gate(bad, log, second, "calendar")
    state = {x.dq_run_id: x for x in log.state().collect()}
    assert state[first].status == "PASSED" and state[first].run_duration_seconds > 0
    assert state[first].dataset_name == "calendar"
    assert state[second].status == "FAILED" and "pk_nulls" in state[second].error_message
    assert json.loads(state[second].details_json)["pk_nulls"] == 1


def test_rolled_up_report_is_bounded(spark):
    many = spark.range(1000).select(F.format_string("p%04d", "id").alias("part"), (F.col("id") % 2 == 0).alias("passed"))
    r = quality.suite_rollup(many, "part").first()
    assert (r.parts_checked, r.parts_failed, r.passed) == (1000, 500, False)
    assert r.failing_parts == [f"p{i:04d}" for i in range(1, 2 * quality.SHOWN_PARTS, 2)]
    assert quality.failing_parts(many, "part").count() == 500


def test_ingestion_log(spark, tmp_path):
    log = audit.IngestionLog(spark, str(tmp_path / "runs"))
    assert log.state().count() == 0
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    a = log.start("macro", dt.date(2024, 1, 1), now=t0)
    b = log.start("macro", dt.date(2024, 1, 2), now=t0)
    log.succeed(a, "/lake/x", 10, 2, 300, now=t0 + dt.timedelta(seconds=5))
    log.fail(b, "x" * 9000, now=t0 + dt.timedelta(seconds=5))
    state = {r.run_id: r for r in log.state().collect()}
    assert state[a].status == "SUCCEEDED" and state[a].row_count == 10
    assert state[a].source_name == "macro" and state[a].error_message is None
    assert state[b].status == "FAILED" and len(state[b].error_message) == 5000
    with pytest.raises(LookupError):
        log.succeed("unknown", "/x")


def test_contracts(spark):
    df = spark.createDataFrame(
        [("S", "I", dt.date(2024, 1, 1), 1, 5, None), ("S", "I", dt.date(2024, 1, 1), 1, -2, 1.0),
         ("S", None, dt.date(2024, 1, 2), 1, 3, 1.0)],
        "store_id string, item_id string, date date, wm_yr_wk int, sales int, sell_price double")
    assert [r.row_count for r in contracts.grain_unique(df).collect()] == [2]
    assert contracts.sales_non_negative(df).count() == 1
    assert contracts.price_coverage(df).count() == 1
    assert contracts.price_coverage(df, 0.5).count() == 0
    assert contracts.price_coverage(df.limit(0)).count() == 0
    assert contracts.price_key_unique(df).first().n == 2
    got = {r.column_name: r.failures for r in
           contracts.column_contract(df, "gold_training_daily").collect()}
    assert got == {"store_id": 0, "item_id": 1, "date": 0, "wm_yr_wk": 0, "sales": 0}
    with pytest.raises(ValueError):
        contracts.column_contract(df, "nope")

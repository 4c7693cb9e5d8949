import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators import asof, reshape, silver
from demandloom.sources import landing, snapshots
from tests import landed


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing"))
    landed.write(path)
    return path


def retail(root, name):
    return landing.landing_path(root, "retail_sales", landed.DAY, name)


def test_layout():
    assert landing.landing_path("/lake/", "s", "2024-01-02", "f.csv") == (
        "/lake/source=s/ingest_date=2024-01-02/f.csv")
    assert landing.part_path("/l", "s", "d", "CA", "f.json").endswith("ingest_date=d/CA/f.json")
    assert landing.keyword_path("/l", "s", "d", "k w", "f.csv").endswith("/keyword=k w/f.csv")


def test_calendar_is_text_with_blanks_as_null(spark, root):
    df = landing.read_calendar(spark, retail(root, "calendar.csv"))
    assert df.schema.names == S.CALENDAR_RAW.names
    assert {t for _, t in df.dtypes} == {"string"}
    row = df.where("d = 'd_1'").first()
    assert row.event_name_1 is None and row.event_type_1 is None and row.date == "2024-01-01"
    dim = silver.calendar(df).where("d = 'd_7'").first()
    assert dim.date == dt.date(2024, 1, 7) and dim.day_of_week == 7  # a Sunday


def test_reordered_header_fails(spark, tmp_path):
    p = tmp_path / "prices.csv"
    p.write_text("item_id,store_id,wm_yr_wk,sell_price\nA,CA_1,11101,2.5\n")
    with pytest.raises(Exception, match="header does not conform"):
        landing.read_sell_prices(spark, str(p)).collect()


def test_wide_sales_unpivot(spark, root, tmp_path):
    wide = landing.read_wide_sales(spark, retail(root, "sales_train_validation.csv"))
    assert reshape.wide_sales_to_long(wide, None).count() == 4 * 150
    assert reshape.wide_sales_to_long(wide).count() == 4 * 150
    long = reshape.wide_sales_to_long(wide, 90)
    assert long.count() == 4 * 90 and long.select("d").distinct().count() == 90
    assert long.where("d = 'd_60'").count() == 0
    odd = tmp_path / "odd.csv"
    odd.write_text("id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3,d_4\n"
                   "a,b,c,d,e,f,3.9,x,,-2\n")
    got = {r.d: r.sales for r in reshape.wide_sales_to_long(
        landing.read_wide_sales(spark, str(odd))).collect()}
    assert got == {"d_1": 3, "d_2": 0, "d_3": 0, "d_4": -2}


def test_weather_documents(spark, root):
    paths = [landing.part_path(root, "weather_openmeteo", landed.DAY, x[0], "daily_weather.json")
             for x in S.WEATHER_LOCATIONS]
    flat = reshape.flatten_weather(landing.read_weather_documents(spark, paths))
    assert flat.columns == S.WEATHER_RAW.names and flat.count() == 3 * 150
    typed = silver.weather_daily(flat)
    row = typed.where("state_id = 'CA' and weather_date = date'2024-01-04'").first()
    assert row.temperature_2m_max == 23.5 and row.temperature_2m_min is None
    assert row.latitude == 36.7783


def test_arrays_follow_the_time_array(spark):
    doc = spark.sql("""select named_struct('time', array('2024-01-01', '2024-01-02'),
        'temperature_2m_max', array('1'), 'temperature_2m_min', array('1', '2', '3'),
        'precipitation_sum', array('1', '2'), 'wind_speed_10m_max', array('1', '2')) daily,
        named_struct('location_id', 'CA', 'state_id', 'CA', 'label', 'l', 'latitude', '1',
        'longitude', '2', 'timezone', 'z') location, named_struct('source_name', 's',
        'provider', 'p', 'schema_version', 'v', 'ingest_date', '2024-01-01') ingestion_metadata""")
    rows = reshape.flatten_weather(doc).orderBy("weather_date").collect()
    assert [r.temperature_2m_max for r in rows] == ["1", None]


def test_macro_documents_and_missing_marks(spark, root):
    paths = [landing.part_path(root, "macro_fred", landed.DAY, s[0], "macro_series.json")
             for s in S.MACRO_SERIES]
    flat = reshape.flatten_macro(landing.read_macro_documents(spark, paths))
    assert flat.columns == S.MACRO_RAW.names and flat.count() == 16
    typed = silver.macro_series(flat)
    assert typed.where("observation_value is null").count() == 4
    bad = flat.withColumn("observation_value", F.lit("n/a"))
    with pytest.raises(PySparkException):
        silver.macro_series(bad).collect()


def test_trends_keyword_files(spark, root):
    df = landing.read_trends(spark, root, landed.DAY)
    assert df.columns == S.TRENDS_RAW.names and df.count() == 4 * 150
    assert df.where("keyword = 'grocery store'").select("feature_name").distinct().first()[0] == (
        "trends_grocery_store")
    with pytest.raises(ValueError, match="expected one interest column"):
        landing.interest_column([*S.TRENDS_FIXED_COLUMNS, "a", "b"], "k")
    with pytest.raises(ValueError, match="expected one interest column"):
        landing.interest_column([*S.TRENDS_FIXED_COLUMNS, "isPartial"], "k")


def test_price_filter(spark):
    raw = spark.createDataFrame(
        [("S", "I", "1", "2.5"), ("S", "I", "2", "0"), ("S", None, "3", "1"), ("S", "I", "4", None)],
        S.PRICES_RAW)
    rows = silver.sell_prices(raw).collect()
    assert [(r.wm_yr_wk, str(r.sell_price)) for r in rows] == [(1, "2.5000")]


def test_sales_need_a_calendar_day(spark):
    cal = spark.createDataFrame([("d_1", dt.date(2024, 1, 1))], "d string, date date")
    raw = spark.createDataFrame(
        [("x", "i", "e", "c", "s", "t", "d_1", 5), ("x", "i", "e", "c", "s", "t", "d_1", -1),
         ("x", "i", "e", "c", "s", "t", "d_9", 5)], S.SALES_LONG_RAW)
    assert [r.sales for r in silver.sales(raw, cal).collect()] == [5]


def test_sales_date_range(spark):
    cal = spark.createDataFrame(
        [("d_1", dt.date(2024, 1, 1)), ("d_2", dt.date(2024, 1, 2))], "d string, date date")
    raw = spark.createDataFrame([("d_2",), ("d_2",), ("d_7",)], "d string")
    assert tuple(silver.sales_date_range(raw, cal).first()) == (dt.date(2024, 1, 2),) * 2
    with pytest.raises(PySparkException, match="no sales day"):
        silver.sales_date_range(raw.where("d = 'd_7'"), cal).collect()


def test_date_chunks(spark):
    def chunks(start, end, n=180):
        b = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))],
                                  "start_date date, end_date date")
        return [(str(r.chunk_start), str(r.chunk_end))
                for r in landing.date_chunks(b, n).orderBy("chunk_index").collect()]

    assert chunks("2024-01-01", "2024-01-01") == [("2024-01-01", "2024-01-01")]
    assert chunks("2024-01-01", "2024-01-25", 10) == [
        ("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-25")]
    assert len(chunks("2011-01-29", "2016-04-24")) == 11
    with pytest.raises(PySparkException, match="after end_date"):
        chunks("2024-02-01", "2024-01-01")


def test_keep_last_with_a_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("at"), "id")
    got = {r.k: (r["at"], r.id) for r in reshape.keep_last(df, ["k"], ["at", "id"]).collect()}
    want = {}
    for r in df.collect():
        want[r.k] = max(want.get(r.k, (-1, -1)), (r["at"], r.id))
    assert got == want


def test_latest_successful_ingest_date(spark):
    runs = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), "SUCCEEDED", 1), ("a", dt.date(2024, 1, 3), "FAILED", 2),
         ("a", dt.date(2024, 1, 2), "SUCCEEDED", 3), ("b", dt.date(2024, 1, 1), "STARTED", 4)],
        "source_name string, ingest_date date, status string, ended_at int")
    assert landing.latest_successful_ingest_date(runs, "a") == dt.date(2024, 1, 2)
    with pytest.raises(LookupError):
        landing.latest_successful_ingest_date(runs, "b")


def test_both_as_of_plans_match_brute_force(spark):
    import random
    rnd = random.Random(7)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    days = sorted(rnd.sample(range(200), 90))
    obs = [(f, day(n), None if rnd.random() < 0.3 else float(n))
           for f in ("x", "y", "z") for n in rnd.sample(range(-40, 230), 25)]
    dates = spark.createDataFrame([(day(n),) for n in days], "date date")
    seen = spark.createDataFrame(obs, "f string, at date, v double")
    want = set()
    for n in days:
        for f in ("x", "y", "z"):
            known = [(a, v) for g, a, v in obs if g == f and v is not None and a <= day(n)]
            if known:
                want.add((day(n), f, *max(known)))
    got = asof.latest_on_each_day(dates, seen, "f", "at", "v")
    assert {tuple(r) for r in got.collect()} == want
    probes = dates.select("date", F.explode(F.array(*[F.lit(x) for x in "xyz"])).alias("f"))
    window = asof.latest_at_or_before(
        probes.unionByName(probes), seen.where("v is not null"), ["f"], "date", "at", ["v"])
    rows = window.select("date", "f", "at", "v").collect()
    assert len(rows) == 2 * 3 * len(days)
    assert {tuple(r) for r in rows if r["at"] is not None} == want
    for slice_by in ("day", "year"):
        again = asof.latest_at_or_before(
            probes, seen.where("v is not null"), ["f"], "date", "at", ["v"], slice_by)
        rows = again.select("date", "f", "at", "v").collect()
        assert {tuple(r) for r in rows if r["at"] is not None} == want


def test_repeated_observations_keep_the_newest_ingest(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 5),)], "date date")
    obs = spark.createDataFrame(
        [("x", dt.date(2024, 1, 1), 1.0, 1), ("x", dt.date(2024, 1, 1), 9.0, 2)],
        "f string, at date, v double, ingest int")
    assert asof.latest_on_each_day(days, obs, "f", "at", "v", "ingest").first().v == 9.0


def test_snapshot_fallback(spark, tmp_path):
    schema = snapshots.MONITORING_SCHEMA
    gone, cache = str(tmp_path / "latest"), str(tmp_path / "cache")
    df, label = snapshots.read_with_fallback(spark, gone, cache, schema)
    assert label == "unavailable" and df.count() == 0 and df.schema == schema
    spark.createDataFrame([], schema).write.parquet(cache)
    assert snapshots.read_with_fallback(spark, gone, cache, schema)[1] == "cache"
    spark.createDataFrame([], schema).write.parquet(gone)
    assert snapshots.read_with_fallback(spark, gone, cache, schema)[1] == "latest"
    meta, label = snapshots.read_snapshot_metadata(spark, str(tmp_path / "none"))
    row = meta.first()
    assert label == "unavailable" and row.snapshot_run_id is None
    assert row.forecast_row_count == 0 and row.forecast_horizon_days == 0

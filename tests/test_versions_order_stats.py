"""Published versions, the forecast map, audit compaction, manifests, exact order statistics, linear grid."""

import datetime as dt
import glob
import hashlib
import os
import random
from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators import audit, linear_grid, order_stats, quality
from demandloom.operators.splits import BacktestConfig
from demandloom.sinks import manifest, versions
from demandloom.sinks.forecasts import ForecastTable
from demandloom.sources import landing

AT = dt.datetime(2024, 6, 1, 4, 0)


def staged(spark, root, text):
    folder = versions.staging_path(root)
    os.makedirs(folder)
    with open(f"{folder}/content", "w") as f:
        f.write(text)
    return folder


def test_a_number_has_one_owner(spark, tmp_path):
    root = str(tmp_path / "v")
    assert versions.versions(spark, root) == []
    first, second = staged(spark, root, "a"), staged(spark, root, "b")
    assert versions.publish_as(spark, first, root, 1)
    assert not versions.publish_as(spark, second, root, 1)
    assert open(f"{root}/version=1/content").read() == "a" and os.path.exists(f"{second}/content")
    assert versions.versions(spark, root) == [1]  # the loser is still aside
    assert versions.publish_next(spark, second, root) == 2


def test_writers_at_once_get_different_numbers(spark, tmp_path):
    root = str(tmp_path / "v")
    folders = [staged(spark, root, str(i)) for i in range(8)]
    with ThreadPool(8) as pool:
        got = pool.map(lambda f: versions.publish_next(spark, f, root), folders)
    assert sorted(got) == versions.versions(spark, root) and len(set(got)) == 8
    for i, n in enumerate(got):
        assert open(f"{root}/version={n}/content").read() == str(i)


def batch(spark, days, value):
    rows = [(dt.date(2024, 6, d), 1, "S", "A", value, "m", "1", "fs", AT) for d in days]
    return spark.createDataFrame(rows, S.FORECAST_TABLE)


def values(table):
    return sorted((r.forecast_date.day, r.prediction) for r in table.read().collect())


def test_a_killed_writer_changes_nothing(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "f"))
    table.overwrite(batch(spark, range(1, 6), 1.0))
    before = values(table)
    name, days = table.write_batch(batch(spark, (2, 4), 2.0))  # dies before the map
    assert values(table) == before and len(days) == 2
    staging = versions.staging_path(table.maps)  # dies before the rename
    spark.createDataFrame([("2024-06-02", name)], "day string, batch string").write.json(staging)
    assert values(table) == before
    table.publish(name, days)
    assert values(table) == [(1, 1.0), (2, 2.0), (4, 2.0), (5, 1.0)]
    table.overwrite(batch(spark, (9,), 3.0))
    table.vacuum(keep_maps=1)
    assert values(table) == [(1, 1.0), (2, 2.0), (4, 2.0), (5, 1.0), (9, 3.0)]
    assert len(glob.glob(f"{tmp_path}/f/maps/version=*")) == 1


def test_two_overwrites_at_once_both_count(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "f"))
    written = [table.write_batch(batch(spark, (d,), float(d))) for d in (1, 2, 3, 4)]
    with ThreadPool(4) as pool:
        pool.map(lambda w: table.publish(*w), written)
    assert values(table) == [(d, float(d)) for d in (1, 2, 3, 4)]


def test_compaction_bounds_files_and_keeps_the_state(spark, tmp_path):
    log = audit.IngestionLog(spark, str(tmp_path / "log"))
    plain = []
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for day in range(6):
        for n in range(200):
            run, at = f"run-{day}-{n}", start + dt.timedelta(days=day, seconds=n)
            plain.append({"run_id": run, "source_name": "s", "status": "STARTED", "started_at": at, "event_ts": at,
                          "ingest_date": at.date(), "schema_version": "v1"})
            if n % 5:
                end = at + dt.timedelta(days=n % 3)
                plain.append({"run_id": run, "status": "SUCCEEDED", "row_count": n, "ended_at": end, "event_ts": end})
    rows = [tuple(e.get(c) for c in log.schema.names) for e in plain]
    events = spark.createDataFrame(rows, log.schema)
    for day in range(8):
        log.append(events.where(F.to_date("event_ts") == F.lit((start + dt.timedelta(days=day)).date())))
        if day:
            log.compact((start + dt.timedelta(days=day - 1)).date())
    want = {r.run_id: r.asDict() for r in audit.latest_state(events).collect()}
    assert {r.run_id: r.asDict() for r in log.state().collect()} == want and len(want) == 1200
    # two bases and the tail days since the base before the last
    files = glob.glob(f"{tmp_path}/log/**/*.parquet", recursive=True)
    assert len(glob.glob(f"{tmp_path}/log/base/version=*")) == 2 and len(files) < 2 * 16 + 3 * 16 * 8
    log.compact(dt.date(2024, 1, 3))  # older than the base: nothing
    # a run whose start is in the base only; a late event
    log.fail("run-0-0", "late", now=start + dt.timedelta(days=1))
    row = log.state().where("run_id = 'run-0-0'").first()
    assert row.status == "FAILED" and row.source_name == "s"
    with pytest.raises(LookupError):
        log.succeed("nobody", "/x")
    with pytest.raises(ValueError, match="finished"):
        log.compact(dt.datetime.now(dt.timezone.utc).date())


@pytest.mark.parametrize("broadcast", [1 << 18, 0])
def test_whole_events_are_gathered_for_the_newest_only(spark, monkeypatch, broadcast):
    monkeypatch.setattr(audit, "BROADCAST_RUNS", broadcast)
    rows = [(f"r{i % 7}" if i % 7 else None, "s" if i < 7 else None, i // 7 % 5 if i % 7 != 3 else None, f"m{i}" * 50)
            for i in range(70)]
    events = spark.createDataFrame(rows, "run_id string, source_name string, event_ts int, message string")
    state = audit.latest_state(events, keep_at=True)
    got = {r.run_id: r for r in state.collect()}
    assert len(got) == state.count() == 7
    for run in ("r1", "r2", "r4", "r5", "r6", None):
        last = [m for r, _, at, m in rows if r == run and at == 4]
        assert got[run].event_ts == 4 and got[run].source_name == "s" and got[run].message in last
    assert tuple(got["r3"]) == ("r3", None, None, None)
    # Before the join with the newest times, messages are not sorted.
    plan = audit.latest_state(events)._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan[plan.index("HashJoin"):] and "SortMergeJoin" not in plan


def test_files_of_events_are_written_unsorted(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    seen = []
    schema = "run_id string, event_ts timestamp, message string"
    log = audit.EventLog(spark, str(tmp_path / "log"), spark.createDataFrame([], schema).schema)
    start = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(f"r{i}", start + dt.timedelta(days=i % 40), "m") for i in range(2000)], log.schema)
    with audit._unsorted_files(spark):
        seen.append(spark.conf.get(name))
        log.append(events)
    assert seen == [str(audit.OPEN_FILES)] and spark.conf.get(name) == "0"
    # One file for each day and bucket, however many tasks held rows of it.
    files = glob.glob(f"{tmp_path}/log/tail/day=*/bucket=*/*.parquet")
    assert len(files) == len({f.rsplit("/", 1)[0] for f in files}) == events.selectExpr(
        "cast(event_ts as date) d", f"pmod(crc32(cast(run_id as binary)), {audit.BUCKETS}) b").distinct().count()
    assert sorted(r.run_id for r in log.events().collect()) == sorted(f"r{i}" for i in range(2000))


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "x")
    rows = [(f"S{i % 4}", f"I{i % 3}", dt.date(2024, 1, 1) + dt.timedelta(days=i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, sales int")
    known = manifest.write_extract_with_manifest(df, path, rows_per_file=20)
    assert known.agg(F.sum("rows")).first()[0] == 200 and known.agg(F.max("rows")).first()[0] <= 20
    assert spark.read.parquet(path).count() == 200  # plain readers do not see the manifest
    within = manifest.read_verified(spark, path, {"store_id": ("S1", "S2")})
    assert sorted(map(tuple, within.collect())) == sorted(r for r in rows if r[0] in ("S1", "S2"))
    assert within.inputFiles() and manifest.read_verified(spark, path, {"store_id": ("X", "Y")}).count() == 0
    spark.range(1).write.mode("append").parquet(path)
    with pytest.raises(manifest.IncompleteExtract, match="stray"):
        manifest.read_verified(spark, path)
    manifest.write_extract_with_manifest(df, path)
    os.remove(glob.glob(f"{path}/part-*.parquet")[0])
    with pytest.raises(manifest.IncompleteExtract, match="missing"):
        manifest.read_verified(spark, path)
    df.write.mode("overwrite").parquet(path)
    with pytest.raises(manifest.IncompleteExtract, match="no manifest"):
        manifest.read_verified(spark, path)


def test_exact_sample_equals_a_sort(spark):
    rows = [(None if i % 7 == 0 else f"S{i % 3}", f"I{i}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "store string, item string, x int")

    def place(r):
        return int(hashlib.md5(f"{r[0] or ''}|{r[1]}".encode()).hexdigest()[:15], 16), r[1]

    want = sorted(rows, key=place)[:100]
    for parts in (1, 9):
        got = order_stats.sample_n(df.repartition(parts), 100, ("store", "item"))
        assert got.columns == df.columns
        assert sorted(r.x for r in got.collect()) == sorted(r[2] for r in want)
    strata = order_stats.sample_n(df, 10, ("store", "item"), ("store",)).collect()
    for store in (None, "S0", "S1", "S2"):
        best = sorted((r for r in rows if r[0] == store), key=place)[:10]
        assert sorted(r.x for r in strata if r.store == store) == sorted(r[2] for r in best)
    assert order_stats.sample_n(df, 5000, ("item",)).count() == 3000
    assert order_stats.sample_n(df.limit(0), 5, ("item",)).count() == 0


def test_exact_quantiles(spark):
    rnd = random.Random(5)
    skewed = [float(rnd.lognormvariate(0, 8)) for _ in range(997)]
    tied = [float(rnd.choice([0.1, 0.1, 0.1, 2.5])) for _ in range(997)]
    wide = [rnd.choice([-1e308, 1e308, 1e-300, 0.0, -3.25]) for _ in range(997)]
    rows = [(a, b, c, None, None if i % 10 == 0 else float("nan") if i % 10 == 1 else a)
            for i, (a, b, c) in enumerate(zip(skewed, tied, wide))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    got = {r.feature: r for r in order_stats.exact_distribution(df, ["a", "b", "d", "e"]).collect()}
    for c, x in (("a", skewed), ("b", tied), ("e", [r[4] for i, r in enumerate(rows) if i % 10 > 1])):
        want = np.percentile(x, [50, 90, 99])
        assert np.allclose([got[c].p50, got[c].p90, got[c].p99], want, rtol=1e-12)
        assert got[c].n == len(x) and np.isclose(got[c].deviation, np.std(x, ddof=1))
    assert (got["d"].n, got["d"].p50, got["d"].average) == (0, None, None)
    ends = {"c": (-1e308, 1e308)}
    found = order_stats._kth_values(df, {"c": list(range(0, 997, 83))}, ends)
    assert {r: v for (_, r), v in found.items()} == {r: sorted(wide)[r] for r in range(0, 997, 83)}
    assert order_stats.exact_distribution(df.limit(0), ["a"]).first().n == 0


def test_linear_grid_equals_single_fits(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i % 90)
        x1, x2 = rnd.uniform(0, 1e4), None if rnd.random() < 0.2 or i % 90 > 80 else rnd.uniform(0, 1)
        rows.append((day, x1, x2, None if rnd.random() < 0.05 else 3 * x1 + (x2 or 0) * 7 + rnd.gauss(0, 5)))
    df = spark.createDataFrame(rows, "date date, x1 double, x2 double, sales double")
    sets = {"one": ("x1",), "both": ("x1", "x2")}
    config = BacktestConfig(horizon_days=7, n_windows=3)
    got = {(r.feature_set_name, r.window): r for r in linear_grid.ablation_linear(df, sets, config).collect()}
    fits = linear_grid.fit_grid(df, sets, config)
    assert len(got) == 6
    for name, width in (("one", 1), ("both", 2)):
        own = [r for r in rows if r[3] is not None and None not in r[1:1 + width]]
        newest = max(r[0] for r in own)
        for w in (1, 2, 3):
            number = [(newest - r[0]).days // 7 + 1 for r in own]
            train = np.array([[1, *r[1:1 + width], r[3]] for r, k in zip(own, number) if k > w])
            test = np.array([[1, *r[1:1 + width], r[3]] for r, k in zip(own, number) if k == w])
            beta = np.linalg.lstsq(train[:, :-1], train[:, -1], rcond=None)[0]
            assert np.allclose(fits[(name, w)], beta, rtol=1e-6, atol=1e-6)
            error = test[:, :-1] @ beta - test[:, -1]
            row = got[(name, w)]
            assert (row.train_rows, row.test_rows) == (len(train), len(test))
            assert np.isclose(row.rmse, np.sqrt(np.mean(error ** 2)), rtol=1e-6)
            assert np.isclose(row.wmape, np.abs(error).sum() / test[:, -1].sum(), rtol=1e-6)
    assert linear_grid.ablation_linear(df.limit(0), sets, config).count() == 0


def test_file_order_of_a_file_cut_into_splits(spark, tmp_path):
    path = str(tmp_path / "one")
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(6000)]
    spark.createDataFrame([(d.isoformat(),) for d in days], "date string").coalesce(1).write.option(
        "header", True).csv(path)
    short = str(tmp_path / "two")
    spark.createDataFrame([("2030-01-01",)], "date string").coalesce(1).write.option("header", True).csv(short)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        for files, want in (([path, short], True), ([path], True)):
            df = landing.read_headed_csv(spark, files)
            assert df.rdd.getNumPartitions() > 3
            check = quality.non_decreasing(df, F.col("date").cast("date"))
            assert spark.range(1).select(check).first()[0] is want
        late = str(tmp_path / "zz")
        spark.createDataFrame([("1999-01-01",)], "date string").coalesce(1).write.option("header", True).csv(late)
        check = quality.non_decreasing(landing.read_headed_csv(spark, [path, late]), F.col("date").cast("date"))
        assert spark.range(1).select(check).first()[0] is False
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

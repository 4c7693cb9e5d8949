"""Run audit as append-only status events.

A run is a STARTED event followed by at most one closing event; its state is
the latest event.  Appends never rewrite files, and the state query combines
map-side.  A log is a base (one row per run, the fold of all events up to a day)
and a tail of event days after it; both are cut into buckets of runs, so closing
a run reads one bucket.

Error texts are long, so whole events are never sorted: the newest event of each run is found from the narrow columns,
and only events that are the newest of a run are gathered; files of events are written in the order of arrival.
"""

from __future__ import annotations

import uuid
import zlib
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import schemas as S
from demandloom.session import scratch_path
from demandloom.sinks import versions

MESSAGE_LIMIT = 5000
BUCKETS = 16
#: Runs whose newest times are broadcast at most; more are joined by shuffled hash tables.
BROADCAST_RUNS = 1 << 18
#: Newest events and appended events of a task, and tasks at most (more would be sorted before a shuffle).
FOLD_ROWS, APPEND_ROWS, TASKS = 1 << 12, 1 << 14, 200
#: Files a task writes side by side; it sorts only what belongs to further ones.
OPEN_FILES = 64


def clipped_message(column) -> F.Column:
    """Error text cut to the audit limit; a missing text is empty."""
    return F.substring(F.coalesce(column, F.lit("")), 1, MESSAGE_LIMIT)


def latest_state(events: DataFrame, run_id: str = "run_id", at: str = "event_ts",
                 keep_at: bool = False) -> DataFrame:
    """One row per run: its latest event, with identity columns from its start.

    With ``keep_at`` the rows are events again: folding them with later events
    gives the state that folding all events gives.
    """
    rest = [c for c in events.columns if c not in (run_id, at)]
    started = [c for c in ("source_name", "ingest_date", "schema_version", "dataset_name",
                           "suite_name", "started_at") if c in rest]
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(f"_s_{c}") for c in started]
    newest = events.groupBy(F.col(run_id).alias("_run")).agg(F.max(at).alias("_at"), *known)
    path = scratch_path(events.sparkSession, "audit-newest")
    newest.write.parquet(path)
    newest = events.sparkSession.read.schema(newest.schema).parquet(path)
    runs = newest.count()
    # Neither of these joins sorts the events.
    last = events.join(newest.hint("broadcast" if runs <= BROADCAST_RUNS else "shuffle_hash"),
                       events[run_id].eqNullSafe(F.col("_run")) & events[at].eqNullSafe(F.col("_at")))
    folded = last.repartition(_tasks(runs, FOLD_ROWS), run_id).groupBy(run_id).agg(
        F.max_by(F.struct(*rest), at).alias("_e"), F.max(at).alias("_at"),
        *[F.max_by(f"_s_{c}", at).alias(f"_s_{c}") for c in started])
    return folded.select(run_id, *([F.col("_at").alias(at)] if keep_at else []), *[
        F.coalesce(f"_e.{c}", f"_s_{c}").alias(c) if c in started else F.col(f"_e.{c}").alias(c)
        for c in rest])


def _tasks(rows: int, of_a_task: int) -> int:
    return min(TASKS, 1 + rows // of_a_task)


@contextmanager
def _unsorted_files(spark: SparkSession):
    """Writes by partition columns keep several files open instead of sorting the rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_duration(state: DataFrame) -> DataFrame:
    """Whole seconds from start to end."""
    return state.withColumn(
        "run_duration_seconds", F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")))


class EventLog:
    """Events of any schema with a run id and ``event_ts``."""

    schema = None
    run_id = "run_id"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark, self.path = spark, path
        self.schema = schema or self.schema

    @property
    def _tail_path(self) -> str:
        return f"{self.path}/tail"

    @property
    def _base_path(self) -> str:
        return f"{self.path}/base"

    def _through(self) -> date | None:
        """Last day the newest base holds; a base is numbered by that day."""
        found = versions.versions(self.spark, self._base_path)
        return datetime.strptime(str(found[-1]), "%Y%m%d").date() if found else None

    def _read(self, path: str, *partitions: T.StructField) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *partitions, T.StructField("bucket", T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _tail(self, after: date | None) -> DataFrame:
        rows = self._read(self._tail_path, T.StructField("day", T.DateType()))
        return rows.where(F.col("day") > F.lit(after)) if after else rows

    def _bucketed(self) -> DataFrame:
        through = self._through()
        tail = self._tail(through).drop("day")
        if not through:
            return tail
        base = self._read(versions.version_path(self._base_path, _number(through)))
        return base.unionByName(tail)

    def events(self) -> DataFrame:
        """The events to fold: one per run up to the base's day, all after it."""
        return self._bucketed().select(*self.schema.names)

    def state(self) -> DataFrame:
        return latest_state(self.events(), self.run_id)

    def append(self, events: DataFrame) -> None:
        """Add events by their UTC day; one that is late goes to the first day after the base."""
        through = self._through()
        day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("event_ts").cast("timestamp")) / 86400).cast("int"))
        if through:
            day = F.greatest(day, F.lit(through + timedelta(days=1)))
        bucket = F.pmod(F.crc32(F.col(self.run_id).cast("binary")), F.lit(BUCKETS)).cast("int")
        rows = events.select(self.run_id).count()
        dealt = events.select(*self.schema.names, day.alias("day"), bucket.alias("bucket")).repartition(
            _tasks(rows, APPEND_ROWS), "day", "bucket")
        with _unsorted_files(self.spark):
            dealt.write.mode("append").partitionBy("day", "bucket").parquet(self._tail_path)

    def _append(self, **values) -> None:
        now = values.pop("now", None) or datetime.now(timezone.utc)
        row = {**dict.fromkeys(self.schema.names), **values, "event_ts": now}
        self.append(self.spark.createDataFrame(
            [tuple(row[n] for n in self.schema.names)], self.schema).coalesce(1))

    def compact(self, through: date) -> None:
        """Fold everything up to a finished UTC day into a new base.

        One file per bucket.  What the base before the last one and its readers
        needed is removed; a compaction that dies leaves the old base in place.
        """
        if through >= datetime.now(timezone.utc).date():
            raise ValueError("only finished days can be compacted")
        before = self._through()
        if before and through <= before:
            return
        tail = self._tail(before).where(F.col("day") <= F.lit(through)).drop("day")
        if before:
            tail = self._read(versions.version_path(self._base_path, _number(before))).unionByName(tail)
        bucket = F.pmod(F.crc32(F.col(self.run_id).cast("binary")), F.lit(BUCKETS)).cast("int")
        folded = latest_state(tail.drop("bucket"), self.run_id, keep_at=True)
        staged = versions.staging_path(self._base_path)
        dealt = folded.select(*self.schema.names, bucket.alias("bucket")).repartition(BUCKETS, "bucket")
        with _unsorted_files(self.spark):
            dealt.write.partitionBy("bucket").parquet(staged)
        if not versions.publish_as(self.spark, staged, self._base_path, _number(through)):
            versions.remove(self.spark, staged)
            return
        for old in versions.versions(self.spark, self._base_path)[:-2]:
            versions.remove(self.spark, versions.version_path(self._base_path, old))
        for name in versions.folder_names(self.spark, self._tail_path) if before else []:
            if name.startswith("day=") and date.fromisoformat(name[4:]) <= before:
                versions.remove(self.spark, f"{self._tail_path}/{name}")

    def _started(self, run_id: str):
        own = F.col("bucket") == zlib.crc32(run_id.encode()) % BUCKETS
        row = self._bucketed().where(
            own & (F.col(self.run_id) == run_id) & F.col("started_at").isNotNull()).head()
        if row is None:
            raise LookupError(f"audit run not found: {run_id}")
        return row


def _number(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


class IngestionLog(EventLog):
    """STARTED -> SUCCEEDED | FAILED."""

    schema = S.INGESTION_RUNS

    def start(self, source_name: str, ingest_date, schema_version: str = "v1",
              now: datetime | None = None) -> str:
        run_id, at = str(uuid.uuid4()), now or datetime.now(timezone.utc)
        self._append(run_id=run_id, source_name=source_name, ingest_date=ingest_date,
                     status="STARTED", schema_version=schema_version, started_at=at, now=at)
        return run_id

    def succeed(self, run_id: str, path: str, row_count: int | None = None,
                file_count: int | None = None, total_bytes: int | None = None,
                now: datetime | None = None) -> None:
        self._started(run_id)
        at = now or datetime.now(timezone.utc)
        self._append(run_id=run_id, status="SUCCEEDED", s3_path=path, row_count=row_count,
                     file_count=file_count, total_bytes=total_bytes, ended_at=at, now=at)

    def fail(self, run_id: str, message: str | None, now: datetime | None = None) -> None:
        self._started(run_id)
        at = now or datetime.now(timezone.utc)
        self._append(run_id=run_id, status="FAILED", ended_at=at, now=at,
                     error_message=(message or "")[:MESSAGE_LIMIT])


class QualityLog(EventLog):
    """STARTED -> PASSED | FAILED."""

    schema = S.DQ_RUNS
    run_id = "dq_run_id"

    def start(self, dataset_name: str, suite_name: str, now: datetime | None = None) -> str:
        run_id, at = str(uuid.uuid4()), now or datetime.now(timezone.utc)
        self._append(dq_run_id=run_id, dataset_name=dataset_name, suite_name=suite_name,
                     status="STARTED", started_at=at, now=at)
        return run_id

    def passed(self, run_id: str, details_json: str | None = None,
               now: datetime | None = None) -> None:
        self._started(run_id)
        at = now or datetime.now(timezone.utc)
        self._append(dq_run_id=run_id, status="PASSED", ended_at=at, now=at,
                     details_json=details_json)

    def failed(self, run_id: str, message: str | None, details_json: str | None = None,
               now: datetime | None = None) -> None:
        self._started(run_id)
        at = now or datetime.now(timezone.utc)
        self._append(dq_run_id=run_id, status="FAILED", ended_at=at, now=at,
                     details_json=details_json, error_message=(message or "")[:MESSAGE_LIMIT])

    def state(self) -> DataFrame:
        return with_duration(super().state())

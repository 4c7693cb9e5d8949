"""The forecast table and its idempotent horizon overwrite."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.sinks import versions

_PARTITION = re.compile(r"forecast_date=(\d{4}-\d{2}-\d{2})")
_MAP = "day string, batch string"


def contract_columns(df: DataFrame) -> DataFrame:
    """Cast and order the nine columns of the forecast table."""
    missing = [n for n in S.FORECAST_TABLE.names if n not in df.columns]
    if missing:
        raise ValueError(f"forecast rows lack columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.FORECAST_TABLE])


def overwrite_horizon(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """The table after the overwrite, as a plan.

    Every existing row inside the closed [min, max] day interval of the batch
    goes, whatever its series or model; an empty batch is an error.
    """
    new = contract_columns(batch)
    span = new.agg(F.min("forecast_date").alias("lo"), F.max("forecast_date").alias("hi"),
                   F.count(F.lit(1)).alias("n"))
    checked = span.select(
        F.when(F.col("n") == 0, F.raise_error(F.lit("the forecast batch is empty")).cast("date"))
        .otherwise(F.col("lo")).alias("lo"), "hi")
    lo, hi = checked.select("lo").scalar(), checked.select("hi").scalar()
    keep = contract_columns(existing).where(
        (F.col("forecast_date") < lo) | (F.col("forecast_date") > hi))
    return keep.unionByName(new)


class ForecastTable:
    """Batches in folders of their own, and a numbered map from day to batch.

    A horizon overwrite writes its batch to a fresh folder, then publishes the
    next map, in which the days of the batch point to that folder and in-range
    days that the batch lacks are gone.  Publishing is one rename: readers see
    the table before or after the overwrite, and a writer that dies in between
    leaves a folder nobody reads.  Two writers at once take turns: the one that
    loses a map number builds its map again on the winner's.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.maps, self.data = f"{self.path}/maps", f"{self.path}/data"

    def _map(self, version: int | None) -> dict[str, str]:
        if version is None:
            return {}
        rows = self.spark.read.schema(_MAP).json(versions.version_path(self.maps, version))
        # One row per day of the table.
        return {r["day"]: r["batch"] for r in rows.collect()}

    def _newest(self) -> int | None:
        return (versions.versions(self.spark, self.maps) or [None])[-1]

    def days(self) -> list[str]:
        """Days present, from the map alone."""
        return sorted(self._map(self._newest()))

    def read(self) -> DataFrame:
        folders = [f"{self.data}/batch={batch}/forecast_date={day}"
                   for day, batch in sorted(self._map(self._newest()).items())]
        if not folders:
            return self.spark.createDataFrame([], S.FORECAST_TABLE)
        df = self.spark.read.schema(S.FORECAST_TABLE).option("basePath", self.data).parquet(*folders)
        return df.select(*S.FORECAST_TABLE.names)

    def write_batch(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Write a batch nobody reads yet; its name and days.

        A row without a day has no partition: it stops the write.
        """
        batch = uuid.uuid4().hex
        folder = f"{self.data}/batch={batch}"
        undated = F.raise_error(F.lit("a forecast row has no forecast_date")).cast("date")
        dated = contract_columns(rows).withColumn(
            "forecast_date", F.coalesce("forecast_date", undated))
        # The hint lets Spark split a day by its size.
        dated.hint("rebalance", "forecast_date").write.partitionBy("forecast_date").parquet(folder)
        names = (_PARTITION.fullmatch(n) for n in versions.folder_names(self.spark, folder))
        days = sorted(m.group(1) for m in names if m)
        if not days:
            raise ValueError("the forecast batch is empty")
        return batch, days

    def publish(self, batch: str, days: list[str]) -> None:
        """Let the days of a batch replace everything inside their interval."""
        while True:
            newest = self._newest()
            kept = {d: b for d, b in self._map(newest).items() if not days[0] <= d <= days[-1]}
            staged = versions.staging_path(self.maps)
            rows = sorted((kept | dict.fromkeys(days, batch)).items())
            self.spark.createDataFrame(rows, _MAP).coalesce(1).write.json(staged)
            if versions.publish_as(self.spark, staged, self.maps, (newest or 0) + 1):
                return
            versions.remove(self.spark, staged)

    def overwrite(self, batch: DataFrame) -> None:
        self.publish(*self.write_batch(batch))

    def vacuum(self, keep_maps: int = 2) -> None:
        """Remove batches that only maps before the last ``keep_maps`` name, and those maps.

        Batches no map names yet stay: their writer may still be at work.
        """
        numbers = versions.versions(self.spark, self.maps)
        old, kept = numbers[:-keep_maps], numbers[-keep_maps:]
        used = {b for n in kept for b in self._map(n).values()}
        for n in old:
            for batch in set(self._map(n).values()) - used:
                versions.remove(self.spark, f"{self.data}/batch={batch}")
            versions.remove(self.spark, versions.version_path(self.maps, n))

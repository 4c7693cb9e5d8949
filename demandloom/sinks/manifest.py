"""Extract folders with a manifest: which files belong, and what they hold.

The manifest is written last, inside the folder, so replacing the data removes
it and a broken write leaves a folder without one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas as S

FOLDER = "_manifest"


class IncompleteExtract(RuntimeError):
    """The files of an extract are not those of its manifest."""


def _bounds(columns) -> list:
    return [e for c in columns for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]


def write_manifest(spark: SparkSession, path: str, grain=S.GRAIN) -> DataFrame:
    """One row per data file: name, rows, bytes, bounds of the grain columns.

    Reads only the grain columns of what was written.
    """
    per_file = spark.read.parquet(path).groupBy(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), *_bounds(grain))
    # A file without rows forms no group, but belongs to the extract.
    listed = _files(spark, path).join(per_file.drop("bytes"), "file", "left")
    listed.withColumn("rows", F.coalesce("rows", F.lit(0))).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/{FOLDER}")
    return read_manifest(spark, path)


def write_extract_with_manifest(df: DataFrame, path: str, rows_per_file: int | None = None,
                                grain=S.GRAIN) -> DataFrame:
    """Extract cut into ranges of the grain, so that bounds tell files apart; its manifest."""
    ranged = df.repartitionByRange(*grain).sortWithinPartitions(*grain)
    writer = ranged.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return write_manifest(df.sparkSession, path, grain)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Data files that are there, by a listing: contents are not read."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(
        name.alias("file"), F.col("length").alias("bytes"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{path}/{FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise IncompleteExtract(f"{path} has no manifest: its write did not finish") from None


def differences(spark: SparkSession, path: str) -> DataFrame:
    """Files missing, strange to the manifest, or of another size."""
    known = read_manifest(spark, path).select("file", F.col("bytes").alias("expected"))
    both = known.join(_files(spark, path), "file", "full")
    verdict = (F.when(F.col("bytes").isNull(), "missing").when(F.col("expected").isNull(), "stray")
               .when(F.col("bytes") != F.col("expected"), "changed"))
    return both.select("file", verdict.alias("difference")).where("difference is not null")


def read_verified(spark: SparkSession, path: str,
                  within: Mapping[str, tuple] | None = None) -> DataFrame:
    """The extract, after its files were held against the manifest.

    ``within`` maps grain columns to closed (low, high) ranges: files whose bounds
    lie outside are not opened, rows outside are filtered.
    """
    found = differences(spark, path).orderBy("file").head(5)
    if found:
        raise IncompleteExtract(f"{path}: " + ", ".join(f"{r.file} {r.difference}" for r in found))
    data = spark.read.parquet(path)
    if not within:
        return data
    kept = read_manifest(spark, path)
    for c, (low, high) in within.items():
        kept = kept.where((F.col(f"max_{c}") >= F.lit(low)) & (F.col(f"min_{c}") <= F.lit(high)))
        data = data.where(F.col(c).between(F.lit(low), F.lit(high)))
    # File names, as Spark's own file index holds them.
    names = [r["file"] for r in kept.select("file").collect()]
    return data.where(F.col("_metadata.file_name").isin(names)) if names else data.limit(0)

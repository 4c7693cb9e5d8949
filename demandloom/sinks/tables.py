"""Full-refresh tables and extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from demandloom import schemas as S


def refresh_path(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace a parquet folder and read it back.

    Reading back gives later plans the true size of the table, which is what
    Spark's broadcast decision looks at.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_mart(mart: DataFrame, path: str) -> DataFrame:
    """Replace the feature mart, partitioned by day, and read it back.

    Recent-history extracts then list and read only their days.  The rebalance
    hint lets Spark split a day by its size, so one heavy day is not one task.
    """
    (
        mart.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path))
    return mart.sparkSession.read.schema(mart.schema).parquet(path).select(*mart.columns)


def refresh_table(df: DataFrame, table: str, buckets: int | None = None,
                  bucket_by: tuple[str, ...] = S.SERIES_KEYS) -> DataFrame:
    """Replace a catalog table.

    With ``buckets`` the rows are distributed and sorted by series on disk, so
    per-series windows over the table need no exchange.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        # One writer task per bucket keeps the file count at `buckets`.
        writer = (df.repartition(buckets, *bucket_by).write.mode("overwrite").format("parquet")
                  .bucketBy(buckets, *bucket_by).sortBy(*bucket_by, "date"))
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_long_csv(df: DataFrame, path: str) -> None:
    """Long sales as gzip CSV with a header in every part file."""
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_extract(df: DataFrame, path: str, rows_per_file: int | None = None) -> DataFrame:
    """Training extract as parquet, sorted by series and day inside each file.

    Written in parallel, clustered by series: no global sort and no single
    stream.  ``rows_per_file`` (25,000 in the chunked form) caps file length.
    """
    clustered = df.repartition(*S.SERIES_KEYS).sortWithinPartitions(*S.GRAIN)
    writer = clustered.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

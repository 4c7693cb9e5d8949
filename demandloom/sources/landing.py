"""Landing-zone layout and readers of the raw files.

Layout: ``<root>/source=<s>/ingest_date=<day>/[<part>/]<file>``.  Every reader
takes a literal ingest date, so only that partition is listed and read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.functions.scalar import blank_to_null


def landing_path(root: str, source_name: str, ingest_date: str, filename: str = "") -> str:
    return "/".join(p for p in (
        root.rstrip("/"), f"source={source_name}", f"ingest_date={ingest_date}", filename) if p)


def part_path(root: str, source_name: str, ingest_date: str, part: str, filename: str) -> str:
    """Per-series / per-location files sit in a folder named after the part."""
    return landing_path(root, source_name, ingest_date, f"{part}/{filename}")


def keyword_path(root: str, source_name: str, ingest_date: str, keyword: str, filename: str) -> str:
    return landing_path(root, source_name, ingest_date, f"keyword={keyword}/{filename}")


def _nulled(df: DataFrame) -> DataFrame:
    return df.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_text_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """Headed CSV with a fixed all-text schema; blank and empty cells are null.

    The header is checked against the schema, so a reordered file fails loudly
    instead of shifting columns.
    """
    return _nulled(
        spark.read.option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").schema(schema).csv(path))


def read_headed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV with whatever columns it has, all as text (quality checks)."""
    return _nulled(spark.read.option("header", True).option("inferSchema", False).csv(path))


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, S.CALENDAR_RAW)


def read_sell_prices(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, S.PRICES_RAW)


def read_wide_sales(spark: SparkSession, path: str, max_columns: int = 20480) -> DataFrame:
    """Wide daily sales: id columns plus one ``d_N`` column per day, all text.

    Empty day cells are null already and blank ones become 0 in the melt, so
    only the id columns need the blank rule; thousands of cell expressions
    would be slower than the rest of the load.
    """
    wide = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("maxColumns", max_columns).csv(path))
    ids = [c for c in wide.columns if c in S.SALES_ID_COLUMNS]
    return wide.withColumns({c: blank_to_null(F.col(c)) for c in ids})


def read_weather_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per location document; leaves stay text until Silver."""
    return spark.read.schema(S.WEATHER_DOCUMENT).option("multiLine", True).json(paths)


def read_macro_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per series document."""
    return spark.read.schema(S.MACRO_DOCUMENT).option("multiLine", True).json(paths)


def read_raw_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole JSON documents as text with their file path, for the quality checks."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("document"))


def interest_column(columns: Iterable[str], keyword: str) -> str:
    """The one column that is not part of the fixed layout carries the values."""
    known = {*S.TRENDS_FIXED_COLUMNS, "isPartial"}
    found = [c for c in columns if c not in known]
    if len(found) != 1:
        raise ValueError(f"keyword {keyword!r}: expected one interest column, found {found}")
    return found[0]


def read_trends(spark: SparkSession, root: str, ingest_date: str,
                keywords: Iterable[str] = tuple(k[0] for k in S.TRENDS_KEYWORDS),
                source_name: str = S.SOURCE_CONTRACTS["trends"]["source_name"]) -> DataFrame:
    """All keyword files of one day in the staging layout.

    Only the header differs per keyword; the driver resolves it from the
    schema, the rows are read in one job.
    """
    filename = S.SOURCE_CONTRACTS["trends"]["filename"]
    parts = []
    for keyword in keywords:
        raw = read_headed_csv(spark, keyword_path(root, source_name, ingest_date, keyword, filename))
        parts.append(normalise_trends(raw, interest_column(raw.columns, keyword)))
    if not parts:
        raise ValueError("no keywords to read")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def normalise_trends(raw: DataFrame, value_column: str) -> DataFrame:
    """Keyword-named value column -> ``interest_value``, ``date`` -> ``trend_date``."""
    renamed = raw.withColumnsRenamed({value_column: "interest_value", "date": "trend_date"})
    return renamed.select(*[F.col(c).cast("string").alias(c) for c in S.TRENDS_RAW.names])


def latest_successful_ingest_date(runs: DataFrame, source_name: str):
    """Newest ingest date of a source among succeeded runs; none is an error."""
    row = latest_successful_run(runs).where(F.col("source_name") == source_name).head()
    if row is None or row["ingest_date"] is None:
        raise LookupError(f"no SUCCEEDED ingestion run for source {source_name!r}")
    return row["ingest_date"]


def latest_successful_run(runs: DataFrame) -> DataFrame:
    """Newest succeeded (ingest_date, ended_at) per source; combines map-side."""
    newest: Column = F.max(F.struct("ingest_date", "ended_at"))
    return (
        runs.where(F.col("status") == "SUCCEEDED")
        .groupBy("source_name").agg(newest.alias("_n"))
        .select("source_name", "_n.ingest_date", "_n.ended_at"))


def date_chunks(bounds: DataFrame, chunk_days: int = 180) -> DataFrame:
    """Split each inclusive (start_date, end_date) row into inclusive chunks.

    A start after its end is an error.
    """
    start, end = F.col("start_date"), F.col("end_date")
    checked = F.when(
        start > end, F.raise_error(F.lit("start_date is after end_date")).cast("date")
    ).otherwise(start)
    starts = F.sequence(checked, end, F.make_dt_interval(F.lit(chunk_days)))
    chunked = bounds.select("*", F.posexplode(starts).alias("_i", "chunk_start"))
    return chunked.select(
        *bounds.columns, (F.col("_i") + 1).alias("chunk_index"), "chunk_start",
        F.least(F.date_add("chunk_start", chunk_days - 1), end).alias("chunk_end"))


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """Parquet extract folder; an empty or missing folder is an error."""
    return spark.read.parquet(path)


def load_mart(spark: SparkSession, table_or_path: str) -> DataFrame:
    """The feature mart with its 23 contract columns (unordered)."""
    is_path = "/" in table_or_path
    df = spark.read.parquet(table_or_path) if is_path else spark.table(table_or_path)
    return df.select(*S.MART_COLUMNS)

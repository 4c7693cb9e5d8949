"""Data-quality suites: each returns a one-row report with counters and ``passed``.

Counters are plain aggregates in one job.  A rule whose column is missing has a
null counter; required rules then fail, optional rules are skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import schemas as S
from demandloom.operators.reshape import day_columns


class DataQualityError(RuntimeError):
    """A gate stopped the pipeline."""


@dataclass(frozen=True)
class Suite:
    dataset: str
    suite: str
    filename: str


# Registered suites and their contracts.
SUITES = {
    "calendar": Suite("calendar", "calendar_basic_v1", "calendar.csv"),
    "sell_prices": Suite("sell_prices", "sell_prices_basic_v1", "sell_prices.csv"),
    "sales_train_validation": Suite(
        "sales_train_validation", "sales_train_validation_basic_v1", "sales_train_validation.csv"),
    "macro_series": Suite("macro_series", "macro_series_basic_v1", "macro_series.json"),
    "weather_daily": Suite("weather_daily", "weather_daily_basic_v1", "daily_weather.json"),
    "trends_interest_over_time": Suite(
        "trends_interest_over_time", "trends_interest_over_time_basic_v1",
        "trends_interest_over_time.csv"),
}
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
CALENDAR_REQUIRED = ("d", "date", "wm_yr_wk", "weekday")
PRICE_KEY = ("store_id", "item_id", "wm_yr_wk")
PRICE_REQUIRED = (*PRICE_KEY, "sell_price")
MACRO_KEYS = {
    "top_level": ("observations", "series_metadata", "ingestion_metadata"),
    "series_metadata": ("series_id", "feature_name", "label", "frequency", "units"),
    "ingestion_metadata": ("source_name", "provider", "schema_version", "ingest_date"),
    "observation": ("date", "value"),
}
WEATHER_KEYS = {
    "top_level": ("latitude", "longitude", "timezone", "daily", "location", "ingestion_metadata"),
    "daily": ("time", *S.WEATHER_MEASURES),
    "location": ("location_id", "state_id", "label", "latitude", "longitude", "timezone"),
    "ingestion_metadata": ("source_name", "provider", "schema_version", "ingest_date"),
}


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)]).cast("array<string>")


def _missing(required: Sequence[str], df: DataFrame) -> list[str]:
    return [c for c in required if c not in df.columns]


def _null_or(df: DataFrame, column: str, build, kind: str = "bigint") -> Column:
    """The counter, or a null of its type when the column does not exist."""
    return build(F.col(f"`{column}`")) if column in df.columns else F.lit(None).cast(kind)


def _nulls(c: Column) -> Column:
    return F.count_if(c.isNull())


def _all_distinct(key: Column, nulls: Column) -> Column:
    """Every value occurs once; a single null is a value of its own."""
    return F.count_distinct(key) + F.least(nulls, F.lit(1)) == F.count(F.lit(1))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name) == 0, F.lit(False))


def _true(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _none_missing(name: str) -> Column:
    return F.size(name) == 0


def _passed(report: DataFrame, rules: Sequence[Column]) -> DataFrame:
    return report.withColumn("passed", reduce(lambda a, b: a & b, rules))


def _has_files(df: DataFrame) -> bool:
    """Do the rows still carry the file and split they were read from?"""
    try:
        return bool(df.select("_metadata.file_path", "_metadata.file_block_start").columns)
    except AnalysisException:
        return False


def non_decreasing(df: DataFrame, value: Column, order: Column | None = None) -> Column:
    """Scalar: is ``value`` non-decreasing in file order (or by ``order``)?

    Without ``order`` the rows of files count in the order of file path, place of
    the split in its file and place in the split, whatever tasks the splits were
    packed into; rows that come from no file count in scan order.  Rows are
    compared inside their split, and only the first and last value of each split
    are compared across splits, so no task sees more than one of them.
    """
    scan = F.monotonically_increasing_id()
    if order is not None:
        rows = df.select(value.alias("v"), order.alias("o")).repartitionByRange("o").withColumn(
            "b", F.struct(F.spark_partition_id()))
    elif _has_files(df):
        split = F.struct("_metadata.file_path", "_metadata.file_block_start")
        rows = df.select(value.alias("v"), scan.alias("o"), split.alias("b"))
    else:
        rows = df.select(value.alias("v"), scan.alias("o"), F.struct(F.spark_partition_id()).alias("b"))
    inside = rows.withColumn("p", F.lag("v").over(Window.partitionBy("b").orderBy("o")))
    blocks = inside.groupBy("b").agg(
        F.min_by("v", "o").alias("first"), F.max_by("v", "o").alias("last"),
        F.count_if(F.col("v") < F.col("p")).alias("drops"))
    # One row per split from here on.
    before = F.lag("last").over(Window.orderBy("b"))
    across = blocks.withColumn("step", (F.col("first") < before).cast("int"))
    return across.agg(
        (F.coalesce(F.sum("drops"), F.lit(0)) + F.coalesce(F.sum("step"), F.lit(0)) == 0)
    ).scalar()


def calendar_checks(df: DataFrame, order: Column | None = None) -> DataFrame:
    """Calendar: key, parseable non-decreasing dates, weekday names, retail week."""
    def day_of(c: Column) -> Column:
        return c.try_cast("date")

    report = df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("cols"),
        _texts(_missing(CALENDAR_REQUIRED, df)).alias("missing_required_columns"),
        _null_or(df, "d", _nulls).alias("pk_nulls"),
        _null_or(df, "d", lambda c: _all_distinct(c, _nulls(c)), "boolean").alias("pk_unique"),
        _null_or(df, "date", _nulls).alias("date_nulls"),
        _null_or(df, "date", lambda c: _nulls(day_of(c))).alias("date_parse_failures"),
        _null_or(df, "weekday", lambda c: F.count_if(
            ~F.coalesce(c.isin(*WEEKDAYS), F.lit(False)))).alias("weekday_invalid_count"),
        _null_or(df, "wm_yr_wk", _nulls).alias("wm_yr_wk_nulls"))
    monotone = F.lit(None).cast("boolean")
    if "date" in df.columns:
        in_order = non_decreasing(df, day_of(F.col("date")), order)
        monotone = F.when(F.col("date_parse_failures") == 0, in_order)
    report = report.withColumn("date_monotonic_non_decreasing", monotone).withColumn(
        "pk_unique", _true("pk_unique"))
    optional = [F.coalesce(F.col(c) == 0, F.lit(True)) for c in (
        "weekday_invalid_count", "wm_yr_wk_nulls")]
    return _passed(report, [
        _none_missing("missing_required_columns"), _zero("pk_nulls"), _true("pk_unique"),
        _zero("date_nulls"), _zero("date_parse_failures"),
        F.coalesce("date_monotonic_non_decreasing", F.lit(True)), *optional])


def sell_price_checks(df: DataFrame) -> DataFrame:
    """Prices: composite key without nulls and unique, price numeric and positive."""
    have_key = all(c in df.columns for c in PRICE_KEY)
    key = F.struct(*PRICE_KEY) if have_key else None
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in PRICE_KEY])
    number = F.col("sell_price").try_cast("double") if "sell_price" in df.columns else None
    number = None if number is None else F.when(~F.isnan(number), number)
    report = df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("cols"),
        _texts(_missing(PRICE_REQUIRED, df)).alias("missing_required_columns"),
        *[(_nulls(F.col(c)) if c in df.columns else F.lit(-1).cast("bigint")).alias(f"{c}_nulls")
          for c in PRICE_KEY],
        (F.count_if(any_null) if have_key else F.lit(None).cast("bigint")).alias("pk_any_nulls"),
        (F.count_distinct(key) == F.count(F.lit(1)) if have_key
         else F.lit(None).cast("boolean")).alias("pk_unique"),
        _null_or(df, "sell_price", _nulls).alias("sell_price_nulls"),
        (_nulls(number) if number is not None
         else F.lit(None).cast("bigint")).alias("sell_price_non_numeric"),
        (F.count_if(number <= 0) if number is not None
         else F.lit(None).cast("bigint")).alias("sell_price_non_positive"))
    return _passed(report, [
        _none_missing("missing_required_columns"), _zero("pk_any_nulls"), _true("pk_unique"),
        _zero("wm_yr_wk_nulls"), _zero("sell_price_nulls"), _zero("sell_price_non_numeric"),
        _zero("sell_price_non_positive")])


def wide_sales_checks(df: DataFrame, sample: int | None = None) -> DataFrame:
    """Wide sales: id unique, day columns present, all cells numeric and not negative.

    ``sample`` looks at the first columns only.  The cells of a row are one array,
    so thousands of day columns are one expression.
    """
    days = day_columns(df.columns, strict=True)
    sampled = days if sample is None else days[:sample]
    cells = F.expr("array(" + ", ".join(f"`{c}`" for c in sampled) + ")").cast("array<string>")

    def total(fault) -> Column:
        if not sampled:
            return F.lit(None).cast("bigint")
        faults = F.filter(cells, lambda c: fault(c.try_cast("double")))
        return F.coalesce(F.sum(F.size(faults)), F.lit(0).cast("bigint"))

    report = df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("cols"),
        _texts(_missing(S.SALES_ID_COLUMNS, df)).alias("missing_required_columns"),
        _null_or(df, "id", _nulls).alias("pk_nulls"),
        _null_or(df, "id", lambda c: _all_distinct(c, _nulls(c)), "boolean").alias("pk_unique"),
        F.lit(len(days)).alias("d_column_count"), F.lit(len(sampled)).alias("d_columns_sampled"),
        total(lambda n: n.isNull() | F.isnan(n)).alias("d_non_numeric_in_sample"),
        total(lambda n: n < 0).alias("d_negative_in_sample"),
    ).withColumn("pk_unique", _true("pk_unique"))
    return _passed(report, [
        _none_missing("missing_required_columns"), _zero("pk_nulls"), _true("pk_unique"),
        F.col("d_column_count") > 0, _zero("d_non_numeric_in_sample"),
        _zero("d_negative_in_sample")])


# -- JSON documents -----------------------------------------------------------


def _absent_keys(required: Sequence[str], json: Column) -> Column:
    """Required keys that a JSON object lacks; anything else lacks them all."""
    wanted = _texts(required)
    return F.coalesce(F.array_except(wanted, F.json_object_keys(json)), wanted)


def _at(document: Column, path: str) -> Column:
    return F.get_json_object(document, f"$.{path}")


def macro_document_checks(documents: DataFrame, document: str = "document",
                          parts: Sequence[str] = ("file",)) -> DataFrame:
    """One report row per macro series document, all documents in one job.

    ``.`` is an allowed value; an observation that is no object misses every key.
    """
    doc = F.col(document)
    raw = _at(doc, "observations")
    listed = F.from_json(raw, "array<string>")
    has_list = F.array_contains(F.json_object_keys(doc), "observations")
    obs = F.when(~F.coalesce(has_list, F.lit(False)), F.array().cast("array<string>")).otherwise(
        F.when(F.json_array_length(raw).isNotNull(), listed))
    is_object = lambda o: F.json_object_keys(o).isNotNull()
    blank = lambda c: c.isNull() | (c == "")
    report = documents.select(
        *parts, doc.alias("_doc"), obs.alias("_obs")).select(
        *parts,
        _absent_keys(MACRO_KEYS["top_level"], F.col("_doc")).alias("missing_top_level_keys"),
        _absent_keys(MACRO_KEYS["series_metadata"], _at(F.col("_doc"), "series_metadata"))
        .alias("missing_series_metadata_keys"),
        _absent_keys(MACRO_KEYS["ingestion_metadata"], _at(F.col("_doc"), "ingestion_metadata"))
        .alias("missing_ingestion_metadata_keys"),
        F.when(F.col("_obs").isNotNull(), F.size("_obs")).alias("observation_count"),
        F.aggregate(
            "_obs", F.lit(0),
            lambda n, o: n + F.size(_absent_keys(MACRO_KEYS["observation"], o)),
        ).alias("missing_observation_keys_count"),
        F.size(F.filter("_obs", lambda o: is_object(o) & blank(_at(o, "date"))))
        .alias("_empty_dates"),
        F.size(F.filter("_obs", lambda o: is_object(o) & blank(_at(o, "value"))))
        .alias("_empty_values"), F.col("_obs").isNotNull().alias("_listed"))
    report = report.withColumns({
        "empty_date_count": F.when(F.col("_listed"), F.col("_empty_dates")),
        "empty_value_count": F.when(F.col("_listed"), F.col("_empty_values")),
    }).drop("_empty_dates", "_empty_values", "_listed")
    return _passed(report, [
        *[_none_missing(c) for c in report.columns if c.startswith("missing_")
          and c.endswith("_keys")],
        F.coalesce(F.col("observation_count") > 0, F.lit(False)),
        _zero("missing_observation_keys_count"), _zero("empty_date_count"),
        _zero("empty_value_count")])


def weather_document_checks(documents: DataFrame, document: str = "document",
                            parts: Sequence[str] = ("file",)) -> DataFrame:
    """One report row per location document: keys, aligned arrays, no negatives."""
    doc = F.col(document)
    daily = _at(doc, "daily")

    def has(name: str) -> Column:
        return F.coalesce(F.array_contains(F.json_object_keys(daily), name), F.lit(False))

    def length(name: str) -> Column:
        return F.when(~has(name), F.lit(0)).otherwise(F.json_array_length(_at(daily, name)))

    def negatives(name: str) -> Column:
        values = F.from_json(_at(daily, name), "array<double>")
        found = F.size(F.filter(values, lambda v: v < 0))
        return F.when(~has(name), F.lit(0)).when(
            F.json_array_length(_at(daily, name)).isNotNull(), found)

    names = WEATHER_KEYS["daily"]
    report = documents.select(
        *parts, _absent_keys(WEATHER_KEYS["top_level"], doc).alias("missing_top_level_keys"),
        _absent_keys(names, daily).alias("missing_daily_keys"),
        _absent_keys(WEATHER_KEYS["location"], _at(doc, "location"))
        .alias("missing_location_keys"),
        _absent_keys(WEATHER_KEYS["ingestion_metadata"], _at(doc, "ingestion_metadata"))
        .alias("missing_ingestion_metadata_keys"),
        *[length(n).alias(f"{n}_length") for n in names],
        negatives("precipitation_sum").alias("precipitation_negative_count"),
        negatives("wind_speed_10m_max").alias("wind_negative_count"))
    same = [F.coalesce(F.col(f"{n}_length") == F.col("time_length"), F.lit(False)) for n in names]
    report = report.withColumn("aligned_series_lengths", reduce(lambda a, b: a & b, same))
    return _passed(report, [
        *[_none_missing(c) for c in report.columns if c.startswith("missing_")],
        F.col("aligned_series_lengths"), F.coalesce(F.col("time_length") > 0, F.lit(False)),
        _zero("precipitation_negative_count"), _zero("wind_negative_count")])


def trends_checks(df: DataFrame) -> DataFrame:
    """One keyword file: layout, exactly one value column, numeric and not negative."""
    value_columns = [c for c in df.columns
                     if c not in S.TRENDS_FIXED_COLUMNS and c.lower() != "ispartial"]
    name = value_columns[0] if len(value_columns) == 1 else None
    number = None if name is None else F.col(f"`{name}`").try_cast("double")
    number = None if number is None else F.when(~F.isnan(number), number)
    unknown = F.lit(None).cast("bigint")
    report = df.agg(
        F.count(F.lit(1)).alias("rows"),
        _texts(_missing(S.TRENDS_FIXED_COLUMNS, df)).alias("missing_required_columns"),
        _null_or(df, "date", _nulls).alias("date_nulls"),
        _null_or(df, "keyword", _nulls).alias("keyword_nulls"),
        _null_or(df, "feature_name", _nulls).alias("feature_name_nulls"),
        F.lit(name).cast("string").alias("interest_column_name"),
        (unknown if number is None else _nulls(number)).alias("interest_nulls"),
        (unknown if number is None else F.count_if(number < 0)).alias("interest_negative_count"))
    return _passed(report, [
        _none_missing("missing_required_columns"), F.col("rows") > 0, _zero("date_nulls"),
        _zero("keyword_nulls"), _zero("feature_name_nulls"),
        F.col("interest_column_name").isNotNull(), _zero("interest_nulls"),
        _zero("interest_negative_count")])


# -- suites and gates ---------------------------------------------------------


def tagged(report: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Prefix a report with the part it belongs to."""
    return report.select(*[F.lit(v).alias(k) for k, v in tags.items()], "*")


#: Names of failing parts that a rolled-up report shows; ``failing_parts`` has all of them.
SHOWN_PARTS = 100


def failing_parts(reports: DataFrame, part: str) -> DataFrame:
    """The parts that fail, a row each, with their report as JSON."""
    failing = reports.where(~F.coalesce("passed", F.lit(False)))
    return failing.select(part, _as_json(failing).alias("details_json"))


def suite_rollup(reports: DataFrame, part: str) -> DataFrame:
    """All parts must pass; failing ones are counted and the first by name are listed.

    The report stays one bounded row however many parts a suite has.
    """
    failed = ~F.coalesce("passed", F.lit(False))
    shown = reports.where(failed).orderBy(part).limit(SHOWN_PARTS).agg(
        F.sort_array(F.collect_list(part))).scalar()
    return reports.agg(
        F.count(F.lit(1)).alias("parts_checked"), F.count_if(failed).alias("parts_failed")).select(
        "*", shown.alias("failing_parts"), (F.col("parts_failed") == 0).alias("passed"))


def _as_json(report: DataFrame) -> Column:
    return F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"})


def details(report: DataFrame) -> DataFrame:
    """The report as one JSON document per row, plus its verdict."""
    return report.select("passed", _as_json(report).alias("details_json"))


def gate(report: DataFrame, audit, run_id: str, what: str) -> None:
    """Record the verdict of a one-row report; a failure stops the caller."""
    row = details(report).first()
    if row["passed"]:
        audit.passed(run_id, row["details_json"])
        return
    audit.failed(run_id, f"{what} checks failed; {row['details_json']}", row["details_json"])
    raise DataQualityError(f"{what} checks failed: {row['details_json']}")

"""Entity schemas, registries and named feature sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SERIES_KEYS = ("store_id", "item_id")
GRAIN = ("store_id", "item_id", "date")

# Prices and macro observations keep four decimals (never integer rounding).
MONEY = T.DecimalType(18, 4)


def strings(*names: str) -> T.StructType:
    """An all-string schema: landed files are typed later, never inferred."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# ---------------------------------------------------------------------------
# Landed file layouts
# ---------------------------------------------------------------------------
CALENDAR_RAW = strings(
    "date", "wm_yr_wk", "weekday", "wday", "month", "year", "d",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI",
)
PRICES_RAW = strings("store_id", "item_id", "wm_yr_wk", "sell_price")
SALES_ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")

SALES_LONG_RAW = T.StructType(
    [T.StructField(n, T.StringType()) for n in (*SALES_ID_COLUMNS, "d")]
    + [T.StructField("sales", T.LongType(), False)]
)
MACRO_RAW = strings(
    "ingest_date", "source_name", "provider", "schema_version", "series_id",
    "feature_name", "series_label", "frequency", "units",
    "observation_date", "observation_value",
)
TRENDS_RAW = strings(
    "ingest_date", "source_name", "provider", "schema_version", "keyword",
    "feature_name", "label", "geo", "trend_date", "interest_value",
)
WEATHER_MEASURES = (
    "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "wind_speed_10m_max",
)
WEATHER_RAW = strings(
    "ingest_date", "source_name", "provider", "schema_version", "location_id",
    "state_id", "location_label", "location_timezone", "latitude", "longitude",
    "weather_date", *WEATHER_MEASURES,
)

# Nested documents are read with every leaf as text, like the flat files.
WEATHER_DOCUMENT = T.StructType([
    T.StructField("daily", T.StructType(
        [T.StructField(n, T.ArrayType(T.StringType())) for n in ("time", *WEATHER_MEASURES)]
    )),
    T.StructField("location", strings(
        "location_id", "state_id", "label", "latitude", "longitude", "timezone")),
    T.StructField("ingestion_metadata", strings(
        "source_name", "provider", "schema_version", "ingest_date")),
])
MACRO_DOCUMENT = T.StructType([
    T.StructField("observations", T.ArrayType(strings("date", "value"))),
    T.StructField("series_metadata", strings(
        "series_id", "feature_name", "label", "frequency", "units")),
    T.StructField("ingestion_metadata", strings(
        "source_name", "provider", "schema_version", "ingest_date")),
])
TRENDS_FIXED_COLUMNS = (
    "date", "keyword", "feature_name", "label", "geo",
    "source_name", "provider", "schema_version", "ingest_date",
)

# ---------------------------------------------------------------------------
# Registries of external series
# ---------------------------------------------------------------------------
MACRO_SERIES = (
    ("CPIAUCSL", "cpi_all_items", "Consumer Price Index for All Urban Consumers: All Items",
     "monthly", "index"),
    ("UNRATE", "unemployment_rate", "Unemployment Rate", "monthly", "percent"),
    ("FEDFUNDS", "federal_funds_rate", "Effective Federal Funds Rate", "monthly", "percent"),
    ("PAYEMS", "nonfarm_payrolls", "All Employees, Total Nonfarm", "monthly", "thousands"),
)
TRENDS_KEYWORDS = (
    ("walmart", "trends_walmart", "Search interest for Walmart", "US"),
    ("grocery store", "trends_grocery_store", "Search interest for grocery store", "US"),
    ("discount store", "trends_discount_store", "Search interest for discount store", "US"),
    ("cleaning supplies", "trends_cleaning_supplies", "Search interest for cleaning supplies", "US"),
)
WEATHER_LOCATIONS = (
    ("CA", "CA", "California", 36.7783, -119.4179, "America/Los_Angeles"),
    ("TX", "TX", "Texas", 31.9686, -99.9018, "America/Chicago"),
    ("WI", "WI", "Wisconsin", 43.7844, -88.7879, "America/Chicago"),
)
MACRO_FEATURES = tuple(s[1] for s in MACRO_SERIES)
TRENDS_FEATURES = tuple(k[1] for k in TRENDS_KEYWORDS)
EXTERNAL_FEATURES = (*WEATHER_MEASURES, *MACRO_FEATURES, *TRENDS_FEATURES)

SOURCE_CONTRACTS = {
    "macro": {"source_name": "macro_fred", "provider": "fred", "schema_version": "v1",
              "filename": "macro_series.json"},
    "trends": {"source_name": "trends_google", "provider": "google_trends",
               "schema_version": "v1", "filename": "trends_interest_over_time.csv"},
    "weather": {"source_name": "weather_openmeteo", "provider": "open_meteo",
                "schema_version": "v1", "filename": "daily_weather.json"},
}


def macro_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(MACRO_SERIES), strings("series_id", "feature_name", "label", "frequency", "units"))


def trends_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(TRENDS_KEYWORDS), strings("keyword", "feature_name", "label", "geo"))


def weather_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(WEATHER_LOCATIONS),
        "location_id string, state_id string, label string, "
        "latitude double, longitude double, timezone string")


# ---------------------------------------------------------------------------
# Feature mart and forecast contracts
# ---------------------------------------------------------------------------
MART_COLUMNS = (
    "id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "date",
    "wm_yr_wk", "sales", "sell_price", *EXTERNAL_FEATURES,
)

FORECAST_TABLE = T.StructType([
    T.StructField("forecast_date", T.DateType()),
    T.StructField("forecast_step", T.IntegerType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("feature_set_name", T.StringType()),
    T.StructField("generated_at", T.TimestampType()),
])

INGESTION_RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("s3_path", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("file_count", T.IntegerType()),
    T.StructField("total_bytes", T.LongType()),
    T.StructField("schema_version", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
])
DQ_RUNS = T.StructType([
    T.StructField("dq_run_id", T.StringType()),
    T.StructField("dataset_name", T.StringType()),
    T.StructField("suite_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("run_duration_seconds", T.LongType()),
    T.StructField("details_json", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
])

# ---------------------------------------------------------------------------
# Model feature columns and the six named sets
# ---------------------------------------------------------------------------
CALENDAR_FEATURES = ("day_of_week", "day_of_month", "week_of_year", "month")
LAG_FEATURES = ("lag_1", "lag_7", "lag_28")
ROLLING_FEATURES = ("rolling_mean_7", "rolling_mean_28")
PRICE_FEATURES = ("sell_price_filled", "sell_price_missing_flag")

DEFAULT_FEATURE_SET = "calendar_lag_rolling_baseline"
_BASE = (*CALENDAR_FEATURES, *LAG_FEATURES, *ROLLING_FEATURES)
FEATURE_SETS = {
    "calendar_lag_rolling_baseline": _BASE,
    "baseline_plus_price": (*_BASE, *PRICE_FEATURES),
    "baseline_plus_weather": (*_BASE, *WEATHER_MEASURES),
    "baseline_plus_macro": (*_BASE, *MACRO_FEATURES),
    "baseline_plus_trends": (*_BASE, *TRENDS_FEATURES),
    "full_feature_set": (
        *_BASE, *PRICE_FEATURES, *WEATHER_MEASURES, *MACRO_FEATURES, *TRENDS_FEATURES),
}


def feature_columns(feature_set: str = DEFAULT_FEATURE_SET) -> list[str]:
    """Columns of a named feature set; unknown names are an error."""
    try:
        return list(FEATURE_SETS[feature_set])
    except KeyError:
        known = ", ".join(sorted(FEATURE_SETS))
        raise ValueError(f"unknown feature set {feature_set!r}; known sets: {known}") from None

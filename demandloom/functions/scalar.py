"""Small column expressions: cleaning, dates, display formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_VALUE = "—"


def blank_to_null(column: Column) -> Column:
    """Empty and blank text is null, the only null rule of the load path."""
    return F.when(F.trim(column) != "", column)


def to_double(column: Column) -> Column:
    """Number or null; NaN counts as null because doubles may come from pandas."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + F.lit(1)


def key_text(*columns: str, sep: str = "|") -> Column:
    """Null-propagating text key, as the SQL ``||`` operator builds it."""
    parts: list[Column] = []
    for i, name in enumerate(columns):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.col(name).cast("string"))
    return F.concat(*parts)


def run_id_text(ts: Column) -> Column:
    """Snapshot run id such as 20240131T040500Z (session time zone UTC)."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def int_text(value: Column) -> Column:
    """Whole number with thousands separators, cut towards zero."""
    whole = F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value))
    return F.coalesce(F.format_number(whole, 0), F.lit(NO_VALUE))


def float_text(value: Column, decimals: int = 1) -> Column:
    return F.coalesce(F.format_number(value.cast("double"), decimals), F.lit(NO_VALUE))


def timestamp_text(value: Column) -> Column:
    """``31 Jan 2024, 04:05 UTC``; unreadable text is shown unchanged."""
    text = value.cast("string")
    shown = F.date_format(F.try_to_timestamp(text), "dd MMM yyyy, HH:mm 'UTC'")
    return F.when(text.isNull() | text.isin("", "NaT"), F.lit(NO_VALUE)).otherwise(
        F.coalesce(shown, text))


def window_label(first_day: Column, last_day: Column) -> Column:
    """One-line label of a forecast window."""
    label = F.concat(
        F.lit("Forecast window: "), F.date_format(first_day, "dd MMM yyyy"),
        F.lit(" to "), F.date_format(last_day, "dd MMM yyyy"))
    return F.coalesce(label, F.lit("No forecast window available"))


# Public display labels.
MODEL_LABELS = {
    "gradient_boosted_trees": "Demand forecasting model",
    "random_forest": "Benchmark demand model",
}
MODEL_LABEL_DEFAULT = "Demand forecasting model"
FEATURE_SET_LABELS = {
    "calendar_lag_rolling_baseline": "Operational demand feature set",
    "baseline_plus_price": "Demand + price feature set",
    "baseline_plus_weather": "Demand + weather feature set",
    "baseline_plus_macro": "Demand + macro feature set",
    "baseline_plus_trends": "Demand + trends feature set",
    "full_feature_set": "Extended demand feature set",
}
FEATURE_SET_LABEL_DEFAULT = "Operational forecast feature set"
DATA_SOURCE_LABELS = {
    "latest": "Latest published snapshot",
    "cache": "Cached snapshot",
    "unavailable": "Currently unavailable",
}
DATA_SOURCE_LABEL_DEFAULT = "Unknown"


def decode(value: Column, labels: Mapping[str, str], default: str) -> Column:
    """Map lookup with a default for unknown or missing codes."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.trim(value)), F.lit(default))


def model_label(value: Column) -> Column:
    return decode(value, MODEL_LABELS, MODEL_LABEL_DEFAULT)


def feature_set_label(value: Column) -> Column:
    return decode(value, FEATURE_SET_LABELS, FEATURE_SET_LABEL_DEFAULT)


def data_source_label(value: Column) -> Column:
    return decode(value, DATA_SOURCE_LABELS, DATA_SOURCE_LABEL_DEFAULT)

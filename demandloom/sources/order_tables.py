"""Map a supplier / part / orders / lineitem schema onto the retail entities.

Nations play stores, part types play items, ship dates play sales days, order
totals play weather, macro and search series.  Everything is derived by Spark
from the given tables in the all-text staging layout, so the same Silver and
Gold operators run on it as on landed files.
"""

from __future__ import annotations

from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandloom import schemas as S
from demandloom.operators import audit, features, gold, monitoring, recursion, reshape, silver
from demandloom.operators.baselines import seasonal_naive
from demandloom.session import scratch_path
from demandloom.sinks.tables import refresh_path, write_mart

FIRST_WEEK = 11101
INGEST_DATE = "2024-01-31"
# Total mappings: the fifth priority and segment share the fourth series and keyword.
PRIORITY_SERIES = dict(zip(
    ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    (*S.MACRO_SERIES, S.MACRO_SERIES[-1])))
SEGMENT_KEYWORDS = dict(zip(
    ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    (*S.TRENDS_KEYWORDS, S.TRENDS_KEYWORDS[-1])))
# Every sixth week lands without price texts, so that missing prices occur.
UNPRICED_WEEKS = 6
# (model version, days of history left out, generated_at) of three stored runs
FORECAST_BATCHES = (
    ("1", 56, "2024-01-01 04:00:00"), ("2", 28, "2024-01-08 04:00:00"),
    ("3", 0, "2024-01-15 04:00:00"))

_SCHEMAS: dict[str, StructType] = {}
# Stored tables by session, folder and name: queries over one folder share them.
_STORED: dict[tuple[str, str, str], DataFrame] = {}


def _coded(column: Column, codes: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.try_element_at(table, column)


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _cents_per(cents: Column, n: Column) -> Column:
    """Mean amount cut to whole cents; integer sums do not depend on row order."""
    return F.floor(cents / n) / 100


class OrderTables:
    """Frames over one folder of parquet tables.

    Frames are lazy, except that the daily aggregate of the lines and the three
    daily external tables are written to the shared folder once per session and
    folder, as a warehouse build would; the given tables must not change
    meanwhile.  Read back, they have a known size: Spark then broadcasts them
    while they are small, and the fact is not shuffled for them; beyond the
    threshold it joins them by shuffle.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is read from the footer once per process."""
        if name not in self._tables:
            path = f"{self.root}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._tables[name]

    # -- dimensions -------------------------------------------------------------

    def _placed(self, df: DataFrame, nation_key: str) -> DataFrame:
        """Attach store and state through nation and region.

        Dimensions join one by one onto the fact, never with each other first:
        each right side is then a table of known size, where the estimate for
        joined dimensions is the product of theirs and rules out a broadcast.
        """
        return (
            df.join(self.table("nation"), F.col(nation_key) == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .withColumnsRenamed({"n_name": "store_id", "r_name": "state_id"}))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with store and item; hot parts or suppliers are split by AQE."""
        supplied = self.table("lineitem").where(F.col("l_shipdate").isNotNull()).join(
            self.table("supplier").select("s_suppkey", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"))
        return (
            self._placed(supplied, "s_nationkey")
            .join(self.table("part").select("p_partkey", F.col("p_type").alias("item_id")),
                  F.col("l_partkey") == F.col("p_partkey"))
            .withColumn("date", F.col("l_shipdate").cast("date")))

    @cached_property
    def daily(self) -> DataFrame:
        """Units and cents per (store, item, day), stored: the only scan of the lines.

        Raw lines combine map-side to the grain; sales, weekly prices and the span
        of days all come from here.
        """
        return self._stored("daily", self.lines.groupBy("item_id", "store_id", "state_id", "date").agg(
            F.sum("l_quantity").cast("bigint").alias("sales"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
            F.sum(_cents("l_extendedprice")).alias("cents")))

    @cached_property
    def days(self) -> DataFrame:
        """Every day from the first to the last sale, numbered from 1; stored."""
        span = self.daily.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        days = span.select(F.posexplode(F.sequence("lo", "hi")).alias("i", "day"))
        return self._stored("days", days.select((F.col("i") + 1).alias("n"), "day"))

    @property
    def first_day(self) -> Column:
        return self.days.agg(F.min("day")).scalar()

    @property
    def last_day(self) -> Column:
        return self.days.agg(F.max("day")).scalar()

    def day_number(self, day: Column) -> Column:
        return F.datediff(day, self.first_day) + 1

    @staticmethod
    def week_of(day_number: Column) -> Column:
        return (F.lit(FIRST_WEEK) + F.floor((day_number - 1) / 7)).cast("int")

    # -- staging ----------------------------------------------------------------

    @cached_property
    def calendar_raw(self) -> DataFrame:
        text = {
            "date": F.col("day"), "wm_yr_wk": self.week_of(F.col("n")),
            "weekday": F.date_format("day", "EEEE"), "wday": F.pmod(F.weekday("day") + 2, 7) + 1,
            "month": F.month("day"), "year": F.year("day"),
            "d": F.concat(F.lit("d_"), F.col("n")),
        }
        missing = F.lit(None).cast("string")
        return self.days.select(*[
            text.get(c, missing).cast("string").alias(c) for c in S.CALENDAR_RAW.names])

    @cached_property
    def sales_raw(self) -> DataFrame:
        """Units per (store, item, day)."""
        return self.daily.select(
            F.concat_ws("_", "item_id", "store_id").alias("id"), "item_id",
            F.concat("item_id", F.lit("_1")).alias("dept_id"), F.col("item_id").alias("cat_id"),
            "store_id", "state_id",
            F.concat(F.lit("d_"), self.day_number(F.col("date"))).alias("d"), "sales")

    @cached_property
    def prices_raw(self) -> DataFrame:
        """Weekly mean price of all lines; some weeks have no price text."""
        week = self.week_of(self.day_number(F.col("date"))).alias("week")
        weekly = self.daily.groupBy("store_id", "item_id", week).agg(
            _cents_per(F.sum("cents"), F.sum("units")).cast("string").alias("text"))
        return weekly.select(
            "store_id", "item_id", F.col("week").cast("string").alias("wm_yr_wk"),
            F.when(F.col("week") % UNPRICED_WEEKS != 0, F.col("text")).alias("sell_price"))

    @cached_property
    def dated_orders(self) -> DataFrame:
        return self.table("orders").select(
            "o_custkey", "o_totalprice", "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("day"))

    @cached_property
    def weather_raw(self) -> DataFrame:
        ordered = self.dated_orders.join(
            self.table("customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"))
        per_day = (
            self._placed(ordered, "c_nationkey")
            .groupBy("state_id", "day")
            .agg(F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
                 F.count(F.lit(1)).alias("n"), F.sum(_cents("o_totalprice")).alias("cents"))
            .withColumn("mean", _cents_per(F.col("cents"), F.col("n"))))
        text = {
            "location_id": F.col("state_id"), "state_id": F.col("state_id"),
            "location_label": F.initcap("state_id"), "location_timezone": F.lit("UTC"),
            "weather_date": F.col("day"),
            "temperature_2m_max": F.col("hi") / 1000,
            "temperature_2m_min": F.col("lo") / 1000,
            "precipitation_sum": F.col("n"),
            "wind_speed_10m_max": F.col("mean") / 1000,
            **self._stamps("weather"),
        }
        return self._staged(per_day, S.WEATHER_RAW, text)

    @cached_property
    def macro_raw(self) -> DataFrame:
        month = F.trunc("day", "month").alias("month")
        coded = {k: v[0] for k, v in PRIORITY_SERIES.items()}
        keyed = self.dated_orders.groupBy(
            _coded(F.col("o_orderpriority"), coded).alias("series_id"), month).agg(
            _cents_per(F.sum(_cents("o_totalprice")), F.count(F.lit(1))).alias("mean"))
        named = reshape.stamp_from_registry(keyed, S.macro_registry(self.spark), "series_id")
        value = F.col("mean").cast("string")
        text = {
            **{c: F.col(c) for c in ("series_id", "feature_name", "frequency", "units")},
            "series_label": F.col("label"), "observation_date": F.col("month"),
            # every July is missing, as the provider marks it
            "observation_value": F.when(F.month("month") == 7, ".").otherwise(value),
            **self._stamps("macro"),
        }
        return self._staged(named, S.MACRO_RAW, text)

    @cached_property
    def trends_raw(self) -> DataFrame:
        coded = {k: v[0] for k, v in SEGMENT_KEYWORDS.items()}
        daily = (
            self.dated_orders
            .join(self.table("customer").select("c_custkey", "c_mktsegment"),
                  F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(_coded(F.col("c_mktsegment"), coded).alias("keyword"), "day")
            .agg(F.count(F.lit(1)).alias("n")))
        # An index from 0 to 100 of the keyword's busiest day; a keyword has a row per day.
        busiest = F.max("n").over(Window.partitionBy("keyword"))
        keyed = daily.select("keyword", "day", F.floor(F.col("n") * 100 / busiest).alias("n"))
        named = reshape.stamp_from_registry(keyed, S.trends_registry(self.spark), "keyword")
        text = {
            **{c: F.col(c) for c in ("keyword", "feature_name", "label", "geo")},
            "trend_date": F.col("day"), "interest_value": F.col("n"),
            **self._stamps("trends"),
        }
        return self._staged(named, S.TRENDS_RAW, text)

    @staticmethod
    def _stamps(kind: str) -> dict[str, Column]:
        fixed = S.SOURCE_CONTRACTS[kind]
        return {"ingest_date": F.lit(INGEST_DATE), **{
            k: F.lit(fixed[k]) for k in ("source_name", "provider", "schema_version")}}

    @staticmethod
    def _staged(df: DataFrame, schema, text: dict[str, Column]) -> DataFrame:
        missing = F.lit(None).cast("string")
        return df.select(*[text.get(c, missing).cast("string").alias(c) for c in schema.names])

    # -- landed shapes ----------------------------------------------------------

    @cached_property
    def wide_sales(self) -> DataFrame:
        """The landed wide layout: one text column per calendar day.

        Spark writes it as CSV lines and reads it like any landed file.  A line
        is as long as the calendar.
        """
        names = [f"d_{r.n}" for r in self.days.orderBy("n").collect()]
        numbered = self.sales_raw.withColumn(
            "n", F.substring_index("d", "_", -1).cast("int"))
        series = numbered.select(*S.SALES_ID_COLUMNS).distinct()
        every_day = series.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))
        cells = every_day.join(
            numbered.select("id", "n", "sales"), ["id", "n"], "left").select(
            *S.SALES_ID_COLUMNS, "n", F.coalesce(F.col("sales").cast("string"), F.lit("")).alias("s"))
        line = F.transform(F.sort_array(F.collect_list(F.struct("n", "s"))), lambda x: x["s"])
        lines = cells.groupBy(*S.SALES_ID_COLUMNS).agg(F.array_join(line, ",").alias("cells"))
        path = scratch_path(self.spark, "wide")
        lines.select(F.concat_ws(",", *S.SALES_ID_COLUMNS, "cells").alias("value")).write.text(path)
        return self.spark.read.schema(S.strings(*S.SALES_ID_COLUMNS, *names)).csv(path)

    @cached_property
    def weather_documents(self) -> DataFrame:
        """One document per location; its arrays are as long as the calendar."""
        days = F.sort_array(F.collect_list(F.struct("weather_date", *S.WEATHER_MEASURES)))
        per_location = self.weather_raw.groupBy(
            "location_id", "state_id", "location_label", "location_timezone",
            "ingest_date", "source_name", "provider", "schema_version").agg(days.alias("days"))
        return per_location.select(
            F.struct(F.col("days.weather_date").alias("time"),
                     *[F.col(f"days.{m}").alias(m) for m in S.WEATHER_MEASURES]).alias("daily"),
            F.struct("location_id", "state_id", F.col("location_label").alias("label"),
                     F.lit(None).cast("string").alias("latitude"),
                     F.lit(None).cast("string").alias("longitude"),
                     F.col("location_timezone").alias("timezone")).alias("location"),
            F.struct("source_name", "provider", "schema_version", "ingest_date")
            .alias("ingestion_metadata"))

    @cached_property
    def macro_documents(self) -> DataFrame:
        """One document per series; its observations are one per month."""
        listed = F.sort_array(F.collect_list(F.struct(
            F.col("observation_date").alias("date"), F.col("observation_value").alias("value"))))
        per_series = self.macro_raw.groupBy(
            "series_id", "feature_name", "series_label", "frequency", "units",
            "ingest_date", "source_name", "provider", "schema_version").agg(listed.alias("obs"))
        return per_series.select(
            F.col("obs").alias("observations"),
            F.struct("series_id", "feature_name", F.col("series_label").alias("label"),
                     "frequency", "units").alias("series_metadata"),
            F.struct("source_name", "provider", "schema_version", "ingest_date")
            .alias("ingestion_metadata"))

    def keyword_file(self, keyword: str) -> DataFrame:
        """The landed file of one keyword: its value column bears the keyword."""
        rows = self.trends_raw.where(F.col("keyword") == keyword)
        return rows.select(
            F.col("trend_date").alias("date"), F.col("interest_value").alias(keyword),
            "keyword", "feature_name", "label", "geo", "source_name", "provider",
            "schema_version", "ingest_date")

    # -- Silver and Gold --------------------------------------------------------

    @cached_property
    def calendar(self) -> DataFrame:
        return silver.calendar(self.calendar_raw)

    @cached_property
    def sales(self) -> DataFrame:
        return silver.sales(self.sales_raw, self.calendar)

    @cached_property
    def prices(self) -> DataFrame:
        return silver.sell_prices(self.prices_raw)

    @cached_property
    def weather(self) -> DataFrame:
        return silver.weather_daily(self.weather_raw)

    @cached_property
    def macro(self) -> DataFrame:
        return silver.macro_series(self.macro_raw)

    @cached_property
    def trends(self) -> DataFrame:
        return silver.trends_interest(self.trends_raw)

    @cached_property
    def sales_days(self) -> DataFrame:
        """Days with sales, stored: at most one row per calendar day."""
        return self._stored("sales_days", silver.sales_dates(self.sales))

    @cached_property
    def macro_aligned(self) -> DataFrame:
        return silver.macro_daily_aligned(self.sales_days, self.macro)

    @cached_property
    def trends_aligned(self) -> DataFrame:
        return silver.trends_daily_aligned(self.sales_days, self.trends)

    @cached_property
    def priced(self) -> DataFrame:
        return silver.with_prices(self.sales, self.calendar, self.prices)

    @cached_property
    def unpriced(self) -> DataFrame:
        """The fact with an empty price, for features that need none: no price join."""
        return self.sales.select(
            *S.SALES_ID_COLUMNS, "d", "date", "sales", F.lit(None).cast(S.MONEY).alias("sell_price"))

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.root, name)
        if key not in _STORED:
            _STORED[key] = refresh_path(df, scratch_path(self.spark, name))
        return _STORED[key]

    @cached_property
    def daily_externals(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Stored weather, macro and search values for every calendar day.

        Calendar days are a superset of the sales days, so joining these to
        the fact equals joining tables cut down to the sales days, without
        computing the fact a second and third time to find its days.
        """
        macro = silver.macro_on_days(self.calendar.select("date"), self.macro)
        trends = self.trends.select(
            F.col("trend_date").alias("date"), "feature_name", "interest_value")
        # Three small independent jobs; Spark runs them side by side.
        frames = {"weather": self.weather, "macro": macro, "trends": trends}
        with ThreadPool(len(frames)) as pool:
            return tuple(pool.starmap(self._stored, frames.items()))

    @cached_property
    def external(self) -> DataFrame:
        return silver.with_external_features(self.sales, *self.daily_externals)

    @cached_property
    def mart(self) -> DataFrame:
        return gold.feature_mart(
            self.sales, self.calendar, self.prices, *self.daily_externals)

    @cached_property
    def stored_mart(self) -> DataFrame:
        """The mart stored by day: extracts read it for bounds, ranks and recent days."""
        key = (self.spark.sparkContext.applicationId, self.root, "mart")
        if key not in _STORED:
            _STORED[key] = write_mart(self.mart, scratch_path(self.spark, "mart"))
        return _STORED[key]

    @cached_property
    def features(self) -> DataFrame:
        return features.build_features(self.mart)

    @cached_property
    def sales_features(self) -> DataFrame:
        """Features of the fact alone: calendar, lags and rolling means."""
        return features.build_features(self.unpriced)

    @cached_property
    def priced_features(self) -> DataFrame:
        """Features of the priced fact, for the sets without external columns."""
        return features.build_features(self.priced)

    # -- forecasts and audit ----------------------------------------------------

    def forecast_run(self, version: str, left_out: int, generated_at: str) -> DataFrame:
        history = self.stored_sales.where(
            F.col("date") <= F.date_sub(self.last_day, left_out))
        return recursion.with_run_metadata(
            recursion.forecast_expression(history, seasonal_naive), "seasonal_naive", version,
            S.DEFAULT_FEATURE_SET, generated_at)

    @cached_property
    def stored_sales(self) -> DataFrame:
        """The fact without prices, stored: every forecast run reads it again."""
        unpriced = self.sales.select(*S.GRAIN, "sales", F.lit(None).cast(S.MONEY).alias("sell_price"))
        return self._stored("sales", unpriced)

    @cached_property
    def forecasts(self) -> DataFrame:
        """The stored forecast table: what monitoring, snapshots and pages read."""
        return self._stored("forecasts", self.forecast_runs)

    @cached_property
    def forecast_runs(self) -> DataFrame:
        """Three forecast runs over growing histories."""
        runs = [self.forecast_run(*run) for run in FORECAST_BATCHES]
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out

    @cached_property
    def freshness(self) -> DataFrame:
        return monitoring.latest_freshness(self.forecasts)

    @cached_property
    def ingestion_runs(self) -> DataFrame:
        status = F.element_at(
            F.array(F.lit("STARTED"), F.lit("SUCCEEDED"), F.lit("FAILED")),
            (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
        return self.table("events").select(
            F.col("event_id").cast("string").alias("run_id"),
            F.col("event_type").alias("source_name"),
            F.col("ts").cast("date").alias("ingest_date"), status.alias("status"),
            F.col("ts").alias("ended_at"))

    @cached_property
    def run_events(self) -> DataFrame:
        """Status events, several per run."""
        e = self.table("events")
        status = F.when(F.pmod("event_id", F.lit(2)) == 0, "SUCCEEDED").otherwise("FAILED")
        return e.select(
            F.col("user_id").cast("string").alias("run_id"),
            F.col("event_type").alias("source_name"), status.alias("status"),
            F.col("value").alias("row_value"),
            # Clipped before the fold, so that long messages are not shuffled.
            audit.clipped_message(F.repeat("props", F.lit(600))).alias("message"),
            F.struct("ts", "event_id").alias("event_ts"))

"""Data refresh: landed files -> gates -> staging -> Silver -> Gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from demandloom import schemas as S
from demandloom.operators import contracts, gold, quality, reshape, silver
from demandloom.operators.audit import QualityLog
from demandloom.sinks.tables import refresh_path, write_mart
from demandloom.sources import landing


@dataclass(frozen=True)
class Landed:
    """Where one day's files lie; the ingest date is a literal, so scans prune."""

    root: str
    ingest_date: str
    retail_source: str = "retail_sales"
    weather_source: str = S.SOURCE_CONTRACTS["weather"]["source_name"]
    macro_source: str = S.SOURCE_CONTRACTS["macro"]["source_name"]
    trends_source: str = S.SOURCE_CONTRACTS["trends"]["source_name"]
    locations: tuple[str, ...] = tuple(x[0] for x in S.WEATHER_LOCATIONS)
    series: tuple[str, ...] = tuple(x[0] for x in S.MACRO_SERIES)
    keywords: tuple[str, ...] = tuple(x[0] for x in S.TRENDS_KEYWORDS)

    def retail(self, filename: str) -> str:
        return landing.landing_path(self.root, self.retail_source, self.ingest_date, filename)

    def weather(self) -> list[str]:
        name = S.SOURCE_CONTRACTS["weather"]["filename"]
        return [landing.part_path(self.root, self.weather_source, self.ingest_date, p, name)
                for p in self.locations]

    def macro(self) -> list[str]:
        name = S.SOURCE_CONTRACTS["macro"]["filename"]
        return [landing.part_path(self.root, self.macro_source, self.ingest_date, p, name)
                for p in self.series]

    def keyword(self, keyword: str) -> str:
        return landing.keyword_path(
            self.root, self.trends_source, self.ingest_date, keyword,
            S.SOURCE_CONTRACTS["trends"]["filename"])


def quality_reports(spark: SparkSession, files: Landed) -> dict[str, DataFrame]:
    """One single-row verdict per dataset."""
    suites = quality.SUITES
    trends = None
    for k in files.keywords:
        raw = landing.read_headed_csv(spark, files.keyword(k))
        report = quality.tagged(quality.trends_checks(raw), {"keyword": k})
        trends = report if trends is None else trends.unionByName(report)

    def headed(name: str) -> DataFrame:
        return landing.read_headed_csv(spark, files.retail(suites[name].filename))

    return {
        "calendar": quality.calendar_checks(headed("calendar")),
        "sell_prices": quality.sell_price_checks(headed("sell_prices")),
        "sales_train_validation": quality.wide_sales_checks(landing.read_wide_sales(
            spark, files.retail(suites["sales_train_validation"].filename))),
        "weather_daily": quality.suite_rollup(quality.weather_document_checks(
            landing.read_raw_documents(spark, files.weather())), "file"),
        "macro_series": quality.suite_rollup(quality.macro_document_checks(
            landing.read_raw_documents(spark, files.macro())), "file"),
        "trends_interest_over_time": quality.suite_rollup(trends, "keyword"),
    }


def run_gates(spark: SparkSession, files: Landed, audit: QualityLog) -> None:
    """Run every suite; the first failure is recorded and stops the refresh."""
    for name, report in quality_reports(spark, files).items():
        suite = quality.SUITES[name]
        run_id = audit.start(suite.dataset, suite.suite)
        try:
            quality.gate(report, audit, run_id, name)
        except quality.DataQualityError:
            raise
        except Exception as error:
            audit.failed(run_id, str(error))
            raise


def staging(spark: SparkSession, files: Landed,
            last_days: int | None = None) -> dict[str, DataFrame]:
    """All-text staging frames."""
    return {
        "calendar": landing.read_calendar(spark, files.retail("calendar.csv")),
        "sell_prices": landing.read_sell_prices(spark, files.retail("sell_prices.csv")),
        "sales": reshape.wide_sales_to_long(
            landing.read_wide_sales(spark, files.retail("sales_train_validation.csv")), last_days),
        "weather": reshape.flatten_weather(
            landing.read_weather_documents(spark, files.weather())),
        "macro": reshape.flatten_macro(landing.read_macro_documents(spark, files.macro())),
        "trends": landing.read_trends(
            spark, files.root, files.ingest_date, files.keywords, files.trends_source),
    }


def build_silver(raw: dict[str, DataFrame], store=None) -> dict[str, DataFrame]:
    """Silver tables by name; ``store(name, df)`` may persist and read back each one."""
    keep = store or (lambda _name, df: df)
    out: dict[str, DataFrame] = {}
    out["silver_calendar"] = keep("silver_calendar", silver.calendar(raw["calendar"]))
    out["silver_sell_prices"] = keep("silver_sell_prices", silver.sell_prices(raw["sell_prices"]))
    out["silver_sales"] = keep("silver_sales", silver.sales(raw["sales"], out["silver_calendar"]))
    out["silver_weather_daily"] = keep(
        "silver_weather_daily", silver.weather_daily(raw["weather"]))
    out["silver_macro_series"] = keep("silver_macro_series", silver.macro_series(raw["macro"]))
    out["silver_trends_interest"] = keep(
        "silver_trends_interest", silver.trends_interest(raw["trends"]))
    out["silver_macro_daily_aligned"] = keep(
        "silver_macro_daily_aligned",
        silver.macro_daily_aligned(out["silver_sales"], out["silver_macro_series"]))
    out["silver_trends_daily_aligned"] = keep(
        "silver_trends_daily_aligned",
        silver.trends_daily_aligned(out["silver_sales"], out["silver_trends_interest"]))
    return out


def build_gold(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    fact, weather = tables["silver_sales"], tables["silver_weather_daily"]
    priced = silver.with_prices(fact, tables["silver_calendar"], tables["silver_sell_prices"])
    return {
        "gold_feature_mart": gold.feature_mart(
            fact, tables["silver_calendar"], tables["silver_sell_prices"], weather,
            tables["silver_macro_daily_aligned"], tables["silver_trends_daily_aligned"]),
        "gold_training_daily": gold.training_daily(priced),
        "gold_training_daily_with_weather": gold.training_daily_with_weather(
            silver.with_weather(fact, weather)),
    }


def run_refresh(
    spark: SparkSession, files: Landed, lake: str, audit: QualityLog | None = None,
    last_days: int | None = None,
) -> dict[str, DataFrame]:
    """Gate, stage, build and store Silver and Gold, then check the contracts."""
    if audit is not None:
        run_gates(spark, files, audit)

    def store(name: str, df: DataFrame) -> DataFrame:
        return refresh_path(df, f"{lake}/{name}")

    tables = build_silver(staging(spark, files, last_days), store)
    for name, df in build_gold(tables).items():
        tables[name] = (write_mart(df, f"{lake}/{name}")
                        if name == "gold_feature_mart" else store(name, df))
    check_contracts(tables)
    return tables


def check_contracts(tables: dict[str, DataFrame]) -> None:
    """Singular and column contracts of stored tables; a broken one is an error."""
    broken: list[str] = []
    for name, df in tables.items():
        if name in contracts.NOT_NULL:
            failing = contracts.column_contract(df, name).where("failures > 0").collect()
            broken += [f"{r.table_name}.{r.column_name}: {r.test_name}" for r in failing]
    singular = {
        "training grain is unique": contracts.grain_unique(tables["gold_training_daily"]),
        "sales are not negative": contracts.sales_non_negative(tables["gold_training_daily"]),
        "prices cover the fact": contracts.price_coverage(tables["gold_training_daily"]),
        "price key is unique": contracts.price_key_unique(tables["silver_sell_prices"]),
    }
    broken += [what for what, failing in singular.items() if not failing.isEmpty()]
    if broken:
        raise quality.DataQualityError("broken contracts: " + "; ".join(broken))

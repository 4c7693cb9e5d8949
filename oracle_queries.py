"""Independent DuckDB SQL for the registered queries.

Each query is a chain of common table expressions over the given tables only;
``sql(body)`` prepends the expressions a body needs.  Doubles are rounded to six
places and dates are text on both sides, so values compare exactly.
"""

from __future__ import annotations

import re


def d(expr: str, name: str) -> str:
    """A double column, rounded; adding zero folds -0.0 into 0.0."""
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {name}"


def t(expr: str, name: str) -> str:
    """A date or code column as text."""
    return f"CAST({expr} AS VARCHAR) AS {name}"


MACRO = ("cpi_all_items", "unemployment_rate", "federal_funds_rate", "nonfarm_payrolls")
TRENDS = ("trends_walmart", "trends_grocery_store", "trends_discount_store",
          "trends_cleaning_supplies")
WEATHER = ("temperature_2m_max", "temperature_2m_min", "precipitation_sum", "wind_speed_10m_max")
IDS = "id, item_id, dept_id, cat_id, store_id, state_id"

BASE = ("day_of_week", "day_of_month", "week_of_year", "month", "lag_1", "lag_7", "lag_28",
        "rolling_mean_7", "rolling_mean_28")
FEATURE_SETS = {
    "calendar_lag_rolling_baseline": BASE,
    "baseline_plus_price": (*BASE, "sell_price_filled", "sell_price_missing_flag"),
    "baseline_plus_weather": (*BASE, *WEATHER),
    "baseline_plus_macro": (*BASE, *MACRO),
    "baseline_plus_trends": (*BASE, *TRENDS),
    "full_feature_set": (*BASE, "sell_price_filled", "sell_price_missing_flag", *WEATHER, *MACRO,
                         *TRENDS),
}

CTES = {
    "stores": """
        SELECT s_suppkey, n_name AS store_id, r_name AS state_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "span": """
        SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi
        FROM lineitem""",
    "cal": """
        SELECT 'd_' || CAST(n AS VARCHAR) AS d, lo + CAST(n - 1 AS INTEGER) AS date,
               CAST(11101 + (n - 1) // 7 AS INTEGER) AS wm_yr_wk, n
        FROM (SELECT lo, unnest(generate_series(1, date_diff('day', lo, hi) + 1)) AS n FROM span)""",
    "calraw": """
        SELECT d, CAST(date AS VARCHAR) AS date, CAST(wm_yr_wk AS VARCHAR) AS wm_yr_wk,
               dayname(date) AS weekday, n FROM cal""",
    "fact": """
        SELECT p_type || '_' || store_id AS id, p_type AS item_id, p_type || '_1' AS dept_id,
               p_type AS cat_id, store_id, state_id, CAST(l_shipdate AS DATE) AS date,
               CAST(sum(l_quantity) AS INTEGER) AS sales
        FROM lineitem JOIN stores ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        GROUP BY ALL""",
    "sales": "SELECT f.*, c.d, c.wm_yr_wk, c.n FROM fact f JOIN cal c USING (date)",
    "prices": """
        SELECT store_id, p_type AS item_id, c.wm_yr_wk,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT))
                 // sum(CAST(l_quantity AS BIGINT)) AS DECIMAL(18,4)) / 100 AS sell_price
        FROM lineitem JOIN stores ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        JOIN cal c ON c.date = CAST(l_shipdate AS DATE)
        WHERE c.wm_yr_wk % 6 <> 0 GROUP BY ALL HAVING sell_price > 0""",
    "ords": """
        SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderpriority, c_mktsegment,
               r_name AS state_id
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "weather": """
        SELECT state_id, day AS date, max(o_totalprice) / 1000 AS temperature_2m_max,
               min(o_totalprice) / 1000 AS temperature_2m_min,
               CAST(count(*) AS DOUBLE) AS precipitation_sum,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS DOUBLE) / 100 / 1000
                 AS wind_speed_10m_max
        FROM ords GROUP BY ALL""",
    "series": """
        SELECT * FROM (VALUES
          ('1-URGENT', 'CPIAUCSL', 'cpi_all_items',
           'Consumer Price Index for All Urban Consumers: All Items', 'index'),
          ('2-HIGH', 'UNRATE', 'unemployment_rate', 'Unemployment Rate', 'percent'),
          ('3-MEDIUM', 'FEDFUNDS', 'federal_funds_rate', 'Effective Federal Funds Rate', 'percent'),
          ('4-NOT SPECIFIED', 'PAYEMS', 'nonfarm_payrolls', 'All Employees, Total Nonfarm',
           'thousands'),
          ('5-LOW', 'PAYEMS', 'nonfarm_payrolls', 'All Employees, Total Nonfarm',
           'thousands')) s(priority, series_id, feature_name, series_label, units)""",
    "macro": """
        SELECT series_id, feature_name, series_label, units, month AS observation_date,
               CASE WHEN month(month) <> 7 THEN CAST(mean AS DECIMAL(18,4)) END
                 AS observation_value
        FROM (SELECT series_id, feature_name, series_label, units,
                     CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                     CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS DOUBLE) / 100
                       AS mean FROM orders JOIN series ON priority = o_orderpriority GROUP BY ALL)""",
    "keywords": """
        SELECT * FROM (VALUES
          ('AUTOMOBILE', 'walmart', 'trends_walmart', 'Search interest for Walmart'),
          ('BUILDING', 'grocery store', 'trends_grocery_store', 'Search interest for grocery store'),
          ('FURNITURE', 'discount store', 'trends_discount_store',
           'Search interest for discount store'),
          ('HOUSEHOLD', 'cleaning supplies', 'trends_cleaning_supplies',
           'Search interest for cleaning supplies'),
          ('MACHINERY', 'cleaning supplies', 'trends_cleaning_supplies',
           'Search interest for cleaning supplies')) k(segment, keyword, feature_name, label)""",
    "trends": """
        SELECT keyword, feature_name, label, trend_date,
               CAST(n * 100 // max(n) OVER (PARTITION BY keyword) AS INTEGER) AS interest_value
        FROM (SELECT keyword, feature_name, label, day AS trend_date, count(*) AS n
              FROM ords JOIN keywords ON segment = c_mktsegment GROUP BY ALL)""",
    "salesdates": "SELECT DISTINCT date FROM sales",
    "macroday": """
        SELECT date, feature_name, source_observation_date, observation_value FROM (
          SELECT s.date, f.feature_name, m.observation_date AS source_observation_date,
                 m.observation_value,
                 row_number() OVER (PARTITION BY s.date, f.feature_name
                                    ORDER BY m.observation_date DESC) AS rn
          FROM salesdates s CROSS JOIN (SELECT DISTINCT feature_name FROM macro) f
          JOIN macro m ON m.feature_name = f.feature_name AND m.observation_date <= s.date
          WHERE m.observation_value IS NOT NULL) WHERE rn = 1""",
    "macrowide": "SELECT date, " + ", ".join(
        f"max(observation_value) FILTER (feature_name = '{f}') AS {f}" for f in MACRO)
        + " FROM macroday GROUP BY date",
    "trendswide": "SELECT trend_date AS date, " + ", ".join(
        f"max(interest_value) FILTER (feature_name = '{f}') AS {f}" for f in TRENDS)
        + " FROM trends GROUP BY trend_date",
    "priced": f"""
        SELECT {IDS}, d, date, s.wm_yr_wk, sales, sell_price
        FROM sales s LEFT JOIN prices USING (store_id, item_id, wm_yr_wk)""",
    "mart": f"""
        SELECT p.*, {', '.join(WEATHER + MACRO + TRENDS)}
        FROM priced p LEFT JOIN weather w ON p.state_id = w.state_id AND p.date = w.date
        LEFT JOIN macrowide m ON p.date = m.date LEFT JOIN trendswide t ON p.date = t.date""",
    "feat": """
        SELECT m.*, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
               CAST(day(date) AS INTEGER) AS day_of_month,
               CAST(week(date) AS INTEGER) AS week_of_year, CAST(month(date) AS INTEGER) AS month,
               CAST(lag(sales, 1) OVER w AS DOUBLE) AS lag_1,
               CAST(lag(sales, 7) OVER w AS DOUBLE) AS lag_7,
               CAST(lag(sales, 28) OVER w AS DOUBLE) AS lag_28,
               CASE WHEN count(sales) OVER w7 = 7 THEN avg(sales) OVER w7 END AS rolling_mean_7,
               CASE WHEN count(sales) OVER w28 = 28 THEN avg(sales) OVER w28 END AS rolling_mean_28,
               CAST(sell_price IS NULL AS INTEGER) AS sell_price_missing_flag,
               CAST(coalesce(
                 last_value(sell_price IGNORE NULLS) OVER (wn ROWS UNBOUNDED PRECEDING),
                 first_value(sell_price IGNORE NULLS) OVER (
                   wn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS DOUBLE)
                 AS sell_price_filled
        FROM mart m
        WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date),
               wn AS (PARTITION BY store_id, item_id ORDER BY date),
               w7 AS (PARTITION BY store_id, item_id ORDER BY date
                      ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
               w28 AS (PARTITION BY store_id, item_id ORDER BY date
                       ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    "modeling": "SELECT * FROM feat WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in BASE),
    "windows": """
        SELECT w AS window_no, hi - CAST((w - 1) * 28 + 27 AS INTEGER) AS test_start,
               hi - CAST((w - 1) * 28 AS INTEGER) AS test_end
        FROM (SELECT max(date) AS hi FROM modeling), range(1, 6) r(w)""",
    "wrmsse": """
        SELECT model_name, window_no, count(rmsse) AS series_count,
               count(*) FILTER (rmsse IS NULL) AS undefined_series,
               sum(rmsse * weight) / sum(weight) FILTER (rmsse IS NOT NULL) AS wrmsse
        FROM (SELECT model_name, window_no, weight,
                     CASE WHEN train_rows >= 2 AND scale > 0 THEN sqrt(mse / scale) END AS rmsse
              FROM (SELECT window_no, store_id, item_id, m.model_name, avg((m.p - sales) ** 2) AS mse
                    FROM (SELECT *, unnest([{'model_name': 'naive_lag_1', 'p': lag_1},
                                            {'model_name': 'seasonal_naive_lag_7', 'p': lag_7},
                                            {'model_name': 'rolling_mean_7', 'p': rolling_mean_7}]) AS m
                          FROM modeling) JOIN windows ON date BETWEEN test_start AND test_end GROUP BY ALL)
              LEFT JOIN (
                SELECT window_no, store_id, item_id, count(*) AS train_rows, avg(step ** 2) AS scale,
                       coalesce(sum(sales) FILTER (date >= test_start - 28), 0) AS weight
                FROM (SELECT *, CAST(sales AS DOUBLE) - lag(sales) OVER (
                        PARTITION BY store_id, item_id ORDER BY date) AS step FROM sales), windows
                WHERE date < test_start GROUP BY ALL) USING (window_no, store_id, item_id))
        GROUP BY ALL""",
    "series_scale": """
        SELECT window_no, store_id, item_id, count(*) AS train_rows, avg(step ** 2) AS scale,
               coalesce(sum(sales) FILTER (date >= test_start - 28), 0) AS weight
        FROM (SELECT *, CAST(sales AS DOUBLE) - lag(sales) OVER (
                PARTITION BY store_id, item_id ORDER BY date) AS step FROM sales), windows
        WHERE date < test_start GROUP BY ALL""",
    "series_rmsse": """
        SELECT model_name, window_no, store_id, item_id, sqrt(mse / scale) AS rmsse, weight
        FROM (SELECT window_no, store_id, item_id, m.model_name, avg((m.p - sales) ** 2) AS mse
              FROM (SELECT *, unnest([{'model_name': 'naive_lag_1', 'p': lag_1},
                                      {'model_name': 'seasonal_naive_lag_7', 'p': lag_7},
                                      {'model_name': 'rolling_mean_7', 'p': rolling_mean_7}]) AS m
                    FROM modeling) JOIN windows ON date BETWEEN test_start AND test_end GROUP BY ALL)
        JOIN series_scale USING (window_no, store_id, item_id) WHERE train_rows >= 2 AND scale > 0""",
    "lines_fit": """
        SELECT window_no, regr_slope(sales, lag_7) AS slope, regr_intercept(sales, lag_7) AS intercept
        FROM windows JOIN modeling ON date < test_start GROUP BY window_no""",
    "whole_fit": """
        SELECT regr_slope(sales, lag_7) AS slope, regr_intercept(sales, lag_7) AS intercept
        FROM modeling""",
    "fc_hist": """
        SELECT v, store_id, item_id, date, sales,
               row_number() OVER (PARTITION BY v, store_id, item_id ORDER BY date DESC) AS rn,
               max(date) OVER (PARTITION BY v, store_id, item_id) AS last_date
        FROM sales, span, (VALUES ('1', 56), ('2', 28), ('3', 0)) b(v, skip)
        WHERE date <= hi - skip""",
    "forecasts": """
        SELECT s.last_date + CAST(k AS INTEGER) AS forecast_date,
               CAST(k AS INTEGER) AS forecast_step, s.store_id, s.item_id,
               CAST(h.sales AS DOUBLE) AS prediction, 'seasonal_naive' AS model_name,
               s.v AS model_version, 'calendar_lag_rolling_baseline' AS feature_set_name,
               CASE s.v WHEN '1' THEN TIMESTAMP '2024-01-01 04:00:00'
                        WHEN '2' THEN TIMESTAMP '2024-01-08 04:00:00'
                        ELSE TIMESTAMP '2024-01-15 04:00:00' END AS generated_at
        FROM (SELECT DISTINCT v, store_id, item_id, last_date FROM fc_hist) s
        CROSS JOIN range(1, 29) r(k)
        LEFT JOIN fc_hist h ON h.v = s.v AND h.store_id = s.store_id AND h.item_id = s.item_id
          AND h.rn = 7 - (k - 1) % 7""",
    "monitoring": """
        SELECT generated_at, model_name, model_version, feature_set_name,
               min(forecast_date) AS min_forecast_date, max(forecast_date) AS max_forecast_date,
               count(*) AS forecast_row_count,
               count(DISTINCT store_id || '|' || item_id) AS forecast_series_count
        FROM forecasts GROUP BY ALL""",
    "freshness": """
        SELECT *, CAST(max_forecast_date - min_forecast_date + 1 AS INTEGER) AS forecast_horizon_days
        FROM monitoring WHERE generated_at = (SELECT max(generated_at) FROM forecasts)""",
    "latest": "SELECT * FROM forecasts WHERE model_version = '3'",
    "runs": """
        SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS source_name,
               CAST(ts AS DATE) AS ingest_date,
               CASE event_id % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUCCEEDED' ELSE 'FAILED' END
                 AS status, ts AS ended_at FROM events""",
    "dirtycal": """
        SELECT CASE WHEN n % 50 = 0 THEN 'd_' || CAST(n - 1 AS VARCHAR) ELSE d END AS d,
               CASE WHEN n % 400 = 0 THEN 'unknown' ELSE date END AS date,
               CASE WHEN n % 30 = 0 THEN NULL ELSE wm_yr_wk END AS wm_yr_wk,
               CASE WHEN n % 13 = 0 THEN lower(weekday) ELSE weekday END AS weekday, n FROM calraw""",
    "pricesraw": """
        SELECT store_id, p_type AS item_id, CAST(c.wm_yr_wk AS VARCHAR) AS wm_yr_wk,
               CASE WHEN c.wm_yr_wk % 6 <> 0 THEN
                 CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT))
                   // sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 END AS sell_price
        FROM lineitem JOIN stores ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        JOIN cal c ON c.date = CAST(l_shipdate AS DATE) GROUP BY store_id, p_type, c.wm_yr_wk""",
    "obs": """
        SELECT series_id, observation_date,
               CASE WHEN series_id = 'UNRATE' AND month(observation_date) = 3 THEN '' ELSE 'x' END
                 AS value,
               CASE WHEN series_id = 'PAYEMS' AND month(observation_date) = 2 THEN '' ELSE 'x' END
                 AS date FROM macro""",
    "macrocheck": """
        SELECT series_id, count(*) AS observation_count, 0 AS missing_observation_keys_count,
               count(*) FILTER (date = '') AS empty_date_count,
               count(*) FILTER (value = '') AS empty_value_count,
               count(*) FILTER (date = '' OR value = '') = 0 AS passed FROM obs GROUP BY ALL""",
    "grid": """
        WITH tagged AS (
          SELECT s.name, f.date, f.sales, f.lag_1, f.lag_7, f.rolling_mean_7
          FROM feat f JOIN (VALUES """ + ", ".join(f"('{n}')" for n in FEATURE_SETS) + """) s(name)
          ON CASE s.name """ + " ".join(
              f"WHEN '{n}' THEN " + " AND ".join(f"f.{c} IS NOT NULL" for c in cols)
              for n, cols in FEATURE_SETS.items()) + """ END),
        numbered AS (
          SELECT *, 1 + (max(date) OVER (PARTITION BY name) - date) // 28 AS w FROM tagged),
        scored AS (
          SELECT name, w, sales, 'naive_lag_1' AS model, lag_1 AS p FROM numbered
          UNION ALL SELECT name, w, sales, 'seasonal_naive_lag_7', lag_7 FROM numbered
          UNION ALL SELECT name, w, sales, 'rolling_mean_7', rolling_mean_7 FROM numbered)
        SELECT name AS feature_set_name, model AS model_name, CAST(w AS INTEGER) AS window_no,
               count(*) AS test_rows, sum(abs(p - sales)) / sum(sales) AS wmape,
               avg(abs(p - sales)) AS mae, sqrt(avg((p - sales) ** 2)) AS rmse
        FROM scored WHERE w <= 5 GROUP BY ALL""",
    "rmsse": """
        SELECT store_id, item_id, test_rows, coalesce(train_rows, 0) AS train_rows, scale,
               CASE WHEN train_rows >= 2 AND scale > 0 THEN sqrt(mse / scale) END AS rmsse
        FROM (SELECT store_id, item_id, count(*) AS test_rows, avg((lag_7 - sales) ** 2) AS mse
              FROM modeling, windows WHERE window_no = 1 AND date BETWEEN test_start AND test_end
              GROUP BY ALL)
        LEFT JOIN (SELECT store_id, item_id, count(*) AS train_rows, avg(step ** 2) AS scale
              FROM (SELECT store_id, item_id,
                           CAST(sales AS DOUBLE) - lag(sales) OVER (
                             PARTITION BY store_id, item_id ORDER BY date) AS step
                    FROM feat, windows WHERE window_no = 1 AND date < test_start) GROUP BY ALL)
        USING (store_id, item_id)""",
}


def _needed(body: str) -> list[str]:
    """CTEs a body mentions, with what those mention, in declaration order."""
    found: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & CTES.keys()) - found:
            found.add(name)
            todo.append(CTES[name])
    return [n for n in CTES if n in found]


def sql(body: str) -> str:
    """Prepend the CTEs; a body may start with ", name AS (...)" to add its own."""
    text = body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in _needed(text))
    recursive = "RECURSIVE " if "FROM steps" in text else ""
    return f"WITH {recursive}{head}\n{text}" if head else text


def _columns(names, doubles=(), texts=("date",)) -> str:
    return ", ".join(
        d(n, n) if n in doubles else t(n, n) if n in texts else n for n in names)


MART = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "date", "wm_yr_wk",
        "sales", "sell_price", *WEATHER, *MACRO, *TRENDS)
MART_DOUBLES = ("sell_price", *WEATHER, *MACRO)
FEATURE_DOUBLES = ("lag_1", "lag_7", "lag_28", "rolling_mean_7", "rolling_mean_28",
                   "sell_price_filled", *MART_DOUBLES, *TRENDS)
MART_ROWS = f"SELECT {_columns(MART, MART_DOUBLES)}"
FORECAST = ("forecast_date", "forecast_step", "store_id", "item_id", "prediction", "model_name",
            "model_version", "feature_set_name", "generated_at")
FORECAST_ROWS = f"SELECT {_columns(FORECAST, ('prediction',), ('forecast_date', 'generated_at'))}"
RUN_TEXTS = ("generated_at", "min_forecast_date", "max_forecast_date")
MONITORING = ("generated_at", "model_name", "model_version", "feature_set_name",
              "min_forecast_date", "max_forecast_date", "forecast_row_count",
              "forecast_series_count")


def _backtest(prediction: str, windows: str = "windows") -> str:
    return f"""
        SELECT CAST(window_no AS INTEGER) AS window_no,
          (SELECT CAST(min(date) AS VARCHAR) FROM modeling WHERE date < test_start)
            AS train_start_date,
          (SELECT CAST(max(date) AS VARCHAR) FROM modeling WHERE date < test_start)
            AS train_end_date,
          CAST(min(date) AS VARCHAR) AS test_start_date, CAST(max(date) AS VARCHAR) AS test_end_date,
          (SELECT count(*) FROM modeling WHERE date < test_start) AS train_rows,
          count(*) AS test_rows, {d(f'sum(abs({prediction} - sales)) / sum(sales)', 'wmape')},
          {d(f'avg(abs({prediction} - sales))', 'mae')},
          {d(f'sqrt(avg(({prediction} - sales) ** 2))', 'rmse')}
        FROM {windows} JOIN modeling ON date BETWEEN test_start AND test_end
        GROUP BY window_no, test_start"""


def _recursive(model: str) -> str:
    """Step-by-step recursion on a list of the last 28 sales."""
    return f"""
        , tails AS (
          SELECT store_id, item_id, max(date) AS last_date,
                 list(CAST(sales AS DOUBLE) ORDER BY date) AS h
          FROM (SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rn
                FROM sales) WHERE rn <= 28 GROUP BY ALL),
        steps AS (
          SELECT store_id, item_id, last_date, 0 AS step, h, CAST(NULL AS DOUBLE) AS p FROM tails
          UNION ALL
          SELECT store_id, item_id, last_date, step + 1, list_append(h, {model}), {model}
          FROM steps WHERE step < 28)
        SELECT store_id, item_id, CAST(last_date + step AS VARCHAR) AS forecast_date,
               step AS forecast_step, {d('p', 'prediction')} FROM steps WHERE step > 0"""


#: Chances that a Poisson(1) number is at most 0, 1, ... 7.
POISSON = (0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815, 0.999916759, 0.999989751)


def _leafwise() -> str:
    """Two boosted trees of two leaves each, by trying every split, and the recursion with them."""
    parts, score = "", "b"
    for k in (1, 2):
        prior = "" if k == 1 else "".join(f", tree{i}" for i in range(1, k))
        parts += f"""
        , slopes{k} AS (SELECT lag_1, lag_7, {score} - sales AS g FROM modeling, base{prior}),
        sides{k} AS (
          SELECT f, e, count(*) FILTER (x <= e) AS nl, count(*) FILTER (x > e) AS nr,
                 sum(g) FILTER (x <= e) AS gl, sum(g) FILTER (x > e) AS gr
          FROM (SELECT 1 AS f, lag_1 AS x, g FROM slopes{k} UNION ALL SELECT 2, lag_7, g FROM slopes{k}),
               (VALUES (1), (2), (5), (10), (20), (30), (40)) edges(e) GROUP BY ALL),
        tree{k} AS (
          SELECT f AS f{k}, e AS e{k}, -gl / nl AS l{k}, -gr / nr AS r{k} FROM sides{k} WHERE nl > 0 AND nr > 0
          ORDER BY round(gl * gl / nl + gr * gr / nr - (gl + gr) ** 2 / (nl + nr), 6) DESC, f, e LIMIT 1)"""
        score += f" + 0.5 * CASE WHEN CASE f{k} WHEN 1 THEN lag_1 ELSE lag_7 END <= e{k} THEN l{k} ELSE r{k} END"
    model = score.replace("lag_1", "h[-1]").replace("lag_7", "h[-7]")
    recursion = _recursive(f"(SELECT {model} FROM base, tree1, tree2)")
    return f", base AS (SELECT avg(CAST(sales AS DOUBLE)) AS b FROM modeling){parts}{recursion}"


def _not_null(table: str, name: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'not_null' AS test_name, "
        f"count(*) FILTER ({c} IS NULL) AS failures FROM {table}" for c in columns)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_calendar"] = f"""
        SELECT d, {t('date', 'date')}, wm_yr_wk, dayname(date) AS weekday,
               CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) AS INTEGER) AS day_of_week
        FROM cal"""
    q["silver_sales"] = f"SELECT {IDS}, d, {t('date', 'date')}, sales FROM sales"
    q["silver_prices"] = f"SELECT store_id, item_id, wm_yr_wk, {d('sell_price', 'sell_price')} FROM prices"
    q["silver_weather"] = f"""
        SELECT state_id AS location_id, state_id, {t('date', 'weather_date')},
               {_columns(WEATHER, WEATHER)} FROM weather"""
    q["silver_trends"] = f"""
        SELECT keyword, feature_name, label, 'US' AS geo, {t('trend_date', 'trend_date')},
               interest_value FROM trends"""
    q["silver_macro_series"] = f"""
        SELECT series_id, feature_name, series_label, 'monthly' AS frequency, units,
               {t('observation_date', 'observation_date')},
               {d('observation_value', 'observation_value')} FROM macro"""
    for key, keep in (("wide_to_long_sales", "TRUE"),
                      ("wide_to_long_last_90", "n > (SELECT max(n) FROM cal) - 90")):
        q[key] = f"""
            SELECT s.*, c.d, CAST(coalesce(f.sales, 0) AS BIGINT) AS sales
            FROM (SELECT DISTINCT {IDS} FROM fact) s CROSS JOIN (SELECT d, date, n FROM cal) c
            LEFT JOIN fact f ON f.store_id = s.store_id AND f.item_id = s.item_id
              AND f.date = c.date WHERE {keep}"""
    q["landed_silver_calendar"], q["landed_silver_prices"] = q["silver_calendar"], q["silver_prices"]
    q["landed_silver_weather"], q["landed_silver_trends"] = q["silver_weather"], q["silver_trends"]
    q["landed_silver_macro_series"] = q["silver_macro_series"]
    q["landed_silver_sales"] = f"""
        SELECT s.*, c.d, {t('c.date', 'date')}, CAST(coalesce(f.sales, 0) AS INTEGER) AS sales
        FROM (SELECT DISTINCT {IDS} FROM fact) s CROSS JOIN (SELECT d, date FROM cal) c
        LEFT JOIN fact f ON f.store_id = s.store_id AND f.item_id = s.item_id AND f.date = c.date"""
    q["landed_gates"] = """
        SELECT 'calendar' AS dataset, count(*) = count(DISTINCT d) AS passed FROM calraw
        UNION ALL SELECT 'sell_prices', count(*) FILTER (sell_price IS NULL OR sell_price <= 0) = 0
          FROM pricesraw
        UNION ALL SELECT 'sales_train_validation', (SELECT max(n) FROM cal)
          * (SELECT count(DISTINCT id) FROM fact) = (SELECT count(*) FROM sales)
        UNION ALL SELECT 'weather_daily', count(*) FILTER (precipitation_sum < 0
          OR wind_speed_10m_max < 0) = 0 FROM weather
        UNION ALL SELECT 'macro_series', count(*) FILTER (observation_date IS NULL) = 0 FROM macro
        UNION ALL SELECT 'trends_interest_over_time', count(*) FILTER (interest_value IS NULL
          OR interest_value < 0) = 0 FROM trends"""
    q["flatten_weather_documents"] = q["silver_weather"]
    q["flatten_macro_documents"] = q["silver_macro_series"]
    q["normalise_keyword_files"] = q["silver_trends"]
    q["date_chunks"] = f"""
        SELECT store_id, CAST(k AS INTEGER) AS chunk_index,
               CAST(lo + CAST((k - 1) * 180 AS INTEGER) AS VARCHAR) AS chunk_start,
               CAST(least(lo + CAST(k * 180 - 1 AS INTEGER), hi) AS VARCHAR) AS chunk_end
        FROM (SELECT store_id, min(date) AS lo, max(date) AS hi FROM sales GROUP BY store_id) b,
             range(1, 1000) r(k) WHERE lo + CAST((k - 1) * 180 AS INTEGER) <= hi"""
    q["sales_date_range"] = f"SELECT {t('min(date)', 'min_date')}, {t('max(date)', 'max_date')} FROM sales"
    q["dedup_keep_last"] = f"""
        SELECT event_type, CAST(ts AS DATE)::VARCHAR AS day, event_id, user_id, {d('value', 'value')}
        FROM events QUALIFY row_number() OVER (
          PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""
    aligned = f"""
        SELECT {t('date', 'date')}, feature_name,
               {t('source_observation_date', 'source_observation_date')},
               {d('observation_value', 'observation_value')} FROM macroday"""
    q["asof_macro_daily"] = q["asof_macro_window"] = aligned
    q["trends_daily_aligned"] = f"""
        SELECT {t('date', 'date')}, feature_name, {t('trend_date', 'source_trend_date')},
               interest_value FROM trends JOIN salesdates ON date = trend_date"""
    q["external_features"] = f"""
        SELECT {_columns([c for c in MART if c not in ('wm_yr_wk', 'sell_price')], MART_DOUBLES)}
        FROM mart"""
    q["macro_by_day"] = f"SELECT {t('date', 'date')}, {_columns(MACRO, MACRO)} FROM macrowide"
    q["sales_with_prices"] = f"SELECT {_columns(MART[:11], MART_DOUBLES)} FROM priced"
    q["sales_with_weather"] = f"""
        SELECT {_columns([*MART[:8], 'sales', *WEATHER], MART_DOUBLES)} FROM mart"""
    q["gold_feature_mart"] = q["gold_feature_mart_from_parts"] = f"{MART_ROWS} FROM mart"
    q["gold_training_daily"] = f"""
        SELECT store_id, item_id, {t('date', 'date')}, state_id, cat_id, dept_id, wm_yr_wk, sales,
               {d('sell_price', 'sell_price')} FROM mart"""
    q["gold_training_with_weather"] = f"""
        SELECT store_id, item_id, {t('date', 'date')}, state_id, cat_id, dept_id, sales,
               {_columns(WEATHER, WEATHER)} FROM mart"""

    def top(base: str, n: int) -> str:
        return f"""{MART_ROWS} FROM {base} WHERE (store_id, item_id) IN (
            SELECT (store_id, item_id) FROM (
              SELECT store_id, item_id, sum(sales) AS s FROM {base} GROUP BY ALL
              ORDER BY s DESC, store_id, item_id LIMIT {n}))"""

    q["top_series_subset"] = top("mart", 20)
    q["training_extract"] = f"""
        , bounded AS (SELECT * FROM mart WHERE date > (SELECT max(date) - 365 FROM mart))
        {top('bounded', 100)}"""
    q["training_extract_all_series"] = f"""
        {MART_ROWS} FROM mart WHERE date > (SELECT max(date) - 365 FROM mart)"""
    q["extract_roundtrip"], q["mart_roundtrip"] = q["training_extract_all_series"], f"{MART_ROWS} FROM mart"
    q["extract_manifest"] = f"""
        , chosen AS (SELECT * FROM mart WHERE date > (SELECT max(date) - 365 FROM mart))
        {MART_ROWS}, (SELECT count(*) FROM chosen) AS manifest_rows FROM chosen
        WHERE store_id BETWEEN 'NATION_1' AND 'NATION_2'"""
    q["series_key_counts"] = """
        SELECT store_id || '|' || item_id AS series_key, count(*) AS n FROM sales GROUP BY ALL"""
    q["series_totals"] = """
        SELECT store_id, item_id, CAST(sum(sales) AS BIGINT) AS total_sales FROM sales GROUP BY ALL"""

    key = f"SELECT store_id, item_id, {t('date', 'date')}"
    q["features_lag_rolling"] = f"{key}, sales, {_columns(BASE[4:], FEATURE_DOUBLES)} FROM feat"
    q["features_calendar"] = f"{key}, {_columns(BASE[:4])} FROM feat"
    q["features_price"] = f"""
        {key}, {d('sell_price', 'sell_price')}, sell_price_missing_flag,
        {d('sell_price_filled', 'sell_price_filled')} FROM feat"""
    for name, cols in FEATURE_SETS.items():
        q[f"modeling_dataset_{name}"] = (
            f"{key}, sales, {_columns(cols, FEATURE_DOUBLES)} FROM feat WHERE "
            + " AND ".join(f"{c} IS NOT NULL" for c in cols))
    q["last_n_history"] = f"""
        {key}, sales FROM (SELECT *, row_number() OVER (
          PARTITION BY store_id, item_id ORDER BY date DESC) AS rn FROM sales) WHERE rn <= 60"""
    q["latest_series_row"] = f"""
        {key}, sales FROM (SELECT *, row_number() OVER (
          PARTITION BY store_id, item_id ORDER BY date DESC) AS rn FROM sales) WHERE rn = 1"""

    q["rolling_splits_summary"] = """
        SELECT CAST(window_no AS INTEGER) AS window_no,
          (SELECT CAST(min(date) AS VARCHAR) FROM modeling WHERE date < test_start)
            AS train_start_date,
          (SELECT CAST(max(date) AS VARCHAR) FROM modeling WHERE date < test_start) AS train_end_date,
          CAST(min(date) AS VARCHAR) AS test_start_date, CAST(max(date) AS VARCHAR) AS test_end_date,
          (SELECT count(*) FROM modeling WHERE date < test_start) AS train_rows,
          count(*) AS test_rows
        FROM windows JOIN modeling ON date BETWEEN test_start AND test_end
        GROUP BY window_no, test_start"""
    q["rolling_split_bounds"] = f"""
        SELECT CAST(window_no AS INTEGER) AS window_no, {t('test_start', 'test_start')},
               {t('test_end', 'test_end')} FROM windows"""
    q["hold_out_split"] = """
        SELECT CASE WHEN date < test_start THEN 'train' ELSE 'test' END AS part, count(*) AS n,
               CAST(min(date) AS VARCHAR) AS first_day, CAST(max(date) AS VARCHAR) AS last_day
        FROM modeling, windows WHERE window_no = 1 GROUP BY ALL"""
    q["backtest_naive"] = _backtest("lag_1")
    q["backtest_seasonal_naive"] = _backtest("lag_7")
    q["backtest_rolling_mean"] = _backtest("rolling_mean_7")
    in_first = "FROM modeling, windows WHERE window_no = 1 AND date BETWEEN test_start AND test_end"
    q["metrics_by_store"] = f"""
        SELECT store_id, {d('sum(abs(lag_7 - sales)) / sum(sales)', 'wmape')},
               {d('avg(abs(lag_7 - sales))', 'mae')}, {d('sqrt(avg((lag_7 - sales) ** 2))', 'rmse')}
        {in_first} GROUP BY store_id"""
    q["metrics_bias"] = f"""
        SELECT store_id, {d('sum(lag_7 - sales) / sum(sales)', 'bias')} {in_first}
        GROUP BY store_id"""
    q["metrics_rmsse"] = f"""
        SELECT store_id, item_id, test_rows, train_rows, {d('scale', 'scale')},
               {d('rmsse', 'rmsse')} FROM rmsse"""
    q["metrics_wrmsse"] = f"""
        SELECT count(*) AS series_count, {d('sum(rmsse * weight) / sum(weight)', 'wrmsse')},
               (SELECT count(*) FROM rmsse WHERE rmsse IS NULL) AS undefined_series
        FROM rmsse JOIN (
          SELECT store_id, item_id, sum(CASE WHEN date >= test_start - 28 AND date < test_start
                                        THEN sales ELSE 0 END) AS weight
          FROM feat, windows WHERE window_no = 1 GROUP BY ALL) USING (store_id, item_id)
        WHERE rmsse IS NOT NULL"""
    q["ablation_grid"] = f"""
        SELECT feature_set_name, model_name, window_no, test_rows, {d('wmape', 'wmape')},
               {d('mae', 'mae')}, {d('rmse', 'rmse')} FROM grid"""
    q["ablation_ranking"] = f"""
        , summary AS (
          SELECT feature_set_name, model_name, count(*) AS windows, avg(wmape) AS a,
                 stddev_samp(wmape) AS s, max(wmape) AS m, count(*) FILTER (wmape < low) AS beats
          FROM grid g LEFT JOIN (
            SELECT feature_set_name, window_no, min(wmape) AS low FROM grid
            WHERE model_name IN ('seasonal_naive_lag_7', 'rolling_mean_7') GROUP BY ALL) b
          USING (feature_set_name, window_no) GROUP BY ALL)
        SELECT feature_set_name, model_name, windows, {d('a', 'avg_wmape')}, {d('s', 'std_wmape')},
               {d('m', 'worst_wmape')}, beats AS windows_beating_baselines,
               beats = windows AS beats_baselines,
               CAST(row_number() OVER (ORDER BY round(a, 9), feature_set_name, model_name) AS INTEGER) AS rank
        FROM summary"""
    q["backtest_wrmsse"] = f"""
        SELECT model_name, CAST(window_no AS INTEGER) AS window_no, series_count, undefined_series,
               {d('wrmsse', 'wrmsse')} FROM wrmsse"""
    q["ranking_wrmsse"] = f"""
        , summary AS (
          SELECT model_name, count(*) AS windows, avg(wrmsse) AS a, stddev_samp(wrmsse) AS s,
                 max(wrmsse) AS m, count(*) FILTER (wrmsse < low) AS beats
          FROM wrmsse LEFT JOIN (
            SELECT window_no, min(wrmsse) AS low FROM wrmsse
            WHERE model_name IN ('seasonal_naive_lag_7', 'rolling_mean_7') GROUP BY ALL) b
          USING (window_no) GROUP BY ALL)
        SELECT 'calendar_lag_rolling_baseline' AS feature_set_name, model_name, windows,
               {d('a', 'avg_wrmsse')}, {d('s', 'std_wrmsse')}, {d('m', 'worst_wrmsse')},
               beats AS windows_beating_baselines, beats = windows AS beats_baselines,
               CAST(row_number() OVER (ORDER BY round(a, 9), model_name) AS INTEGER) AS rank
        FROM summary"""
    q["recursive_seasonal_naive"] = f"""
        SELECT store_id, item_id, {t('forecast_date', 'forecast_date')}, forecast_step,
               {d('prediction', 'prediction')} FROM latest"""
    q["recursive_naive"] = _recursive("h[-1]")
    q["recursive_rolling_mean"] = _recursive(
        "CASE WHEN len(h) >= 7 THEN (h[-7] + h[-6] + h[-5] + h[-4] + h[-3] + h[-2] + h[-1]) / 7 END")

    q["backtest_linear"] = _backtest(
        "(intercept + slope * lag_7)", "(SELECT * FROM windows JOIN lines_fit USING (window_no))")
    q["recursive_linear"] = _recursive(
        "((SELECT intercept FROM whole_fit) + (SELECT slope FROM whole_fit) * h[-7])")
    q["predicted_batch"] = q["recursive_linear"].replace(
        "FROM steps WHERE step > 0", ", '2' AS model_version FROM steps WHERE step > 0")
    pair = "lag_7_and_rolling_mean_28"
    parts = [f"SELECT '{c}' AS s, date, CAST(sales AS DOUBLE) AS y, {c} AS a, 0.0::DOUBLE AS b FROM feat WHERE {c} IS NOT NULL"
             for c in ("lag_7", "lag_28", "rolling_mean_28")]
    parts.append(f"SELECT '{pair}', date, CAST(sales AS DOUBLE), lag_7, rolling_mean_28 FROM feat "
                 "WHERE lag_7 IS NOT NULL AND rolling_mean_28 IS NOT NULL")
    q["training_run"] = f"""
        SELECT window_no, train_rows, test_rows, '1' AS model_version, (SELECT count(*) FROM modeling) AS modeling_rows,
               '{len(BASE)}' AS feature_count, {len(BASE)} AS importance_rows, CAST(1 AS DOUBLE) AS importance_total
        FROM ({_backtest('lag_1')})"""
    # Least squares from covariances; Cramer's rule for the pair.
    q["ablation_linear"] = f"""
        , grid_rows AS ({' UNION ALL '.join(parts)}),
        grid_windows AS (
          SELECT s, w, hi - CAST((w - 1) * 28 + 27 AS INTEGER) AS lo, hi - CAST((w - 1) * 28 AS INTEGER) AS hi
          FROM (SELECT s, max(date) AS hi FROM grid_rows GROUP BY s), range(1, 6) r(w)),
        moments AS (
          SELECT s, w, lo, g.hi, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, covar_pop(y, a) AS ya,
                 covar_pop(y, b) AS yb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab
          FROM grid_windows g JOIN grid_rows USING (s) WHERE date < lo GROUP BY ALL),
        slopes AS (
          SELECT *, CASE WHEN s = '{pair}' THEN (ya * bb - yb * ab) / (aa * bb - ab * ab) ELSE ya / aa END AS ca,
                 CASE WHEN s = '{pair}' THEN (yb * aa - ya * ab) / (aa * bb - ab * ab) ELSE 0 END AS cb
          FROM moments),
        tested AS (
          SELECT s, w, n, y, my + ca * (a - ma) + cb * (b - mb) - y AS e
          FROM slopes JOIN grid_rows USING (s) WHERE date BETWEEN lo AND hi)
        SELECT s AS feature_set_name, 'linear' AS model_name, CAST(w AS INTEGER) AS window_no, n AS train_rows,
               count(*) AS test_rows, {d('sum(abs(e)) / sum(y)', 'wmape')}, {d('avg(abs(e))', 'mae')},
               {d('sqrt(avg(e * e))', 'rmse')} FROM tested GROUP BY s, w, n"""
    line = "(intercept + slope * lag_7)"
    q["backtest_linear_wrmsse"] = f"""
        , fitted AS (SELECT * FROM windows JOIN lines_fit USING (window_no)),
        primary_metric AS (
          SELECT window_no, sum(sqrt(mse / scale) * weight) / sum(weight) AS w FROM (
            SELECT window_no, store_id, item_id, avg(({line} - sales) ** 2) AS mse
            FROM fitted JOIN modeling ON date BETWEEN test_start AND test_end GROUP BY ALL)
          JOIN series_scale USING (window_no, store_id, item_id) WHERE train_rows >= 2 AND scale > 0 GROUP BY ALL)
        SELECT b.*, {d('w', 'wrmsse')} FROM ({_backtest(line, 'fitted')}) b JOIN primary_metric USING (window_no)"""
    q["recursive_leafwise"] = _leafwise()
    draws = " + ".join(f"CAST(u >= {c} AS INTEGER)" for c in POISSON)
    q["ranking_stability"] = f"""
        , draws AS (
          SELECT store_id, item_id, b, {draws} AS k FROM (
            SELECT store_id, item_id, b,
                   CAST('0x' || substr(md5(store_id || '|' || item_id || '|' || b), 1, 8) AS BIGINT) / 4294967296.0 AS u
            FROM (SELECT DISTINCT store_id, item_id FROM series_rmsse), range(0, 40) r(b))
          UNION ALL SELECT DISTINCT store_id, item_id, -1, 1 FROM series_rmsse),
        means AS (
          SELECT model_name, b, window_no, sum(k * weight * rmsse) / sum(k * weight) AS w
          FROM series_rmsse JOIN draws USING (store_id, item_id) WHERE k > 0 GROUP BY ALL),
        averages AS (SELECT model_name, b, avg(w) AS a FROM means GROUP BY ALL),
        best AS (
          SELECT m.model_name, b, m.a, r.model_name AS rival, r.a AS rival_a
          FROM averages m JOIN averages r USING (b)
          WHERE r.model_name <> m.model_name AND r.model_name IN ('seasonal_naive_lag_7', 'rolling_mean_7')
          QUALIFY row_number() OVER (PARTITION BY m.model_name, b ORDER BY r.a, r.model_name) = 1),
        losses AS (
          SELECT t.model_name, max(x.w / y.w - 1) AS worst
          FROM best t JOIN means x ON x.model_name = t.model_name AND x.b = -1
          JOIN means y ON y.model_name = t.rival AND y.b = -1 AND y.window_no = x.window_no WHERE t.b = -1 GROUP BY ALL),
        summary AS (
          SELECT model_name, max(a) FILTER (b < 0) AS a, max(a - rival_a) FILTER (b < 0) AS gap,
                 quantile_cont(a - rival_a, 0.025) FILTER (b >= 0) AS low,
                 quantile_cont(a - rival_a, 0.975) FILTER (b >= 0) AS high FROM best GROUP BY ALL)
        SELECT model_name, {d('a', 'avg_wrmsse')}, {d('gap', 'gap')}, {d('low', 'gap_low')}, {d('high', 'gap_high')},
               {d('worst', 'worst_window')}, high < 0 AS separated, worst < 0.1 AS stable,
               CAST(row_number() OVER (ORDER BY CAST(NOT (high < 0 AND worst < 0.1) AS INTEGER), round(a, 9), model_name)
                    AS INTEGER) AS rank
        FROM summary JOIN losses USING (model_name)"""
    q["forecast_rows"] = f"{FORECAST_ROWS} FROM forecasts"
    q["forecast_horizon_overwrite"] = f"""
        , old AS (SELECT * FROM forecasts WHERE model_version <> '3'),
        new AS (SELECT * FROM forecasts WHERE model_version = '3')
        {FORECAST_ROWS} FROM (
          SELECT * FROM old WHERE forecast_date NOT BETWEEN (SELECT min(forecast_date) FROM new)
            AND (SELECT max(forecast_date) FROM new)
          UNION ALL SELECT * FROM new)"""
    q["forecast_table_roundtrip"] = f"""
        , ends AS (SELECT model_version AS v, min(forecast_date) AS lo, max(forecast_date) AS hi
                   FROM forecasts GROUP BY ALL)
        {FORECAST_ROWS} FROM forecasts f WHERE NOT EXISTS (
          SELECT 1 FROM ends WHERE v > f.model_version AND forecast_date BETWEEN lo AND hi)"""
    q["snapshot_roundtrip"] = f"{FORECAST_ROWS}, 'latest' AS read_from FROM latest"
    q["forecast_run_monitoring"] = f"SELECT {_columns(MONITORING, (), RUN_TEXTS)} FROM monitoring"
    q["forecast_freshness"] = f"""
        SELECT {_columns([*MONITORING, 'forecast_horizon_days'], (), RUN_TEXTS)} FROM freshness"""
    q["snapshot_recent_rows"] = f"""
        {FORECAST_ROWS} FROM (SELECT * FROM forecasts ORDER BY generated_at DESC, forecast_date,
          store_id, item_id LIMIT 500)"""
    q["snapshot_recent_runs"] = f"""
        SELECT {_columns(MONITORING, (), RUN_TEXTS)} FROM (
          SELECT * FROM monitoring ORDER BY generated_at DESC LIMIT 25)"""
    q["snapshot_metadata"] = f"""
        SELECT '20240131T040500Z' AS snapshot_run_id, '20240131T040500Z' AS refreshed_at,
               {t('generated_at', 'source_generated_at')}, model_name, model_version,
               feature_set_name, forecast_row_count, forecast_series_count, forecast_horizon_days,
               (SELECT count(*) FROM monitoring) AS monitoring_row_count FROM freshness"""
    q["latest_successful_ingest"] = f"""
        SELECT source_name, {t('max(ingest_date)', 'ingest_date')},
               {t('max(ended_at)', 'ended_at')} FROM runs WHERE status = 'SUCCEEDED'
        GROUP BY source_name"""
    q["audit_latest_state"] = f"""
        SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS source_name,
               CASE WHEN event_id % 2 = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
               {d('value', 'row_value')}, least(length(props) * 600, 5000) AS message_length,
               substr(repeat(props, 600), 1, 5000) AS message
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

    q["audit_compacted_state"] = q["audit_latest_state"]

    calendar_check = """
        SELECT *, pk_nulls + date_nulls + date_parse_failures + weekday_invalid_count
                  + wm_yr_wk_nulls = 0 AND pk_unique
                  AND coalesce(date_monotonic_non_decreasing, TRUE) AS passed FROM (
        SELECT count(*) AS rows, 14 AS cols, '' AS missing_required_columns,
               count(*) FILTER (d IS NULL) AS pk_nulls,
               count(DISTINCT d) = count(*) AS pk_unique, count(*) FILTER (date IS NULL) AS date_nulls,
               count(*) FILTER (try_cast(date AS DATE) IS NULL) AS date_parse_failures,
               count(*) FILTER (weekday NOT IN ('Monday', 'Tuesday', 'Wednesday', 'Thursday',
                 'Friday', 'Saturday', 'Sunday')) AS weekday_invalid_count,
               count(*) FILTER (wm_yr_wk IS NULL) AS wm_yr_wk_nulls,
               CASE WHEN count(*) FILTER (try_cast(date AS DATE) IS NULL) = 0 THEN
                 count(*) FILTER (try_cast(date AS DATE) < before) = 0 END
                 AS date_monotonic_non_decreasing
        FROM (SELECT *, try_cast(lag(date) OVER (ORDER BY n) AS DATE) AS before FROM {}))"""
    q["dq_calendar"] = calendar_check.format("calraw")
    q["dq_calendar_faults"] = calendar_check.format("dirtycal")
    q["dq_calendar_order"] = """
        SELECT count(*) AS rows, coalesce(count(*) FILTER (date < before), 0) = 0
               AS date_monotonic_non_decreasing
        FROM (SELECT v AS date, lag(v) OVER (ORDER BY n) AS before FROM (
          SELECT n, CASE WHEN n % 100 = 0 THEN CAST(date AS DATE) - 2 ELSE CAST(date AS DATE) END AS v
          FROM calraw))"""
    q["dq_calendar_file_order"] = """
        SELECT layout, count(*) AS rows, coalesce(count(*) FILTER (date < before), 0) = 0
                 AS date_monotonic_non_decreasing,
               coalesce(count(*) FILTER (date < before), 0) = 0 AS passed
        FROM (SELECT layout, date, lag(date) OVER (PARTITION BY layout ORDER BY CASE layout
                WHEN 'in_order' THEN part ELSE -part END, n) AS before
              FROM (SELECT n, date, CASE WHEN n <= 200 THEN 1 WHEN n <= 1000 THEN 2 ELSE 3 END AS part FROM calraw),
                   (VALUES ('in_order'), ('last_days_first')) l(layout)) GROUP BY layout"""
    price_check = """
        SELECT count(*) AS rows, 4 AS cols, '' AS missing_required_columns, 0 AS store_id_nulls,
               0 AS item_id_nulls, count(*) FILTER (wm_yr_wk IS NULL) AS wm_yr_wk_nulls,
               count(*) FILTER (wm_yr_wk IS NULL) AS pk_any_nulls,
               count(DISTINCT (store_id, item_id, wm_yr_wk)) = count(*) AS pk_unique,
               count(*) FILTER (price IS NULL) AS sell_price_nulls,
               count(*) FILTER (try_cast(price AS DOUBLE) IS NULL) AS sell_price_non_numeric,
               count(*) FILTER (try_cast(price AS DOUBLE) <= 0) AS sell_price_non_positive"""
    q["dq_sell_prices"] = price_check + """,
               sell_price_nulls + sell_price_non_numeric + sell_price_non_positive + pk_any_nulls = 0
                 AND pk_unique AS passed
        FROM (SELECT *, CAST(sell_price AS VARCHAR) AS price FROM pricesraw)"""
    q["dq_sell_prices_faults"] = price_check + """, FALSE AS passed
        FROM (SELECT store_id, item_id,
                CASE WHEN CAST(wm_yr_wk AS INTEGER) % 50 = 0 THEN NULL ELSE wm_yr_wk END AS wm_yr_wk,
                CASE WHEN CAST(wm_yr_wk AS INTEGER) % 11 = 0 THEN '-1'
                     WHEN CAST(wm_yr_wk AS INTEGER) % 7 = 0 THEN 'free'
                     WHEN CAST(wm_yr_wk AS INTEGER) % 5 = 0 THEN NULL
                     ELSE CAST(sell_price AS VARCHAR) END AS price FROM pricesraw)"""
    q["dq_sales_wide"] = """
        SELECT (SELECT count(DISTINCT id) FROM fact) AS rows,
               6 + (SELECT max(n) FROM cal) AS cols, '' AS missing_required_columns, 0 AS pk_nulls,
               (SELECT count(DISTINCT id) = count(*) FROM (
                  SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM fact)) AS pk_unique,
               (SELECT max(n) FROM cal) AS d_column_count,
               (SELECT max(n) FROM cal) AS d_columns_sampled,
               (SELECT max(n) FROM cal) * (SELECT count(DISTINCT id) FROM fact)
                 - (SELECT count(*) FROM sales) AS d_non_numeric_in_sample,
               (SELECT count(*) FROM sales WHERE sales < 0) AS d_negative_in_sample,
               (SELECT max(n) FROM cal) * (SELECT count(DISTINCT id) FROM fact)
                 = (SELECT count(*) FROM sales) AS passed"""
    q["dq_macro"] = """
        SELECT series_id, '' AS missing_top_level_keys, '' AS missing_series_metadata_keys,
               '' AS missing_ingestion_metadata_keys, observation_count,
               missing_observation_keys_count, empty_date_count, empty_value_count, passed
        FROM macrocheck"""
    q["dq_macro_missing_keys"] = """
        SELECT *, missing_top_level_keys || missing_series_metadata_keys || missing_ingestion_metadata_keys = ''
                  AND observation_count > 0 AND missing_observation_keys_count + empty_date_count
                    + empty_value_count = 0 AS passed FROM (
        SELECT series_id,
               CASE series_id WHEN 'UNRATE' THEN 'ingestion_metadata' WHEN 'PAYEMS' THEN 'observations' ELSE '' END
                 AS missing_top_level_keys,
               CASE series_id WHEN 'CPIAUCSL' THEN 'label' ELSE '' END AS missing_series_metadata_keys,
               CASE series_id WHEN 'UNRATE' THEN 'ingest_date,provider,schema_version,source_name' ELSE '' END
                 AS missing_ingestion_metadata_keys,
               count(*) FILTER (series_id <> 'PAYEMS') AS observation_count,
               count(*) FILTER (series_id = 'FEDFUNDS' AND month(observation_date) = 2)
                 AS missing_observation_keys_count,
               count(*) FILTER (observation_date IS NULL) AS empty_date_count,
               count(*) FILTER (series_id = 'FEDFUNDS' AND month(observation_date) = 2) AS empty_value_count
        FROM macro GROUP BY series_id)"""
    q["dq_trends_faults"] = """
        SELECT *, missing_required_columns = '' AND rows > 0 AND interest_column_name IS NOT NULL
                  AND coalesce(interest_nulls + interest_negative_count = 0, FALSE) AS passed FROM (
        SELECT keyword, count(*) AS rows,
               CASE keyword WHEN 'walmart' THEN 'geo' ELSE '' END AS missing_required_columns,
               count(*) FILTER (trend_date IS NULL) AS date_nulls,
               count(*) FILTER (keyword IS NULL) AS keyword_nulls,
               count(*) FILTER (feature_name IS NULL) AS feature_name_nulls,
               CASE WHEN keyword IN ('walmart', 'cleaning supplies') THEN keyword END AS interest_column_name,
               CASE WHEN keyword IN ('walmart', 'cleaning supplies') THEN count(*) FILTER (
                 keyword = 'cleaning supplies' AND month(trend_date) = 2) END AS interest_nulls,
               CASE WHEN keyword IN ('walmart', 'cleaning supplies') THEN count(*) FILTER (
                 keyword = 'cleaning supplies' AND month(trend_date) = 1) END AS interest_negative_count
        FROM trends GROUP BY keyword)"""
    q["dq_failing_parts"] = """
        SELECT series_id, CAST(to_json({
          'series_id': series_id, 'missing_top_level_keys': []::VARCHAR[],
          'missing_series_metadata_keys': []::VARCHAR[], 'missing_ingestion_metadata_keys': []::VARCHAR[],
          'observation_count': observation_count, 'missing_observation_keys_count': missing_observation_keys_count,
          'empty_date_count': empty_date_count, 'empty_value_count': empty_value_count, 'passed': passed})
          AS VARCHAR) AS details_json
        FROM macrocheck WHERE NOT passed"""
    verdict = "CASE WHEN passed THEN 'PASSED' ELSE 'FAILED' END AS status"
    q["dq_gate_verdicts"] = " UNION ALL ".join([
        f"""SELECT '{dataset}' AS dataset_name, 'calendar_basic_v1' AS suite_name, {verdict},
              CASE WHEN NOT passed THEN 'calendar checks failed' END AS message, rows, pk_nulls, wm_yr_wk_nulls,
              NULL::BIGINT AS parts_failed FROM ({calendar_check.format(source)})"""
        for dataset, source in (("calendar", "calraw"), ("calendar_faults", "dirtycal"))] + [
        f"""SELECT 'sell_prices', 'sell_prices_basic_v1', {verdict},
              CASE WHEN NOT passed THEN 'sell_prices checks failed' END, rows, NULL, wm_yr_wk_nulls, NULL
            FROM ({q['dq_sell_prices']})""",
        f"""SELECT 'macro_series', 'macro_series_basic_v1', {verdict},
              CASE WHEN NOT passed THEN 'macro_series checks failed' END, NULL, NULL, NULL, parts_failed
            FROM (SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS parts_failed FROM macrocheck)"""])
    q["dq_suite_rollup"] = """
        SELECT count(*) AS parts_checked, count(*) FILTER (NOT passed) AS parts_failed,
               coalesce(string_agg(series_id, ',' ORDER BY series_id) FILTER (NOT passed), '')
                 AS failing_parts, bool_and(passed) AS passed FROM macrocheck"""
    lengths = ", ".join(f"count(*) AS {n}_length" for n in ("time", *WEATHER))
    q["dq_weather"] = f"""
        SELECT state_id AS location_id, '' AS missing_top_level_keys, '' AS missing_daily_keys,
               '' AS missing_location_keys, '' AS missing_ingestion_metadata_keys, {lengths},
               count(*) FILTER (precipitation_sum - 4 < 0) AS precipitation_negative_count,
               count(*) FILTER (wind_speed_10m_max - 100 < 0) AS wind_negative_count,
               count(DISTINCT date) = count(*) AND count(precipitation_sum) = count(*)
                 AND count(wind_speed_10m_max) = count(*) AS aligned_series_lengths,
               count(*) FILTER (precipitation_sum - 4 < 0 OR wind_speed_10m_max - 100 < 0) = 0
                 AS passed
        FROM weather GROUP BY state_id"""
    q["dq_trends"] = """
        SELECT keyword, count(*) AS rows, '' AS missing_required_columns,
               count(*) FILTER (trend_date IS NULL) AS date_nulls,
               count(*) FILTER (keyword IS NULL) AS keyword_nulls,
               count(*) FILTER (feature_name IS NULL) AS feature_name_nulls,
               keyword AS interest_column_name,
               count(*) FILTER (interest_value IS NULL) AS interest_nulls,
               count(*) FILTER (interest_value < 0) AS interest_negative_count,
               count(*) FILTER (trend_date IS NULL OR keyword IS NULL OR feature_name IS NULL
                 OR interest_value IS NULL OR interest_value < 0) = 0 AS passed
        FROM trends GROUP BY keyword"""

    q["contract_grain_unique"] = f"""
        SELECT store_id, item_id, {t('date', 'date')}, count(*) AS row_count FROM priced
        GROUP BY store_id, item_id, date HAVING count(*) > 1"""
    q["contract_duplicate_orders"] = """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY ALL HAVING count(*) > 1"""
    q["contract_sales_non_negative"] = f"""
        SELECT store_id, item_id, {t('date', 'date')}, sales FROM priced WHERE sales < 0"""
    lines = """FROM lineitem JOIN stores ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        JOIN cal c ON c.date = CAST(l_shipdate AS DATE)"""
    q["contract_grain_faults"] = f"""
        SELECT store_id, p_type AS item_id, {t('date', 'date')}, count(*) AS row_count {lines}
        GROUP BY store_id, p_type, date HAVING count(*) > 1"""
    q["contract_price_key_faults"] = f"""
        SELECT store_id, p_type AS item_id, wm_yr_wk, count(DISTINCT l_returnflag) AS n {lines}
        GROUP BY store_id, p_type, wm_yr_wk HAVING count(DISTINCT l_returnflag) > 1"""
    q["contract_sales_faults"] = f"""
        SELECT store_id, p_type AS item_id, {t('date', 'date')},
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                        * CAST(l_quantity AS BIGINT)) AS BIGINT) AS sales {lines}
        GROUP BY store_id, p_type, date HAVING sales < 0"""
    q["contract_price_coverage"] = f"""
        SELECT count(*) AS total_rows, count(*) FILTER (sell_price IS NULL) AS null_prices,
               {d('avg(CAST(sell_price IS NULL AS INTEGER))', 'null_share')} FROM priced
        HAVING avg(CAST(sell_price IS NULL AS INTEGER)) > 0.1"""
    q["contract_price_key_unique"] = """
        SELECT store_id, item_id, wm_yr_wk, count(*) AS n FROM prices GROUP BY ALL
        HAVING count(*) > 1"""
    q["contract_columns"] = " UNION ALL ".join((
        _not_null("(SELECT *, dayname(date) AS weekday, year(date) AS year, month(date) AS month, "
                  "day(date) AS day, isodow(date) AS day_of_week FROM cal)", "silver_calendar",
                  ("d", "date", "wm_yr_wk", "weekday", "year", "month", "day", "day_of_week")),
        "SELECT 'silver_calendar', 'd', 'unique', count(*) - count(DISTINCT d) FROM cal",
        _not_null("prices", "silver_sell_prices",
                  ("store_id", "item_id", "wm_yr_wk", "sell_price")),
        _not_null("sales", "silver_sales", (*IDS.split(", "), "d", "date", "sales")),
        _not_null("priced", "silver_sales_with_prices",
                  ("id", "item_id", "store_id", "d", "date", "wm_yr_wk", "sales")),
        _not_null("(SELECT state_id AS location_id, state_id, date AS weather_date FROM weather)",
                  "silver_weather_daily", ("location_id", "state_id", "weather_date")),
        _not_null("mart", "silver_sales_with_weather",
                  ("id", "item_id", "store_id", "state_id", "d", "date", "sales")),
        _not_null("macro", "silver_macro_series", ("series_id", "feature_name", "observation_date")),
        _not_null("macroday", "silver_macro_daily_aligned", ("date", "feature_name")),
        _not_null("trends", "silver_trends_interest", ("feature_name", "trend_date")),
        _not_null("(SELECT * FROM trends JOIN salesdates ON date = trend_date)",
                  "silver_trends_daily_aligned", ("date", "feature_name")),
        _not_null("mart", "silver_sales_with_external_features",
                  ("id", "item_id", "store_id", "state_id", "d", "date", "sales")),
        _not_null("mart", "gold_training_daily_with_weather", ("store_id", "item_id", "date", "sales")),
        _not_null("mart", "gold_feature_mart", ("id", "item_id", "store_id", "date", "sales")),
        _not_null("monitoring", "forecast_run_monitoring", MONITORING),
        _not_null("priced", "gold_training_daily",
                  ("store_id", "item_id", "date", "wm_yr_wk", "sales")),
        _not_null("freshness", "latest_forecast_freshness",
                  (*MONITORING, "forecast_horizon_days"))))

    q["eda_profile"] = f"""
        SELECT count(*) AS row_count, count(DISTINCT store_id || '_' || item_id) AS series_count,
               count(DISTINCT item_id) AS item_count, count(DISTINCT dept_id) AS dept_count,
               count(DISTINCT cat_id) AS cat_count, count(DISTINCT store_id) AS store_count,
               count(DISTINCT state_id) AS state_count, {t('min(date)', 'min_date')},
               {t('max(date)', 'max_date')} FROM priced"""
    q["eda_target_profile"] = f"""
        SELECT count(*) AS row_count, count(sales) AS non_null_sales_rows, min(sales) AS min_sales,
               max(sales) AS max_sales, {d('avg(sales)', 'avg_sales')},
               count(*) FILTER (sales < 0) AS negative_sales_rows,
               count(*) FILTER (sales = 0) AS zero_sales_rows FROM priced"""
    q["eda_null_profile"] = "SELECT count(*) AS total_rows, " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS null_{c}"
        for c in ("sell_price", *WEATHER, *MACRO, *TRENDS)) + " FROM mart"
    q["eda_distribution"] = f"""
        SELECT {d('avg(sales)', 'avg_sales')}, {d('stddev_samp(sales)', 'std_sales')},
               {d('quantile_cont(sales, 0.5)', 'median_sales')},
               {d('quantile_cont(sales, 0.9)', 'p90_sales')},
               {d('quantile_cont(sales, 0.99)', 'p99_sales')} FROM priced"""
    q["eda_distribution_external"] = " UNION ALL ".join(f"""
        SELECT '{c}' AS feature, count({c}) AS n, {d(f'avg(CAST({c} AS DOUBLE))', 'average')},
               {d(f'stddev_samp(CAST({c} AS DOUBLE))', 'deviation')},
               {d(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 'p50')},
               {d(f'quantile_cont(CAST({c} AS DOUBLE), 0.9)', 'p90')},
               {d(f'quantile_cont(CAST({c} AS DOUBLE), 0.99)', 'p99')} FROM mart""" for c in ("sell_price", *WEATHER))
    place = "CAST('0x' || substr(md5(store_id || '|' || item_id || '|' || CAST(date AS VARCHAR)), 1, 15) AS BIGINT), store_id, item_id, date"
    q["sample_exact_rows"] = f"""
        SELECT store_id, item_id, {t('date', 'date')}, sales, 'all' AS part
        FROM sales QUALIFY row_number() OVER (ORDER BY {place}) <= 1000
        UNION ALL SELECT store_id, item_id, {t('date', 'date')}, sales, 'store'
        FROM sales QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY {place}) <= 20"""
    q["eda_daily_totals"] = f"""
        SELECT {t('date', 'date')}, CAST(sum(sales) AS BIGINT) AS total_daily_sales FROM priced
        GROUP BY date"""
    q["eda_store_sparsity"] = f"""
        SELECT store_id, count(*) AS row_count, {d('avg(sales)', 'avg_sales')},
               count(*) FILTER (sales = 0) AS zero_sales_rows,
               {d('100.0 * count(*) FILTER (sales = 0) / count(*)', 'zero_sales_pct')}
        FROM (SELECT s.store_id, coalesce(f.sales, 0) AS sales
              FROM (SELECT DISTINCT store_id, item_id FROM fact) s
              CROSS JOIN (SELECT date FROM cal) c
              LEFT JOIN fact f ON f.store_id = s.store_id AND f.item_id = s.item_id
                AND f.date = c.date) GROUP BY store_id"""
    q["eda_series_per_store"] = """
        SELECT store_id, count(DISTINCT item_id) AS item_count, count(*) AS row_count FROM priced
        GROUP BY store_id"""
    q["eda_grain"] = """
        SELECT count(*) AS total_rows,
               count(DISTINCT store_id || '_' || item_id || '_' || CAST(date AS VARCHAR))
                 AS distinct_store_item_date_rows FROM priced"""
    pairs = ("sell_price", *WEATHER, *TRENDS)
    q["eda_correlation"] = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {d(f'corr(CAST(sales AS DOUBLE), CAST({c} AS DOUBLE))', 'correlation')}"
        " FROM mart" for c in pairs)

    q["kpi_summary"] = f"""
        SELECT {d('coalesce(sum(prediction), 0)', 'total_forecast')},
               {d('sum(prediction) / count(DISTINCT forecast_date)', 'average_daily_forecast')},
               count(DISTINCT store_id) AS store_count, count(DISTINCT item_id) AS product_count
        FROM latest"""
    daily = "SELECT forecast_date, sum(prediction) AS total FROM latest GROUP BY forecast_date"
    q["forecast_totals_by_date"] = f"""
        SELECT {t('forecast_date', 'forecast_date')}, {d('total', 'forecast_demand')}
        FROM ({daily})"""
    q["trend_direction"] = f"""
        SELECT count(*) AS days, {d('arg_min(total, forecast_date)', 'first_total')},
               {d('arg_max(total, forecast_date)', 'last_total')},
               CASE WHEN arg_max(total, forecast_date) > arg_min(total, forecast_date) THEN 'rises'
                    WHEN arg_max(total, forecast_date) < arg_min(total, forecast_date) THEN 'softens'
                    ELSE 'stable' END AS direction FROM ({daily})"""
    q["daily_trend_dod"] = f"""
        SELECT {t('forecast_date', 'forecast_date')}, {d('r', 'forecast_demand')},
               {d('round(r - lag(r) OVER (ORDER BY forecast_date), 2)', 'day_over_day_change')}
        FROM (SELECT forecast_date, round(total, 2) AS r FROM ({daily}))"""
    for name, col, n in (("top_stores", "store_id", 10), ("top_products", "item_id", 20)):
        q[name] = f"""
            SELECT {col}, {d('s', 'forecast_demand')} FROM (
              SELECT {col}, sum(prediction) AS s FROM latest GROUP BY {col}
              ORDER BY s DESC NULLS LAST, {col} LIMIT {n})"""
    for name, col in (("store_summary", "store_id"), ("product_summary", "item_id")):
        q[name] = f"""
            SELECT {col}, {d('round(sum(prediction), 2)', 'forecast_demand')} FROM latest
            GROUP BY {col}"""
    q["forecast_detail"] = f"""
        SELECT {t('forecast_date', 'forecast_date')}, store_id, item_id,
               {d('round(prediction, 2)', 'forecast_demand')} FROM latest"""
    q["forecast_filtered"] = f"""
        {FORECAST_ROWS} FROM forecasts WHERE store_id IN ('NATION_1', 'NATION_2')
          AND forecast_date BETWEEN DATE '2001-10-01' AND DATE '2001-11-15'"""
    q["filter_options"] = "SELECT DISTINCT store_id AS value FROM forecasts"
    q["forecast_window"] = f"""
        SELECT {t('min(forecast_date)', 'first_day')}, {t('max(forecast_date)', 'last_day')},
               'Forecast window: ' || strftime(min(forecast_date), '%d %b %Y') || ' to '
                 || strftime(max(forecast_date), '%d %b %Y') AS label FROM latest"""
    q["display_labels"] = f"""
        SELECT model_version, 'Demand forecasting model' AS model_label,
               'Operational demand feature set' AS feature_set_label,
               strftime(generated_at, '%d %b %Y, %H:%M UTC') AS generated_label,
               format('{{:,}}', CAST(forecast_row_count AS BIGINT)) AS rows_label FROM monitoring"""
    q["display_labels_by_code"] = """
        SELECT o_orderpriority, model_label, data_source_label, feature_set_label,
               format('{:,}', count(*)) AS orders_label, format('{:,.2f}', max(o_totalprice)) AS top_label
        FROM orders JOIN (VALUES
          ('1-URGENT', 'Demand forecasting model', 'Latest published snapshot', 'Extended demand feature set'),
          ('2-HIGH', 'Benchmark demand model', 'Cached snapshot', 'Demand + price feature set'),
          ('3-MEDIUM', 'Demand forecasting model', 'Currently unavailable', 'Demand + weather feature set'),
          ('4-NOT SPECIFIED', 'Demand forecasting model', 'Unknown', 'Demand + macro feature set'),
          ('5-LOW', 'Demand forecasting model', 'Unknown', 'Operational forecast feature set')
        ) l(o_orderpriority, model_label, data_source_label, feature_set_label) USING (o_orderpriority)
        GROUP BY ALL"""
    q["snapshot_run_ids"] = """
        SELECT strftime(date_trunc('hour', ts), '%Y%m%dT%H%M%SZ') AS run_id, count(*) AS events FROM events GROUP BY ALL"""
    q["weather_stamped"] = f"""
        SELECT state_id AS region, l.location_id, {t('w.date', 'weather_date')},
               {d('precipitation_sum', 'precipitation_sum')}, l.station AS state_id, label,
               {d('latitude', 'latitude')}, {d('longitude', 'longitude')}, timezone, 'weather_openmeteo' AS source_name,
               'open_meteo' AS provider, 'v1' AS schema_version, 'daily_weather.json' AS filename
        FROM weather w JOIN (VALUES
          (0, 'CA', 'CA', 'California', 36.7783, -119.4179, 'America/Los_Angeles'),
          (1, 'TX', 'TX', 'Texas', 31.9686, -99.9018, 'America/Chicago'),
          (2, 'WI', 'WI', 'Wisconsin', 43.7844, -88.7879, 'America/Chicago')
        ) l(k, location_id, station, label, latitude, longitude, timezone) ON length(state_id) % 3 = k"""
    return {name: sql(body) for name, body in q.items()}

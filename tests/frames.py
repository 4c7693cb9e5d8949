"""Small synthetic frames and step-by-step references in plain Python."""

import datetime as dt
import math
import random

from demandloom import schemas as S

DAY0 = dt.date(2024, 1, 1)
SCHEMA = (
    "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
    "d string, date date, wm_yr_wk int, sales double, sell_price double, "
    + ", ".join(f"{c} double" for c in S.EXTERNAL_FEATURES))


def mart_rows(series, days, sales, price, start=DAY0):
    """series: (store, item) pairs; sales(i) and price(i) per day."""
    out = []
    for store, item in series:
        for i in range(days):
            out.append((
                f"{item}_{store}", item, "FOODS_1", "FOODS", store, store.split("_")[0],
                f"d_{i + 1}", start + dt.timedelta(days=i), 11101 + i // 7, sales(i), price(i),
                25.0, 15.0, 0.0, 5.0, 300.0, 4.0, 5.0, 150000.0, 50.0, 40.0, 30.0, 20.0))
    return out


def random_series(seed, n, gap=0.3, null_price=0.5):
    """(date, sales, price) rows with gaps in the dates and missing prices."""
    rnd = random.Random(seed)
    out, day = [], DAY0
    for _ in range(n):
        day += dt.timedelta(days=1 + (rnd.random() < gap) * rnd.randint(1, 5))
        price = None if rnd.random() < null_price else round(rnd.uniform(1, 9), 2)
        out.append((day, float(rnd.randint(0, 20)), price))
    return out


def feature_row(rows, i, carried_price=None):
    """Features of row i from its predecessors, computed one by one."""
    day, _, price = rows[i]
    sales = [r[1] for r in rows]
    prices = [r[2] for r in rows]
    before = [p for p in prices[: i + 1] if p is not None]
    after = [p for p in prices[i:] if p is not None]
    filled = before[-1] if before else after[0] if after else 0.0

    def lag(n):
        return sales[i - n] if i >= n else None

    def mean(n):
        part = sales[i - n: i] if i >= n else []
        return sum(part) / n if len(part) == n and None not in part else None

    return {
        "day_of_week": day.weekday(), "day_of_month": day.day,
        "week_of_year": day.isocalendar()[1], "month": day.month,
        "lag_1": lag(1), "lag_7": lag(7), "lag_28": lag(28),
        "rolling_mean_7": mean(7), "rolling_mean_28": mean(28),
        "sell_price_filled": filled, "sell_price_missing_flag": int(price is None),
    }


def same(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)

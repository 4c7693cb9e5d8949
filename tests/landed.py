"""Write a small landing zone with every file shape."""

import csv
import datetime as dt
import json
import os

from demandloom import schemas as S
from demandloom.sources import landing

DAY = "2024-06-01"
START = dt.date(2024, 1, 1)


def _csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _json(path, payload):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(payload, f, indent=1)


def write(root, days=150, items=("A", "B"), stores=("CA_1", "TX_1")):
    dates = [START + dt.timedelta(days=i) for i in range(days)]
    retail = landing.landing_path(root, "retail_sales", DAY)
    _csv(f"{retail}/calendar.csv", S.CALENDAR_RAW.names, [
        [d.isoformat(), 11101 + i // 7, d.strftime("%A"), 1, d.month, d.year, f"d_{i + 1}",
         "", " ", "", "", 0, 0, 0] for i, d in enumerate(dates)])
    _csv(f"{retail}/sell_prices.csv", S.PRICES_RAW.names, [
        [s, it, 11101 + w, 2.5 + w % 3] for s in stores for it in items
        for w in range(days // 7 + 1) if w != 2])
    _csv(f"{retail}/sales_train_validation.csv",
         [*S.SALES_ID_COLUMNS, *[f"d_{i + 1}" for i in range(days)]],
         [[f"{it}_{s}", it, "DEPT", "CAT", s, s[:2],
           *[(i * (3 + len(it) + k)) % 11 for i in range(days)]]
          for k, s in enumerate(stores) for it in items])
    for loc, state, label, lat, lon, zone in S.WEATHER_LOCATIONS:
        _json(landing.part_path(root, "weather_openmeteo", DAY, loc, "daily_weather.json"), {
            "latitude": lat, "longitude": lon, "timezone": zone,
            "daily": {"time": [d.isoformat() for d in dates],
                      "temperature_2m_max": [20.5 + i % 5 for i in range(days)],
                      "temperature_2m_min": [None if i == 3 else 10.0 for i in range(days)],
                      "precipitation_sum": [0.1 * (i % 3) for i in range(days)],
                      "wind_speed_10m_max": [4 for _ in range(days)]},
            "location": {"location_id": loc, "state_id": state, "label": label, "latitude": lat,
                         "longitude": lon, "timezone": zone},
            "ingestion_metadata": {"source_name": "weather_openmeteo", "provider": "open_meteo",
                                   "schema_version": "v1", "ingest_date": DAY}})
    for k, (sid, feature, label, freq, units) in enumerate(S.MACRO_SERIES):
        _json(landing.part_path(root, "macro_fred", DAY, sid, "macro_series.json"), {
            "observations": [
                {"date": d, "value": v} for d, v in (
                    ("2023-12-01", f"{k}.5"), ("2024-01-01", f"{k + 1}.25"), ("2024-02-01", "."),
                    ("2024-03-01", f"{k + 3}.0"))],
            "series_metadata": {"series_id": sid, "feature_name": feature, "label": label,
                                "frequency": freq, "units": units},
            "ingestion_metadata": {"source_name": "macro_fred", "provider": "fred",
                                   "schema_version": "v1", "ingest_date": DAY}})
    for keyword, feature, label, geo in S.TRENDS_KEYWORDS:
        _csv(landing.keyword_path(
                root, "trends_google", DAY, keyword, "trends_interest_over_time.csv"),
             ["date", keyword, "isPartial", *S.TRENDS_FIXED_COLUMNS[1:]],
             [[d.isoformat(), i % 101, "False", keyword, feature, label, geo, "trends_google",
               "google_trends", "v1", DAY] for i, d in enumerate(dates)])

"""Small literal feeds for pipeline tests."""

from __future__ import annotations

import csv
from datetime import date, datetime, timedelta
from pathlib import Path

from lakegate.bindings import mobility as m

END = date(2024, 3, 2)
DAYS = 2
RIDERS = ("member", "casual", "member", "corporate", "member", "casual")


def rows(shift_days: int = 0) -> dict[str, list[dict]]:
    """Two days of valid trips: six per hour from 6 to 11 o'clock, all paid."""
    stations = [
        {
            "station_id": f"{i:03d}",
            "station_name": f"Dock {i}",
            "zone_id": f"Z{i % 2 + 1:02d}",
            "zone_name": ("Centre", "Harbour")[i % 2],
            "zone_type": "commercial",
            "latitude": 59.3 + i / 100,
            "longitude": 18.0,
            "capacity": 20 + i,
            "opened_at": "2020-01-01",
        }
        for i in range(1, 5)
    ]
    weather, trips, payments = [], [], []
    first = END + timedelta(days=shift_days - 1)
    for day in range(DAYS):
        for hour in range(24):
            at = datetime.combine(first + timedelta(days=day), datetime.min.time())
            at += timedelta(hours=hour)
            weather.append(
                {
                    "observed_at": str(at),
                    "temp_c": 10 + hour / 2,
                    "rain_mm": 0.4,
                    "wind_kph": 5.5,
                    "condition": "rain" if hour % 3 == 0 else "clear",
                }
            )
            if not 6 <= hour < 12:
                continue
            for n, rider in enumerate(RIDERS):
                number = len(trips) + 1
                start = at + timedelta(minutes=n * 7)
                trips.append(
                    {
                        "trip_id": f"T{number:08d}",
                        "started_at": str(start),
                        "ended_at": str(start + timedelta(minutes=12)),
                        "start_station_id": f"{number % 4 + 1:03d}",
                        "end_station_id": f"{(number + 1) % 4 + 1:03d}",
                        "rider_type": rider,
                        "vehicle_type": m.VEHICLE_TYPES[number % 3],
                        "distance_km": 2.5 + n / 10,
                        "duration_min": 12.0,
                    }
                )
                payments.append(
                    {
                        "payment_id": f"P{number:08d}",
                        "trip_id": f"T{number:08d}",
                        "fare_amount": "5.00",
                        "discount_amount": "0.40",
                        "tax_amount": "0.60",
                        "total_amount": "5.20",
                        "payment_method": m.PAYMENT_METHODS[number % 3],
                        "paid_at": str(start + timedelta(minutes=13)),
                    }
                )
    return {"trips": trips, "payments": payments, "stations": stations, "weather": weather}


def write(root: Path, name: str, data: dict[str, list[dict]]) -> dict[str, list[str]]:
    """Write the feeds below ``root/raw/runs/name`` as CSV files."""
    folder = root / "raw" / "runs" / name
    folder.mkdir(parents=True)
    paths = {}
    for dataset, records in data.items():
        path = folder / f"{dataset}.csv"
        with path.open("w", newline="") as handle:
            writer = csv.DictWriter(handle, list(m.FEED_COLUMNS[dataset]))
            writer.writeheader()
            writer.writerows(records)
        paths[dataset] = [str(path)]
    return paths

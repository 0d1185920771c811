"""Rows and boards for unit tests, generated from a few parameters."""

import json

COLUMNS = ["station_id", "station_name", "destination", "destination_id", "scheduled_time", "delay_seconds",
           "canceled", "vehicle_id", "vehicle_type", "platform", "occupancy", "ingested_at"]
RAW_DDL = ", ".join(f"{c} " + {"delay_seconds": "int", "canceled": "boolean"}.get(c, "string") for c in COLUMNS)


def stamp(hour=15, minute=0, day=12):
    return f"2026-05-{day:02d}T{hour:02d}:{minute:02d}:00+00:00"


def raw_row(**changes):
    row = dict.fromkeys(COLUMNS)
    row |= {"station_id": "A1", "station_name": "Alpha", "destination": "Beta", "destination_id": "B1",
            "scheduled_time": stamp(), "delay_seconds": 0, "canceled": False, "vehicle_id": "V1",
            "vehicle_type": "R", "platform": "2", "occupancy": "low", "ingested_at": stamp(15, 1)}
    return row | changes


def raw_df(spark, *changes):
    return spark.createDataFrame([tuple(raw_row(**c)[k] for k in COLUMNS) for c in changes], RAW_DDL)


def departure(n, **changes):
    """The n-th departure of a board: quarter-hourly, every third late, every fifth canceled."""
    full = {"station": f"Town {n % 4}", "stationinfo": {"id": f"T{n % 4}"}, "time": str(1_700_000_000 + 900 * n),
            "delay": str(60 * (n % 3)), "canceled": str(int(n % 5 == 4)), "vehicle": f"train-{n}",
            "vehicleinfo": {"type": "RX"[n % 2]}, "platform": str(n % 9), "occupancy": {"name": ["low", "high"][n % 2]}}
    return {k: v for k, v in (full | changes).items() if v != "left out"}


def board(*departures, station="S7", name="Hill/Heuvel"):
    return json.dumps({"stationinfo": {"id": station, "standardname": name}, "departures": {"departure": departures}})

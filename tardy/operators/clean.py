"""Cleaning: parse, fill, filter, deduplicate, derive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tardy.functions import scalars as S
from tardy.session import pin_utc
from tardy.schemas import CLEAN_DEFAULTS, DEDUP_KEY, RAW_SCHEMA, REQUIRED_COLUMNS

# Dedup tie-break after the key: latest ingest wins, then every other column descending, so the
# kept row is reproducible (the row count is the same as any-row-wins dedup).
DEDUP_ORDER = ["ingested_at", "delay_seconds", "canceled", "vehicle_type", "platform", "occupancy",
               "destination_id", "station_name", "destination"]


def conform_raw(df: DataFrame) -> DataFrame:
    """Cast a landed frame to the reader schema (delay INT -> BIGINT, column order fixed)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def parse_timestamps(df: DataFrame) -> DataFrame:
    """Both ISO text columns to TIMESTAMP_NTZ (UTC); malformed text becomes null."""
    pin_utc(df.sparkSession)
    return df.withColumns({
        "scheduled_time": S.parse_iso_utc("scheduled_time"),
        "ingested_at": S.parse_iso_utc("ingested_at"),
    })


def fill_defaults(df: DataFrame) -> DataFrame:
    """Per-column null defaults."""
    return df.fillna(CLEAN_DEFAULTS)


def required_present():
    cond = None
    for c in REQUIRED_COLUMNS:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond


def filter_required(df: DataFrame) -> DataFrame:
    """Drop rows without station, vehicle or a parseable scheduled time."""
    return df.filter(required_present())


def dedup_departures(df: DataFrame) -> DataFrame:
    """One row per (station_id, vehicle_id, scheduled_time).

    ``row_number() = 1`` lets Catalyst plan a WindowGroupLimit below the exchange, so every map
    task keeps at most one row per key before the shuffle: a hot key costs one row per task on
    the wire, not all its copies.
    """
    w = Window.partitionBy(*DEDUP_KEY).orderBy(*[F.col(c).desc_nulls_last() for c in DEDUP_ORDER])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def derive(df: DataFrame, local_tz: str | None = None) -> DataFrame:
    """B9-B13. Hour, date and weekday are UTC unless ``local_tz`` names another zone."""
    time = F.col("scheduled_time")
    if local_tz:
        time = F.convert_timezone(F.lit("UTC"), F.lit(local_tz), time)
    return df.withColumns({
        "is_delayed": S.is_delayed("delay_seconds"),
        "delay_minutes": S.delay_minutes("delay_seconds"),
        "departure_hour": S.departure_hour(time),
        "departure_date": S.departure_date(time),
        "day_of_week": S.day_of_week(time),
    })


def clean_departures(raw: DataFrame, processed_at=None, local_tz: str | None = None) -> DataFrame:
    """The whole cleaning job as one lazy plan.

    ``processed_at`` defaults to the query start time; pass a literal for reproducible output.
    """
    return finish(filter_required(filter_ready(raw)), processed_at, local_tz)


def finish(ready: DataFrame, processed_at=None, local_tz: str | None = None) -> DataFrame:
    """Deduplicate, stamp and derive rows that passed the required-field filter."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return derive(dedup_departures(ready).withColumn("processed_at", stamp), local_tz)


def clean_stats(raw: DataFrame) -> DataFrame:
    """D5 as a query: raw_count, clean_count, duplicates_removed in ONE aggregate.

    clean_count is the number of distinct keys among rows that pass C1 (exactly the dedup
    output size), so no second plan and no join of two one-row frames is needed.
    """
    df = filter_ready(raw)
    valid = required_present()
    key = F.when(valid, F.struct(*DEDUP_KEY))
    out = df.agg(F.count(F.lit(1)).alias("raw_count"),
                 F.count_distinct(key).alias("clean_count"))
    return out.withColumn("duplicates_removed", F.col("raw_count") - F.col("clean_count"))


def filter_ready(raw: DataFrame) -> DataFrame:
    """Parsed + filled frame before C1 (what the required-field filter sees)."""
    return fill_defaults(parse_timestamps(conform_raw(raw)))

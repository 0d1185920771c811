"""Schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Stations polled when no list is given.
DEFAULT_STATIONS = [
    "Brussels-South",
    "Brussels-North",
    "Brussels-Central",
    "Gent-Sint-Pieters",
    "Antwerpen-Centraal",
]
# Null defaults applied by the cleaning step.
CLEAN_DEFAULTS = {
    "delay_seconds": 0,
    "canceled": False,
    "platform": "unknown",
    "occupancy": "unknown",
    "vehicle_type": "unknown",
}
# Dedup key: same train at the same station at the same time.
DEDUP_KEY = ["station_id", "vehicle_id", "scheduled_time"]
# Columns that must be present for a row to be kept by the cleaning step.
REQUIRED_COLUMNS = ["station_id", "vehicle_id", "scheduled_time"]
# Fields that must be non-empty for an event to be published.
PUBLISH_REQUIRED = ["station_id", "vehicle_id"]
# Dead-letter reasons.
REASON_MISSING = "Missing required fields"
REASON_MALFORMED_NUMBER = "Malformed number"
# Accepted values declared by the data tests.
ACCEPTED_OCCUPANCY = ["low", "medium", "high", "unknown"]
ACCEPTED_CANCELED = [True, False]
# Report orderings.
PERIOD_ORDER = ["Morning", "Afternoon", "Evening", "Night"]
OCCUPANCY_ORDER = ["low", "medium", "high", "unknown"]
# Peak hours (inclusive ranges) and day periods (inclusive ranges; the rest is Night).
PEAK_RANGES = [(7, 9), (16, 18)]
PERIOD_RANGES = [("Morning", 6, 11), ("Afternoon", 12, 16), ("Evening", 17, 20)]
NIGHT = "Night"
# Separator of bilingual station names ("Brussel-Zuid/Bruxelles-Midi").
NAME_SEPARATOR = "/"
# Default flush policy of the landing stream: 100 messages or 60 seconds.
FLUSH_MESSAGES = 100
FLUSH_SECONDS = 60
# Default topic names of the message sinks (any name can be passed).
TOPIC_DEPARTURES = "departures"
TOPIC_DEAD_LETTER = "departures-dead-letter"
CONSUMER_GROUP = "tardy-landing"
# Lake layout for landed raw files.
LAKE_CONTAINER = "raw"
LAKE_DIRECTORY = "departures"
# ---------------------------------------------------------------------------

# Raw departures as read by the cleaning step (12 columns, explicit, no inference).
RAW_SCHEMA = StructType([
    StructField("station_id", StringType(), True),
    StructField("station_name", StringType(), True),
    StructField("destination", StringType(), True),
    StructField("destination_id", StringType(), True),
    StructField("scheduled_time", StringType(), True),
    StructField("delay_seconds", LongType(), True),
    StructField("canceled", BooleanType(), True),
    StructField("vehicle_id", StringType(), True),
    StructField("vehicle_type", StringType(), True),
    StructField("platform", StringType(), True),
    StructField("occupancy", StringType(), True),
    StructField("ingested_at", StringType(), True),
])
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Raw departures as written by the landing step: delay is a 32-bit int there.
LANDED_SCHEMA = StructType([
    StructField(f.name, IntegerType() if f.name == "delay_seconds" else f.dataType, True)
    for f in RAW_SCHEMA.fields
])

# One departure event message (JSON value on the topic).
EVENT_SCHEMA = LANDED_SCHEMA

# Liveboard document. Departures and the board's station stay JSON text at first: each departure is parsed once
# on its own, so a missing key, a null and the type of a value can be told apart and a bad departure
# can be kept as it was received.
BOARD_TEXT_SCHEMA = StructType([
    StructField("stationinfo", StringType()),
    StructField("departures", StructType([StructField("departure", ArrayType(StringType()))])),
])

# Processed (cleaned) departures, partitioned by departure_date. Reading with this schema unites
# files by column name (a column missing from older files reads as null) without inference.
PROCESSED_SCHEMA = StructType([
    StructField("station_id", StringType(), True),
    StructField("station_name", StringType(), True),
    StructField("destination", StringType(), True),
    StructField("destination_id", StringType(), True),
    StructField("scheduled_time", TimestampNTZType(), True),
    StructField("delay_seconds", LongType(), True),
    StructField("canceled", BooleanType(), True),
    StructField("vehicle_id", StringType(), True),
    StructField("vehicle_type", StringType(), True),
    StructField("platform", StringType(), True),
    StructField("occupancy", StringType(), True),
    StructField("ingested_at", TimestampNTZType(), True),
    StructField("processed_at", TimestampType(), True),
    StructField("is_delayed", BooleanType(), True),
    StructField("delay_minutes", DoubleType(), True),
    StructField("departure_hour", IntegerType(), True),
    StructField("day_of_week", IntegerType(), True),
    StructField("departure_date", DateType(), True),
])

# Dead-letter message.
DEAD_LETTER_SCHEMA = StructType([
    StructField("original_message", EVENT_SCHEMA),
    StructField("failure_reason", StringType()),
    StructField("original_text", StringType()),
])

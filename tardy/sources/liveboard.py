"""Liveboard documents -> departure events.

A document is nested JSON: ``stationinfo{id, standardname}`` and
``departures{departure[...]}`` with every departure field optional and numbers as text.
A document is cut into its departures' texts once and each departure is parsed once, to a VARIANT, inside the
generators that yield the rows, so that neither the typed gets above them nor a filter that is pushed
down repeats a parse; a batch of documents is split across tasks like any other rows.

A missing key takes its default ("" for ids and names, "unknown" occupancy, 0 delay, epoch 0
time, not canceled), in nested objects too; an explicit null of a text field stays null, for cleaning to
fill. A nested object that is itself null or no object counts as missing. Only the
text "1" cancels a departure, the number 1 does not. A null or unparseable document contributes no
rows (a failed fetch). A number that is present but null, not an integer or out of range (32 bits
for delays, the years 1 to 9999 for times) is not silently zeroed: the departure is kept with
``parse_error = "Malformed number"`` and its JSON text, so routing can send it to the dead letters
as it was received.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.functions import scalars as S
from tardy.session import pin_utc
from tardy.schemas import (
    BOARD_TEXT_SCHEMA,
    DEFAULT_STATIONS,
    LANDED_SCHEMA,
    REASON_MALFORMED_NUMBER,
)

EVENT_COLUMNS = [f.name for f in LANDED_SCHEMA.fields]


def parse_documents(docs: DataFrame, document_col: str = "document") -> DataFrame:
    """Documents -> one row per departure: its JSON text (``dep_text``), VARIANT (``dep``), ``pos``, and the
    board's ``stationinfo`` text."""
    docs.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")     # the last value of a key counts
    keep = [c for c in docs.columns if c != document_col]
    # a generator of one row: what it yields is a column that no later step evaluates again
    boards = docs.select(*keep, F.inline(F.array(F.from_json(F.col(document_col), BOARD_TEXT_SCHEMA))))
    listed = F.transform("departures.departure", lambda t: F.struct(t.alias("text"), F.try_parse_json(t).alias("dep")))
    rows = boards.select(*keep, "stationinfo", F.posexplode(listed).alias("pos", "_d"))
    return rows.select(*keep, "stationinfo", "pos", F.col("_d.text").alias("dep_text"), F.col("_d.dep").alias("dep"))


def _get(variant: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(variant, f"$.{path}", kind)


def _has(variant: Column, path: str) -> Column:
    """The key is there, be its value null or not."""
    return _get(variant, path, "variant").isNotNull()


def _is_text(variant: Column, path: str) -> Column:
    return F.schema_of_variant(_get(variant, path, "variant")) == F.lit("STRING")


# Text fields of an event: (object, path, what a missing key takes).
TEXT_FIELDS = {
    "station_id": ("_board", "id", ""),
    "station_name": ("_board", "standardname", ""),
    "destination": ("dep", "station", ""),
    "destination_id": ("dep", "stationinfo.id", ""),
    "vehicle_id": ("dep", "vehicle", ""),
    "vehicle_type": ("dep", "vehicleinfo.type", ""),
    "platform": ("dep", "platform", ""),
    "occupancy": ("dep", "occupancy.name", "unknown"),
}


def with_values(rows: DataFrame) -> DataFrame:
    """``parse_documents`` rows and the values found in them, each looked up and converted once: the fields' texts
    (``_<field>``), the numbers' texts and values, ``parse_error``."""
    dep = F.col("dep")
    out = S.once(rows, _board=F.try_parse_json("stationinfo"))
    out = S.once(out, **{f"_{k}": _get(F.col(v), path) for k, (v, path, _) in TEXT_FIELDS.items()},
                 _time=_get(dep, "time"), _delay=_get(dep, "delay"), _canceled=_get(dep, "canceled"))
    out = S.once(out, _seconds=S.int_value("_time", "bigint"), _delay_value=S.int_value("_delay"))
    return S.once(out, parse_error=parse_error())


def departure_columns(ingested_at: Column | None = None) -> dict[str, Column]:
    """The event columns of ``with_values`` rows."""
    def text(name: str) -> Column:
        """The value, null included; the default only where the key is missing."""
        variant, path, default = TEXT_FIELDS[name]
        value = F.col(f"_{name}")
        return S.with_default(value, default, value.isNotNull() | _has(F.col(variant), path))

    return {
        "station_id": text("station_id"),
        "station_name": text("station_name"),
        "destination": text("destination"),
        "destination_id": text("destination_id"),
        "scheduled_time": S.seconds_to_iso("_seconds"),
        "delay_seconds": S.parse_int_default("_delay", value=F.col("_delay_value")),
        "canceled": S.decode_flag("_canceled", _is_text(F.col("dep"), "canceled")),
        "vehicle_id": text("vehicle_id"),
        "vehicle_type": text("vehicle_type"),
        "platform": text("platform"),
        "occupancy": text("occupancy"),
        "ingested_at": S.iso_utc_micros(F.current_timestamp()) if ingested_at is None else ingested_at,
    }


def parse_error() -> Column:
    dep, time, delay = F.col("dep"), F.col("_time"), F.col("_delay")
    null_number = (time.isNull() & _has(dep, "time")) | (delay.isNull() & _has(dep, "delay"))
    bad = (null_number | S.is_malformed_epoch(time, F.col("_seconds"))
           | S.is_malformed_number(delay, value=F.col("_delay_value")))
    return F.when(bad, F.lit(REASON_MALFORMED_NUMBER))


def liveboard_events(docs: DataFrame, ingested_at: Column | None = None,
                     document_col: str = "document") -> DataFrame:
    """All parsed departures: the 12 event columns, ``parse_error``, the departure's JSON text
    (``original_text``) and the document keys."""
    pin_utc(docs.sparkSession)
    rows = parse_documents(docs, document_col)
    cols = departure_columns(ingested_at)
    keep = [c for c in rows.columns if c not in ("stationinfo", "dep", "dep_text")]
    err = F.col("parse_error")
    return with_values(rows).select(*keep, *[(F.when(err.isNull(), v) if k == "delay_seconds" else v).alias(k)
                                             for k, v in cols.items()],
                                    err, F.col("dep_text").alias("original_text"))


def flatten_liveboards(docs: DataFrame, ingested_at: Column | None = None,
                       document_col: str = "document") -> DataFrame:
    """Well-formed departures only, as the 12-column event."""
    ev = liveboard_events(docs, ingested_at, document_col)
    return ev.filter(F.col("parse_error").isNull()).select(*EVENT_COLUMNS)


def multi_station_ingest(docs: DataFrame, stations: list[str] | None = None,
                         ingested_at: Column | None = None,
                         station_col: str = "requested_station") -> DataFrame:
    """The union of the requested stations' boards (default: the five hubs).

    ``docs`` holds one row per fetched board (``requested_station``, ``document``); a failed
    fetch is a null document and contributes nothing. The station list is a plain ``isin``
    filter, pushed into the scan when the boards are a Parquet table.
    """
    wanted = list(stations or DEFAULT_STATIONS)
    return flatten_liveboards(docs.filter(F.col(station_col).isin(wanted)), ingested_at)


def distinct_station_count(events: DataFrame) -> DataFrame:
    """D3: number of distinct station names among fetched departures."""
    return events.agg(F.count_distinct("station_name").alias("station_count"))

"""Domain fixtures derived from the driver tables by Spark (no made-up input).

``raw_departures`` maps every ``events`` row to a departure as it would land from the message
stream, planting the dirty cases the cleaning step must handle: null and empty ids, malformed and
null times, replays (every 20th event arrives twice, later and with a larger delay), null fillable
fields, bilingual station names, a station listed under two names, destinations of which some are stations,
a station without night departures, 24 hours over 30 days.

``liveboard_documents`` turns the same events into nested liveboard JSON documents (one per
event, one or two departures each) with missing sections, nulls inside nested objects, null and malformed documents,
malformed, null and out-of-range numbers, so the flattening and routing steps run over data that grows with the tables.

Both are narrow projections (plus a two-way ``explode`` for replays): no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.functions.scalars import iso_utc, once
from tardy.schemas import DEFAULT_STATIONS, RAW_COLUMNS
from tardy.session import pin_utc

# Fixed values of the fixture: names of the five stations by `their index.
STATION_NAMES = ["Zuid/Midi", "Noord/Nord", "Centraal/Central", "Gent", "Antwerpen"]
SECOND_NAME = "Zuid"               # the first station is also listed under this name


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _mod(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(m))


def _pick(key: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v))
    return expr


def station_index(e: Column, ts: Column) -> Column:
    """0-4. The last station has no departures before six, so a report over hours has empty cells."""
    return F.when((_mod(e, 5) == 4) & (F.hour(ts) < 6), F.lit(0)).otherwise(_mod(e, 5))


def raw_departures_from_events(ev: DataFrame, keyed: bool = False) -> DataFrame:
    """``keyed`` keeps the event's id and the copy number ``n`` beside the 12 columns."""
    e, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    # replay copy n = 1 for every 20th event; a generator, not a join
    rep = ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.explode(F.when(_mod(e, 20) == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("n"))
    n = F.col("n")
    stop = station_index(e, ts)
    station_id = (F.when(_mod(e, 97) == 5, F.lit(None).cast("string"))
                  .when(_mod(e, 101) == 7, F.lit(""))
                  .otherwise(F.concat(F.lit("ST"), stop.cast("string"))))
    station_name = (F.when(_mod(e, 101) == 7, F.lit(""))
                    .when((stop == 0) & (_mod(e, 3) == 0), F.lit(SECOND_NAME))
                    .otherwise(_pick(stop, STATION_NAMES)))
    scheduled = (F.when(_mod(e, 83) == 3, F.lit("bad"))
                 .when(_mod(e, 89) == 4, F.lit(None).cast("string"))
                 .otherwise(iso_utc(F.date_trunc("minute", ts))))
    delay = (F.when(_mod(e, 11) == 0, F.lit(None).cast("int"))
             .when(F.col("event_type") == "view", F.lit(0))
             .otherwise((F.floor("value").cast("int") * 3 + n * 30).cast("int")))
    canceled = F.when(_mod(e, 13) == 0, F.lit(None).cast("boolean")).otherwise(F.col("event_type") == "error")
    vehicle_id = F.when(_mod(e, 103) == 9, F.lit(None).cast("string")).otherwise(F.concat(F.lit("V"), u.cast("string")))
    vehicle_type = F.when(_mod(e, 17) == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    platform = F.when(_mod(e, 7) == 0, F.lit(None).cast("string")).otherwise(_mod(e, 12).cast("string"))
    occ = _mod(e, 9)
    occupancy = (F.when(occ < 2, F.lit("low")).when(occ < 5, F.lit("medium"))
                 .when(occ < 7, F.lit("high")).otherwise(F.lit(None).cast("string")))
    ingested = iso_utc(ts + F.make_dt_interval(F.lit(0), F.lit(0), (n + 1).cast("int"), F.lit(0)))
    return rep.select(
        station_id.alias("station_id"),
        station_name.alias("station_name"),
        F.concat(F.lit("Dest "), _mod(u, 7).cast("string")).alias("destination"),
        F.concat(F.lit("ST"), _mod(u, 7).cast("string")).alias("destination_id"),
        scheduled.alias("scheduled_time"),
        delay.alias("delay_seconds"),
        canceled.alias("canceled"),
        vehicle_id.alias("vehicle_id"),
        vehicle_type.alias("vehicle_type"),
        platform.alias("platform"),
        occupancy.alias("occupancy"),
        ingested.alias("ingested_at"),
        *(["event_id", "n"] if keyed else []),
    ).select(*RAW_COLUMNS, *(["event_id", "n"] if keyed else []))


def raw_departures(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """The landed raw departures (12 columns, delay as INT like the landing writer)."""
    pin_utc(spark)
    return raw_departures_from_events(events(spark, sf_dir), keyed)


# Milliseconds between the messages of a thousand: fast ones fill a flush, slow ones wait for its time.
ARRIVAL_STEPS = (100, 500, 200)
ARRIVAL_START_MS = 1_700_000_000_000


def arrival_ms() -> Column:
    """When the message of an event (with copy number ``n``) reaches the log: bursts ten minutes apart."""
    e, burst = F.col("event_id"), F.expr("event_id div 1000")
    step = _pick(_mod(burst, len(ARRIVAL_STEPS)), list(ARRIVAL_STEPS))
    return F.lit(ARRIVAL_START_MS) + burst * 600_000 + _mod(e, 1000) * step + F.col("n") * 50


# ---------------------------------------------------------------------------
# Liveboard documents
# ---------------------------------------------------------------------------

def _member(name: str, value: Column) -> Column:
    """``"name":value`` as JSON text; a null value leaves the member out."""
    return F.concat(F.lit(f'"{name}":'), value)


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _departure_members() -> dict[str, Column]:
    """The members that all departures of an event share, as JSON text; null ones are left out. Numbers are text,
    some malformed, too large, null or left out."""
    e, u, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    gone, null = F.lit(None).cast("string"), F.lit("null")
    delay = (F.when(_mod(e, 53) == 6, _quoted(F.lit("n/a")))
             .when(_mod(e, 59) == 7, _quoted(F.lit("3000000000")))
             .when(_mod(e, 61) == 8, null)
             .when(_mod(e, 11) == 0, gone)
             .when(etype == "view", _quoted(F.lit(0)))
             .otherwise(_quoted(F.floor("value").cast("bigint") * 3)))
    canceled = (F.when(_mod(e, 19) == 3, F.lit("1"))
                .when(etype == "error", _quoted(F.lit(1)))
                .when(_mod(e, 13) == 0, gone).otherwise(_quoted(F.lit(0))))
    platform = F.when(_mod(e, 7) == 0, gone).when(_mod(e, 23) == 4, null).otherwise(_quoted(_mod(e, 12)))
    occ = _mod(e, 9)
    level = F.when(occ < 2, F.lit("low")).when(occ < 5, F.lit("medium")).when(occ < 7, F.lit("high"))
    return {
        "_station": _member("station", _quoted(F.concat(F.lit("Dest "), _mod(u, 7).cast("string")))),
        "_info": _member("stationinfo", _object(_member("id", F.when(_mod(e, 71) == 11, null).otherwise(
            _quoted(F.concat(F.lit("D"), _mod(u, 7).cast("string"))))))),
        "_epoch": F.unix_timestamp(F.date_trunc("minute", F.col("ts"))),
        "_delay": _member("delay", delay), "_canceled": _member("canceled", canceled),
        "_vehicleinfo": _member("vehicleinfo", F.when(_mod(e, 89) == 15, null).when(_mod(e, 17) != 0, _object(
            _member("type", F.when(_mod(e, 73) == 12, null).otherwise(_quoted(F.upper(etype))))))),
        "_platform": _member("platform", platform),
        "_occupancy": _member("occupancy", F.when(_mod(e, 79) == 13, _object(_member("name", null)))
                              .when(level.isNotNull(), _object(_member("name", _quoted(level))))),
    }


def _departure_json(offset_seconds: int, vehicle_shift: int) -> Column:
    """One departure object of an event with its ``_departure_members``."""
    e, u = F.col("event_id"), F.col("user_id")
    gone, null = F.lit(None).cast("string"), F.lit("null")
    time = F.when(_mod(e, 67) == 9, F.lit("999999999999999")).otherwise(
        (F.col("_epoch") + F.lit(offset_seconds)).cast("string"))
    vehicle = (F.when(_mod(e, 103) == 9, gone).when(_mod(e, 107) == 10, null)
               .otherwise(_quoted(F.concat(F.lit("V"), (u + vehicle_shift).cast("string")))))
    return _object(F.col("_station"), F.col("_info"), _member("time", _quoted(time)), F.col("_delay"), F.col("_canceled"),
                   _member("vehicle", vehicle), F.col("_vehicleinfo"), F.col("_platform"), F.col("_occupancy"))


def liveboard_documents_from_events(ev: DataFrame) -> DataFrame:
    """(doc_id, requested_station, document) — document is JSON text or null."""
    e = F.col("event_id")
    null = F.lit("null")
    info = _object(_member("id", F.when(_mod(e, 109) == 14, null).otherwise(
                       _quoted(F.concat(F.lit("BE.ST"), _mod(e, 5).cast("string"))))),
                   _member("standardname", F.when(_mod(e, 103) == 9, null).otherwise(
                       _quoted(_pick(_mod(e, 5), STATION_NAMES)))))
    rows = once(ev.select("event_id", "ts", "user_id", "event_type", "value"), **_departure_members())
    rows = once(rows, _one=_departure_json(0, 0), _two=F.when(_mod(e, 4) == 0, _departure_json(600, 1)), _board=info)
    boards = F.when(_mod(e, 31) == 1, F.lit("{}")).otherwise(F.concat_ws(",", "_one", "_two"))
    listed = _object(_member("departure", F.concat(F.lit("["), boards, F.lit("]"))))
    text = _object(_member("stationinfo", F.when(_mod(e, 37) != 2, F.col("_board"))),
                   _member("departures", F.when(_mod(e, 41) != 3, listed)))
    text = (F.when(_mod(e, 43) == 4, F.lit(None).cast("string"))
            .when(_mod(e, 47) == 5, F.substring(text, 1, 25))
            .otherwise(text))
    return rows.select(
        e.alias("doc_id"),
        _pick(_mod(e, 5), DEFAULT_STATIONS).alias("requested_station"),
        text.alias("document"),
    )


def liveboard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return liveboard_documents_from_events(events(spark, sf_dir))

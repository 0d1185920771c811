"""Liveboards to events to messages: generated boards, edge values, evidence in the dead letters."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tardy.functions import scalars as S
from tardy.schemas import EVENT_SCHEMA, REASON_MALFORMED_NUMBER, REASON_MISSING
from tardy.sources import fixtures as X
from tardy.sources import liveboard as L
from tardy.sources import messages as P

from conftest import SF_SMALL
from rows import board, departure, raw_row

NOW = "2026-05-12T15:05:00+00:00"


def _docs(spark, documents, station="Gent-Sint-Pieters"):
    return spark.createDataFrame([(i, station, d) for i, d in enumerate(documents)],
                                 "doc_id long, requested_station string, document string")


def _events(spark, *documents):
    return L.liveboard_events(_docs(spark, documents), F.lit(NOW))


def _one(spark, **changes):
    return _events(spark, board(departure(1, **changes))).first()


def test_a_board_of_forty_departures(spark):
    n = 40
    rows = _events(spark, board(*map(departure, range(n)))).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(n))
    for k, r in enumerate(rows):
        due = dt.datetime.fromtimestamp(1_700_000_000 + 900 * k, dt.UTC)
        assert r["scheduled_time"] == due.isoformat()
        assert (r["station_id"], r["station_name"], r["ingested_at"]) == ("S7", "Hill/Heuvel", NOW)
        assert (r["destination"], r["destination_id"], r["vehicle_id"]) == (f"Town {k % 4}", f"T{k % 4}", f"train-{k}")
        assert (r["delay_seconds"], r["canceled"], r["occupancy"]) == (60 * (k % 3), k % 5 == 4, ["low", "high"][k % 2])
        assert r["parse_error"] is None and json.loads(r["original_text"]) == departure(k)


def test_stamp_of_now_is_utc_text(spark):
    stamp = L.flatten_liveboards(_docs(spark, [board(departure(0))])).first()["ingested_at"]
    age = dt.datetime.now(dt.UTC) - dt.datetime.fromisoformat(stamp)
    assert abs(age) < dt.timedelta(minutes=10)


@pytest.mark.parametrize("document", [None, "", "{", "[]", "{}", '{"departures": {}}', '{"departures": {"departure": []}}'])
def test_documents_without_departures(spark, document):
    assert _events(spark, document, board(departure(0))).count() == 1


def test_missing_keys_take_defaults_and_nulls_stay(spark):
    keys = list(departure(1))
    bare = _one(spark, **dict.fromkeys(keys, "left out")).asDict()
    assert {bare[c] for c in ("destination", "destination_id", "vehicle_id", "vehicle_type", "platform")} == {""}
    assert (bare["scheduled_time"], bare["delay_seconds"]) == ("1970-01-01T00:00:00+00:00", 0)
    assert (bare["canceled"], bare["occupancy"], bare["parse_error"]) == (False, "unknown", None)
    nulls = _one(spark, station=None, vehicle=None, platform=None, canceled=None)
    assert [nulls[c] for c in ("destination", "vehicle_id", "platform")] == [None] * 3
    assert nulls["canceled"] is False and nulls["parse_error"] is None


def test_nulls_inside_nested_objects_stay_and_missing_ones_do_not(spark):
    nulls = _one(spark, stationinfo={"id": None}, vehicleinfo={"type": None}, occupancy={"name": None})
    assert [nulls[c] for c in ("destination_id", "vehicle_type", "occupancy")] == [None] * 3
    for gone in ({}, None, "text", 7):
        bare = _one(spark, stationinfo=gone, vehicleinfo=gone, occupancy=gone)
        assert [bare[c] for c in ("destination_id", "vehicle_type", "occupancy")] == ["", "", "unknown"]
    text = json.dumps({"stationinfo": {"id": None, "standardname": None}, "departures": {"departure": [departure(1)]}})
    event = _events(spark, text).first()
    assert (event["station_id"], event["station_name"]) == (None, None)
    # the last value of a repeated key counts, as in any JSON reader
    twice = json.dumps(departure(1)).replace('"platform":', '"platform": "x", "platform":')
    assert _events(spark, '{"stationinfo": {"id": "S"}, "departures": {"departure": [' + twice + "]}}").first()["platform"] == departure(1)["platform"]


def test_a_plan_parses_documents_and_departures_once(spark):
    events = _events(spark, board(departure(1)))
    plan = P.routed(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("tryParseJson") + plan.count("try_parse_json") <= 3, plan


@pytest.mark.parametrize(("field", "value", "error"), [
    ("delay", "12a", True), ("delay", "", True), ("delay", "1.5", True), ("delay", None, True),
    ("delay", "3000000000", True), ("delay", "2147483647", False), ("delay", "-2147483648", False), ("delay", 90, False),
    ("delay", " +7 ", False), ("delay", "1_000", False), ("time", "999999999999999", True), ("time", "soon", True),
    ("time", None, True), ("time", "253402300799", False), ("time", "-62135596800", False), ("time", "-62135596801", True),
])
def test_numbers_out_of_form_or_range_are_routed_with_their_text(spark, field, value, error):
    events = _events(spark, board(departure(1, **{field: value}), departure(2)))
    bad = events.orderBy("pos").first()
    assert bad["parse_error"] == (REASON_MALFORMED_NUMBER if error else None)
    assert L.flatten_liveboards(_docs(spark, [board(departure(1, **{field: value}), departure(2))])).count() == 2 - error
    letters = [json.loads(r["value"]) for r in P.to_dead_letters(events).collect()]
    assert [json.loads(x["original_text"])[field] for x in letters] == [value] * error
    if error and field == "delay":
        assert bad["delay_seconds"] is None             # never a silent zero


@pytest.mark.parametrize(("value", "canceled"), [("1", True), ("0", False), (1, False), (True, False), ("yes", False)])
def test_only_the_text_one_cancels(spark, value, canceled):
    assert _one(spark, canceled=value)["canceled"] is canceled


def test_ingest_takes_the_wanted_stations_only(spark):
    names = ["Brussels-South", "Gent-Sint-Pieters", "Elsewhere"]
    docs = None
    for i, name in enumerate(names):
        part = _docs(spark, [board(*map(departure, range(i + 1))), None], name)
        docs = part if docs is None else docs.unionByName(part)
    assert L.multi_station_ingest(docs, names[:1]).count() == 1
    assert L.multi_station_ingest(docs).count() == 1 + 2            # the default list has no "Elsewhere"
    assert L.multi_station_ingest(docs, names).count() == 6


def test_integer_text_grammar(spark):
    want = {" 12 ": 12, "+5": 5, "-3": -3, "1_0": 10, "1__0": None, "_1": None, "1_": None, "0x1": None, "12.0": None, "٣": None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    got = {r["t"]: (r["n"], r["bad"]) for r in df.select(
        "t", S.parse_int_default("t").alias("n"), S.is_malformed_number("t").alias("bad")).collect()}
    assert got == {k: (v, v is None) for k, v in want.items()}
    assert df.select(S.parse_int_default(F.lit(None).cast("string"), 4).alias("n")).first()["n"] == 4


def test_iso_text_has_microseconds_only_when_there_are_some(spark):
    times = [dt.datetime(2026, 5, 12, 8, 1, 2, us) for us in (0, 5, 120_000)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert [r[0] for r in df.select(S.iso_utc_micros("t")).collect()] == [
        t.replace(tzinfo=dt.UTC).isoformat(timespec="microseconds" if t.microsecond else "seconds") for t in times]


def _typed(spark, *rows):
    return spark.createDataFrame([tuple(r[f.name] for f in EVENT_SCHEMA.fields) for r in rows], EVENT_SCHEMA)


def test_every_event_goes_to_exactly_one_sink(spark):
    ids = [None, "", "S1", "S2"]
    rows = [raw_row(station_id=s, vehicle_id=v, delay_seconds=i) for i, (s, v) in enumerate((s, v) for s in ids for v in ids)]
    events = _typed(spark, *rows)
    sent, dead = P.to_messages(events).collect(), P.to_dead_letters(events).collect()
    assert (len(sent), len(dead)) == (4, 12)
    assert P.publish_counts(events).first().asDict() == {"published": 4, "failed": 12}
    assert all(json.loads(m["value"])["station_id"] == m["key"] for m in sent)
    letters = [json.loads(m["value"]) for m in dead]
    assert {x["failure_reason"] for x in letters} == {REASON_MISSING}
    seen = [json.loads(m["value"])["delay_seconds"] for m in sent] + [x["original_message"]["delay_seconds"] for x in letters]
    assert sorted(seen) == list(range(16))
    assert all(set(x["original_message"]) == set(rows[0]) for x in letters)       # nulls are written too
    assert P.publish_counts(events.limit(0)).first().asDict() == {"published": 0, "failed": 0}


def test_messages_survive_the_trip_through_text_and_files(spark, tmpdir_fresh):
    raw = X.raw_departures(spark, SF_SMALL)
    back = raw.select(P.parse_message(P.event_json()).alias("m")).select("m.*")
    assert back.exceptAll(raw.select(*back.columns)).isEmpty() and back.count() == raw.count()
    P.route_and_write(raw, f"{tmpdir_fresh}/good", f"{tmpdir_fresh}/dead")
    counts = P.publish_counts(raw).first()
    assert spark.read.json(f"{tmpdir_fresh}/good").count() == counts["published"] > 900
    assert spark.read.json(f"{tmpdir_fresh}/dead").count() == counts["failed"] > 10


def test_the_code_of_boards_and_their_events_is_short_enough_to_be_compiled(spark):
    import re

    from tardy.plans import catalog

    docs = X.liveboard_documents(spark, SF_SMALL)
    for df in (docs, L.flatten_liveboards(docs), catalog.QUERIES["json_round_trip"](spark, SF_SMALL)):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000              # the JVM compiles no longer method
        # a number's literal is matched once, not by every expression that uses it
        assert df._jdf.queryExecution().executedPlan().toString().count("RLIKE") <= 4

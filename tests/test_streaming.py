"""Streaming over file sources: routing per micro-batch, drain, resume, dedup, running mart."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.sources import fixtures as X
from tardy.streaming import landing as SL
from tardy.streaming import replay as RP
from tardy.streaming import stateful as ST

from conftest import SF_SMALL
from rows import raw_row

EV = raw_row(delay_seconds=60)


_ARRIVAL = {"t": 1_700_000_000}


def _drop(folder, name, lines):
    """Write one message file; arrival (mtime) strictly increases, one second apart, because the
    file source orders files by modification time and a millisecond tie would reorder them."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    _ARRIVAL["t"] += 1
    os.utime(path, (_ARRIVAL["t"], _ARRIVAL["t"]))


def _stream_drops(folder):
    ok2 = {**EV, "vehicle_id": "V2"}
    _drop(folder, "f1.json", [json.dumps(EV), json.dumps(ok2)])
    _drop(folder, "f2.json", [json.dumps({**EV, "ingested_at": "2026-05-12T15:02:00+00:00"}), '{"station_id": '])
    _drop(folder, "f3.json", [json.dumps({"destination": "Beta", "delay_seconds": 0}),
                              json.dumps({**EV, "vehicle_id": ""}),
                              json.dumps({**EV, "vehicle_id": "V3"})])


def test_landing_routes_each_batch(spark, tmpdir_fresh):
    src, raw, dead, ck = (f"{tmpdir_fresh}/{n}" for n in ("in", "raw", "dead", "ck"))
    _stream_drops(src)
    SL.drain(spark, src, raw, dead, ck)
    landed = spark.read.parquet(raw)
    assert landed.count() == 4                                   # duplicate lands; dedup is the clean step
    assert sorted(os.listdir(raw)).count("_SUCCESS") == 0
    (query,) = [d for d in os.listdir(raw) if d.startswith("query=")]
    assert len([d for d in os.listdir(f"{raw}/{query}") if d.startswith("batch_id=")]) == 3   # one batch per file
    dl = [json.loads(r.value) for r in spark.read.text(dead).collect()]
    reasons = sorted(d["failure_reason"] for d in dl)
    assert reasons == ["Malformed JSON", "Missing required fields", "Missing required fields"]
    bad = [d for d in dl if d["failure_reason"] == "Malformed JSON"][0]
    assert bad["original_text"] == json.dumps({"text": '{"station_id": '}, separators=(",", ":"))
    # the landed rows are typed like the raw writer (INT delay) and read under the reader schema
    assert dict(landed.dtypes)["delay_seconds"] == "int"
    assert C.clean_departures(landed.drop("query", "batch_id")).count() == 3


def test_resume_adds_nothing_then_only_new_files(spark, tmpdir_fresh):
    src, raw, dead, ck = (f"{tmpdir_fresh}/{n}" for n in ("in", "raw", "dead", "ck"))
    _stream_drops(src)
    SL.drain(spark, src, raw, dead, ck)
    SL.drain(spark, src, raw, dead, ck)
    assert spark.read.parquet(raw).count() == 4
    _drop(src, "f4.json", [json.dumps({**EV, "vehicle_id": "V9"})])
    SL.drain(spark, src, raw, dead, ck)
    assert spark.read.parquet(raw).count() == 5


def test_flush_policy_options():
    p = SL.FlushPolicy()
    assert p.kafka_options() == {"minOffsetsPerTrigger": "100", "maxTriggerDelay": "60s"}
    assert SL.FlushPolicy(max_messages=7).kafka_options()["maxOffsetsPerTrigger"] == "7"
    assert p.trigger_interval("kafka") == "1 seconds" and p.trigger_interval("text") == "60 seconds"
    o = SL.kafka_source_options("broker:9092")
    assert o["subscribe"] == "departures" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "true"
    assert SL.kafka_source_options("b:1", skip_lost_data=True)["failOnDataLoss"] == "false"


def test_two_checkpoints_land_side_by_side(spark, tmpdir_fresh):
    raw, dead = f"{tmpdir_fresh}/raw", f"{tmpdir_fresh}/dead"
    for k in range(2):
        _drop(f"{tmpdir_fresh}/in{k}", "m.json", [json.dumps({**EV, "vehicle_id": f"W{k}{i}"}) for i in range(3)])
        SL.drain(spark, f"{tmpdir_fresh}/in{k}", raw, dead, f"{tmpdir_fresh}/ck{k}")
    assert sorted(r["vehicle_id"] for r in SL.read_landed(spark, raw).collect()) == [f"W{k}{i}" for k in range(2) for i in range(3)]


def test_compaction_keeps_every_row_and_the_newest_batch(spark, tmpdir_fresh):
    src, raw, dead, ck = (f"{tmpdir_fresh}/{n}" for n in ("in", "raw", "dead", "ck"))
    for i in range(6):
        _drop(src, f"m{i}.json", [json.dumps({**EV, "vehicle_id": f"V{i}"})])
    SL.drain(spark, src, raw, dead, ck)
    assert SL.compact_landed(spark, raw) == 5
    (query,) = [d for d in os.listdir(raw) if d.startswith("query=")]
    assert sorted(d for d in os.listdir(f"{raw}/{query}") if not d.startswith(".")) == ["batch_id=4", "batch_id=5"]
    assert SL.read_landed(spark, raw).count() == 6
    # a merge that stopped after the old folders went is finished by the next run
    os.rename(f"{raw}/{query}/batch_id=4", f"{raw}/{query}/_merged-4")
    assert SL.compact_landed(spark, raw) == 0 and SL.read_landed(spark, raw).count() == 6
    # an unfinished merge is dropped
    os.makedirs(f"{raw}/{query}/_merged-3")
    SL.compact_landed(spark, raw)
    assert SL.read_landed(spark, raw).count() == 6 and not os.path.exists(f"{raw}/{query}/_merged-3")
    _drop(src, "m9.json", [json.dumps({**EV, "vehicle_id": "V9"})])
    SL.drain(spark, src, raw, dead, ck)
    assert SL.read_landed(spark, raw).count() == 7


def test_drain_raises_when_time_runs_out(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/in"
    for i in range(40):
        _drop(src, f"m{i}.json", [json.dumps(EV)])
    with pytest.raises(TimeoutError):
        SL.drain(spark, src, f"{tmpdir_fresh}/raw", f"{tmpdir_fresh}/dead", f"{tmpdir_fresh}/ck", timeout_s=1)
    assert not [q for q in spark.streams.active if q.isActive]


def _rows(df):
    cols = sorted(c for c in df.columns if c != "processed_at")
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("batches", [1, 8])
def test_stream_dedup_is_the_batch_result_for_any_number_of_batches(spark, batches):
    raw = X.raw_departures(spark, SF_SMALL)
    want = _rows(C.clean_departures(raw))
    assert _rows(RP.replay_clean(spark, raw, batches)) == want and len(want) == 956


def _drain(spark, root, src, horizon_days=2):
    ST.drain_stream(RP.received(spark, src, 100), root, horizon_days)


def _event(day, **changes):
    return json.dumps({**EV, "scheduled_time": f"2026-05-{day:02d}T15:00:00+00:00",
                       "ingested_at": f"2026-05-{day:02d}T14:00:00+00:00", **changes})


def test_a_copy_after_its_days_horizon_is_a_dead_letter_and_state_is_dropped(spark, tmpdir_fresh):
    src, root = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    _drop(src, "m0.json", [_event(1, delay_seconds=60), _event(9, vehicle_id="V9")])
    _drain(spark, root, src)
    # the ninth's arrival closed the first: its better copy is late, the seventh is still open
    _drop(src, "m1.json", [_event(1, delay_seconds=600, ingested_at="2026-05-09T16:00:00+00:00"),
                           _event(7, vehicle_id="V7", ingested_at="2026-05-08T00:00:00+00:00")])
    _drain(spark, root, src)
    got = {(r["vehicle_id"], r["delay_seconds"]) for r in ST.read_departures(spark, root).collect()}
    assert got == {("V1", 60), ("V9", 60), ("V7", 60)}
    (late,) = [json.loads(r["value"]) for r in ST.read_late(spark, root).collect()]
    assert late["failure_reason"] == "Late" and late["original_message"]["delay_seconds"] == 600
    assert late["original_message"]["scheduled_time"] == "2026-05-01T15:00:00+00:00"
    # the state of the first departure goes with the next batch: the store holds the open ones
    _drop(src, "m2.json", [_event(9, vehicle_id="V8")])
    _drain(spark, root, src)
    store = spark.read.format("statestore").load(f"{root}/checkpoint-fold")
    assert store.count() == 3


def test_a_better_copy_replaces_the_mart_row_and_its_maximum(spark, tmpdir_fresh):
    src, root = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    times = [f"2026-05-12T16:0{i}:00+00:00" for i in range(3)]
    _drop(src, "m0.json", [json.dumps({**EV, "delay_seconds": 900, "station_name": "Old", "ingested_at": times[1]})])
    _drain(spark, root, src)
    _drop(src, "m1.json", [json.dumps({**EV, "delay_seconds": 7200, "ingested_at": times[0]}),       # older: no change
                           json.dumps({**EV, "delay_seconds": 60, "station_name": "New", "ingested_at": times[2]})])
    _drain(spark, root, src)
    (row,) = ST.read_mart(spark, root).collect()
    assert (row["station_name"], row["max_delay_seconds"], row["total_departures"]) == ("New", 60, 1)
    written = spark.read.parquet(f"{root}/changes")
    assert written.count() == 3                     # in; then in and out: work follows the batch, not what is stored


def test_a_running_stream_folds_after_every_batch(spark, tmpdir_fresh):
    src, root = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    for i in range(2):
        _drop(src, f"m{i}.json", [json.dumps({**EV, "vehicle_id": f"V{i}"}), json.dumps({**EV, "delay_seconds": 60 * i + 60,
                                  "ingested_at": f"2026-05-12T16:0{i}:00+00:00"})])
    query = ST.start_stream(RP.received(spark, src, 1), root, seconds=1)
    query.processAllAvailable()
    query.stop()
    (row,) = ST.read_mart(spark, root).collect()
    assert (row["total_departures"], row["max_delay_seconds"]) == (2, 120)
    assert spark.read.parquet(f"{root}/changes").groupBy("batch_id").count().filter("count > 0").count() == 2


def test_a_replayed_batch_replaces_its_own_changes(spark, tmpdir_fresh):
    src, root = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    _drop(src, "m0.json", [json.dumps(EV), json.dumps({**EV, "vehicle_id": "V2"})])
    _drain(spark, root, src)
    want = _rows(ST.read_mart(spark, root))
    for query in ("gate", "fold"):                                   # as if the run had died before its commit
        for commit in os.listdir(f"{root}/checkpoint-{query}/commits"):
            os.remove(f"{root}/checkpoint-{query}/commits/{commit}")
    _drain(spark, root, src)
    assert _rows(ST.read_mart(spark, root)) == want and ST.read_departures(spark, root).count() == 2


def test_flush_numbers_by_size_and_time_do_not_depend_on_batches(spark, tmpdir_fresh):
    from tardy.streaming import flushing as FL
    from tardy.streaming import messagelog as ML

    times = [0, 1, 2, 3, 70, 71, 200, 201, 202, 203, 204, 264, 265]
    rows = [(p, 10 * i + p, "k", "{}", dt.datetime.fromtimestamp(1_700_000_000 + t, dt.UTC)) for p in (0, 1) for i, t in enumerate(times)]
    want = [0, 0, 0, 1, 2, 2, 3, 3, 3, 4, 4, 5, 5]          # three fill a flush; sixty seconds end it
    for step in (50, 1000):
        root = f"{tmpdir_fresh}/{step}"
        for low in range(0, 130, step):
            part = [r for r in rows if low <= r[1] < low + step]
            ML.append_messages(spark.createDataFrame(part, ML.MESSAGE_SCHEMA), f"{root}/log", span=10)
            RP._kept(spark, FL.flush_numbers(ML.consume(spark, f"{root}/log"), size=3, seconds=60), root, "update")
        got = {(r["partition"], r["offset"]): r["flush_no"] for r in spark.read.parquet(f"{root}/out").collect()}
        assert got == {(r[0], r[1]): want[i % len(want)] for i, r in enumerate(rows)}


def test_consumer_starts_earliest_or_latest_resumes_and_reports_lost_offsets(spark, tmpdir_fresh):
    import shutil

    from tardy.streaming import messagelog as ML

    def put(low, high):
        rows = [(0, i, None, f"m{i}", dt.datetime(2026, 5, 1)) for i in range(low, high)]
        ML.append_messages(spark.createDataFrame(rows, ML.MESSAGE_SCHEMA), log, span=10)

    def drained(name, **options):
        RP._kept(spark, ML.consume(spark, log, **options), f"{tmpdir_fresh}/{name}")
        return sorted(r["offset"] for r in spark.read.parquet(f"{tmpdir_fresh}/{name}/out").collect())

    log = f"{tmpdir_fresh}/log"
    put(0, 25)
    assert drained("a") == list(range(25)) and drained("a") == list(range(25))
    assert drained("from", starting='{"0": 12}') == list(range(12, 25))
    put(30, 40)
    assert drained("a") == [*range(25), *range(30, 40)]
    with pytest.raises(ValueError, match="exists"):
        put(35, 38)
    assert ML.read_log(spark, log).count() == 35
    put(40, 50)
    shutil.rmtree(f"{log}/span=10/partition=0/segment=0")
    shutil.rmtree(f"{log}/span=10/partition=0/segment=1")
    assert drained("a")[-1] == 49                     # what is gone was read before
    assert drained("b") == [*range(20, 25), *range(30, 50)]
    with pytest.raises(Exception, match="LostOffsetsError"):
        drained("c", starting='{"0": 3}')
    assert drained("d", starting='{"0": 3}', skip_lost_data=True)[0] == 20


def test_a_log_of_many_segments_is_read_by_few_tasks(spark, tmpdir_fresh):
    from tardy.streaming import messagelog as ML

    log = f"{tmpdir_fresh}/log"
    rows = [(p, i, None, f"m{i}", dt.datetime(2026, 5, 1)) for p in (0, 1) for i in range(60)]
    ML.append_messages(spark.createDataFrame(rows, ML.MESSAGE_SCHEMA), log, span=2)
    reader = ML.MessageLogStream({"path": log, "minPartitions": "6"})
    parts = reader.partitions({"0": 3}, {"0": 51, "1": 60})
    assert len(parts) <= 8
    assert [(s[1], s[2]) for s in parts[0].segments][0] == (3, 4)
    got = sorted((p, o) for part in parts for b in reader.read(part) for p, o in zip(b["partition"].to_pylist(), b["offset"].to_pylist()))
    assert got == [(0, i) for i in range(3, 51)] + [(1, i) for i in range(60)]
    read = ML.read_log(spark, log)
    assert read.rdd.getNumPartitions() <= 12 and read.count() == 120


def test_a_longer_log_has_longer_segments(spark):
    sizes = (100, 64_000, 640_000, 10**9)
    spans = [RP._span(spark.createDataFrame([(n - 1,), (None,)], "offset long")) for n in sizes]
    assert spans == [1000, 1000, 10_000, 250_000] and RP._span(spark.createDataFrame([], "offset long")) == 1000


def test_a_stopped_landing_goes_on_and_readers_see_ledgered_batches_only(spark, tmpdir_fresh):
    src, raw, dead, ck = (f"{tmpdir_fresh}/{n}" for n in ("in", "raw", "dead", "ck"))
    for i in range(3):
        _drop(src, f"m{i}.json", [json.dumps({**EV, "vehicle_id": f"V{i}"})])

    def stop(step, batch):
        if (step, batch) == ("written", 1):
            raise RuntimeError("stopped here")

    with pytest.raises(Exception, match="stopped here"):
        SL.drain(spark, src, raw, dead, ck, after=stop)
    assert spark.read.parquet(raw).count() == 2 and SL.read_landed(spark, raw).count() == 1
    wrote = []
    SL.drain(spark, src, raw, dead, ck, after=lambda step, batch: wrote.append((step, batch)))
    assert wrote == [(s, b) for b in (1, 2) for s in ("written", "ledgered")]
    assert SL.read_landed(spark, raw).count() == 3
    assert sorted((r["batch_id"], len(r["files"])) for r in SL.read_ledger(spark, raw).collect()) == [(b, 1) for b in range(3)]


def test_running_mart_is_the_batch_mart_even_when_messages_come_twice(spark):
    raw = X.raw_departures(spark, SF_SMALL)
    want = _rows(M.StarSchema(spark, C.clean_departures(raw)).mart)
    assert _rows(RP.replay_mart(spark, raw, batches=3, twice=True)) == want


def test_a_message_is_parsed_once(spark):
    values = [json.dumps(EV), json.dumps({**EV, "vehicle_id": None}), '{"cut', "", None]
    rows = SL.parse_messages(spark.createDataFrame([(v,) for v in values], "value string"))
    kept = rows.filter(F.coalesce(F.col("failure_reason") != SL.REASON_MALFORMED_JSON, F.lit(True)))
    assert kept._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert [r["failure_reason"] for r in rows.collect()] == [
        None, "Missing required fields", *[SL.REASON_MALFORMED_JSON] * 3]

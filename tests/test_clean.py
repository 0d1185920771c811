"""Cleaning: which copy of a departure stays, what is dropped, filled and derived, and traps."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.plans.jobs import run_clean_job
from tardy.sources import fixtures as X
from tardy.sources import parquet as IO

from conftest import SF_SMALL
from rows import raw_df, stamp


def test_one_copy_per_key_whatever_the_order_of_arrival(spark):
    # three keys (two vehicles, two times); copies tie on the arrival time and differ further down the order
    copies = [{"vehicle_id": v, "scheduled_time": stamp(h), "ingested_at": stamp(16, m), "delay_seconds": d, "platform": p}
              for v, h in (("V1", 15), ("V1", 16), ("V2", 15)) for m, d, p in ((1, 90, "1"), (2, 30, "1"), (2, 30, "4"), (2, None, "9"))]
    want = {("V1", 15): "4", ("V1", 16): "4", ("V2", 15): "4"}
    for order in (copies, copies[::-1], copies[5:] + copies[:5]):
        rows = C.clean_departures(raw_df(spark, *order).repartition(5)).collect()
        assert {(r["vehicle_id"], r["departure_hour"]): r["platform"] for r in rows} == want and len(rows) == 3
        assert {r["delay_seconds"] for r in rows} == {30}


def test_a_null_sorts_behind_every_value_and_unknown_arrival_loses(spark):
    df = raw_df(spark, {"ingested_at": None, "delay_seconds": 500}, {"ingested_at": "later", "delay_seconds": 400},
                {"ingested_at": stamp(15, 1), "delay_seconds": 10})
    assert [r["delay_seconds"] for r in C.clean_departures(df).collect()] == [10]


@pytest.mark.parametrize("column", ["station_id", "vehicle_id", "scheduled_time"])
def test_counts_of_the_job_are_those_of_the_query(spark, tmpdir_fresh, column):
    df = raw_df(spark, {}, {}, {column: None}, {"vehicle_id": "V2"}, {"station_id": "A2", "scheduled_time": stamp(7)})
    df.write.parquet(f"{tmpdir_fresh}/raw")
    stats = run_clean_job(spark, f"{tmpdir_fresh}/raw", f"{tmpdir_fresh}/out")
    assert stats == C.clean_stats(df).first().asDict() == {"raw_count": 5, "clean_count": 3, "duplicates_removed": 2}
    plan = C.clean_departures(df)._jdf.queryExecution().toString()
    assert "CollectMetrics" not in plan                     # counters do not ride on tasks that may run twice


@pytest.mark.parametrize("when", ["2024-02-28T23:59:00+00:00", "2024-02-29T00:00:00+00:00", "2023-12-31T23:30:00-01:00",
                                  "2026-03-29T02:30:00+02:00"])
def test_date_parts_at_the_borders(spark, when):
    row = C.clean_departures(raw_df(spark, {"scheduled_time": when})).first()
    utc = dt.datetime.fromisoformat(when).astimezone(dt.UTC)
    assert (row["departure_date"], row["departure_hour"]) == (utc.date(), utc.hour)
    assert row["day_of_week"] == utc.isoweekday() % 7 + 1


def test_date_parts_in_a_local_zone(spark):
    row = C.clean_departures(raw_df(spark, {"scheduled_time": "2024-06-30T22:30:00+00:00"}), local_tz="Europe/Brussels").first()
    assert (row["departure_date"], row["departure_hour"], row["day_of_week"]) == (dt.date(2024, 7, 1), 0, 2)
    assert row["scheduled_time"] == dt.datetime(2024, 6, 30, 22, 30)


def test_lateness_and_minutes(spark):
    delays = list(itertools.chain(range(-130, 131, 7), [None, 2_147_483_647]))
    df = raw_df(spark, *({"vehicle_id": f"V{i}", "delay_seconds": d} for i, d in enumerate(delays)))
    got = {r["vehicle_id"]: r for r in C.clean_departures(df).collect()}
    for i, d in enumerate(delays):
        r, seconds = got[f"V{i}"], d or 0
        assert r["is_delayed"] is (seconds > 0)
        assert abs(r["delay_minutes"] - seconds / 60) <= 0.05 + 1e-9


def test_malformed_time_is_dropped_not_fatal(spark):
    # ANSI mode: a plain to_timestamp('bad') would raise; try_ semantics turn it into null
    df = raw_df(spark, {}, {"scheduled_time": "bad", "vehicle_id": "V2"}, {"scheduled_time": None, "vehicle_id": "V3"})
    assert C.clean_departures(df).count() == 1


def test_offsets_are_converted_to_utc(spark):
    df = raw_df(spark, {"scheduled_time": "2026-05-12T17:00:00+02:00"}, {"scheduled_time": "2026-05-12T15:00:00Z",
                                                                        "vehicle_id": "V2"})
    hours = {r["vehicle_id"]: r["departure_hour"] for r in C.clean_departures(df).collect()}
    assert hours == {"V1": 15, "V2": 15}


def test_fill_defaults(spark):
    df = raw_df(spark, {"delay_seconds": None, "canceled": None, "platform": None, "occupancy": None,
                        "vehicle_type": None})
    r = C.clean_departures(df).collect()[0]
    assert (r["delay_seconds"], r["canceled"], r["platform"], r["occupancy"], r["vehicle_type"]) == \
        (0, False, "unknown", "unknown", "unknown")


def test_empty_string_is_not_null(spark):
    df = raw_df(spark, {"station_id": ""})
    assert C.clean_departures(df).count() == 1


def test_delay_minutes_rounds_half_up(spark):
    df = raw_df(spark, {"delay_seconds": 3}, {"delay_seconds": 9, "vehicle_id": "V2"})
    got = sorted(r["delay_minutes"] for r in C.clean_departures(df).collect())
    assert got == [0.1, 0.2]   # 0.05 -> 0.1, 0.15 -> 0.2 (half away from zero)


def test_surrogate_key_null_part_gives_null(spark):
    from tardy.functions.scalars import surrogate_key
    df = spark.createDataFrame([("S", None, "2026-01-01 00:00:00")], "a string, b string, c string")
    assert df.select(surrogate_key("a", "b", "c").alias("k")).first()["k"] is None


def test_fixture_golden_counts(spark):
    raw = X.raw_departures(spark, SF_SMALL)
    assert raw.count() == 1050
    assert C.filter_required(C.filter_ready(raw)).count() == 1005
    star = M.StarSchema(spark, C.clean_departures(raw))
    assert star.stg.count() == 956
    assert star.dim_stations.count() == 7
    mart = star.mart
    assert mart.count() == 147
    assert mart.agg(F.sum("total_departures")).first()[0] == 1191         # the station with two names counts twice
    stats = C.clean_stats(raw).first()
    assert (stats["raw_count"], stats["clean_count"], stats["duplicates_removed"]) == (1050, 956, 94)


def test_dedup_plan_limits_before_shuffle(spark):
    raw = X.raw_departures(spark, SF_SMALL)
    plan = C.dedup_departures(C.filter_required(C.filter_ready(raw)))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_dedup_key_is_reduced_before_the_shuffle(spark):
    # one key holds a third of the rows, spread over many input partitions
    hot = [{"ingested_at": f"2026-05-12T15:{m:02d}:00+00:00", "delay_seconds": m} for m in range(1, 41)]
    cold = [{"vehicle_id": f"V{i + 2}"} for i in range(80)]
    df = raw_df(spark, *hot, *cold).repartition(8)
    out = C.dedup_departures(C.filter_required(C.filter_ready(df)))
    rows = out.filter(F.col("vehicle_id") == "V1").collect()
    assert len(rows) == 1 and rows[0]["delay_seconds"] == 40        # the latest ingest wins
    assert out.count() == 81
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the partial limit sits below the exchange: at most one row per key leaves each map task
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_hot_date_is_written_by_several_tasks(spark, tmpdir_fresh):
    import os

    from tardy.operators.clean import clean_departures
    rows = [{"vehicle_id": f"V{i}", "scheduled_time": "2026-05-12T15:00:00+00:00"} for i in range(300)]
    rows += [{"vehicle_id": f"W{i}", "scheduled_time": "2026-05-13T15:00:00+00:00"} for i in range(3)]
    df = clean_departures(raw_df(spark, *rows).repartition(6))
    IO.write_processed(df, f"{tmpdir_fresh}/p", max_records_per_file=50)
    hot = [f for f in os.listdir(f"{tmpdir_fresh}/p/departure_date=2026-05-12") if f.endswith(".parquet")]
    assert len(hot) >= 6                                             # no single file holds the hot day
    assert IO.scan_processed(spark, f"{tmpdir_fresh}/p").count() == 303

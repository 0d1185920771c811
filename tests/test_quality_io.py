"""Data-quality tests (pass and fail cases), Parquet I/O and the end-to-end run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.operators import quality as Q
from tardy.plans.jobs import build_models, run_all, run_clean_job
from tardy.sources import fixtures as X
from tardy.sources import parquet as IO
from tardy.sources import versions

from conftest import SF_SMALL
from rows import raw_df


def _star(spark, df):
    return M.StarSchema(spark, C.clean_departures(df))


def test_declared_tests_on_fixture(spark):
    star = _star(spark, X.raw_departures(spark, SF_SMALL))
    rows = Q.quality_report(star.tables()).collect()
    assert len(rows) == 16
    assert {r.model for r in rows} == {"stg_departures", "dim_stations", "dim_time", "fct_delays",
                                       "mart_delay_summary"}
    # the fixture lists one station under two names; everything else passes
    assert {r.test_name: r.failures for r in rows if r.failures} == {"unique_dim_stations_station_id": 1}


def test_renamed_station_breaks_unique_and_fans_out(spark):
    df = raw_df(spark, {}, {"station_name": "Alpha/Alfa", "vehicle_id": "V2"})
    star = _star(spark, df)
    assert Q.dq_unique(star.dim_stations, "station_id").first()["n_records"] == 2
    # the mart keeps the fan-out: each name gets its own group with the station's count
    assert star.mart.agg(F.sum("total_departures")).first()[0] == 4
    fails = {r.test_name: r.failures for r in Q.quality_report(star.tables()).collect()}
    assert fails["unique_dim_stations_station_id"] == 1


def test_orphan_fact_breaks_relationships(spark):
    star = _star(spark, raw_df(spark, {}, {"station_id": "S9", "vehicle_id": "V2"}))
    dims = star.dim_stations.filter(F.col("station_id") == "A1")
    orphans = Q.dq_relationships(star.fct, "station_id", dims, "station_id").collect()
    assert [r["station_id"] for r in orphans] == ["S9"]


def test_occupancy_outside_list(spark):
    star = _star(spark, raw_df(spark, {"occupancy": "packed"}, {"occupancy": None, "vehicle_id": "V2"}))
    bad = Q.dq_accepted_values(star.stg, "occupancy", ["low", "medium", "high", "unknown"]).collect()
    assert [(r["occupancy"], r["n_records"]) for r in bad] == [("packed", 1)]
    assert Q.dq_not_null(star.stg, "occupancy").count() == 0     # null was filled with 'unknown'


def test_assert_passed_raises(spark):
    star = _star(spark, raw_df(spark, {}, {"station_name": "Other", "vehicle_id": "V2"}))
    with pytest.raises(AssertionError):
        Q.assert_passed(Q.quality_report(star.tables()))


def test_write_raw_empty_returns_none(spark, tmpdir_fresh):
    assert IO.write_raw(raw_df(spark).limit(0), f"{tmpdir_fresh}/raw") is None


def test_raw_round_trip_int_to_long(spark, tmpdir_fresh):
    path = IO.write_raw(raw_df(spark, {}, {"vehicle_id": "V2"}), f"{tmpdir_fresh}/raw")
    back = IO.scan_raw(spark, path)
    assert dict(back.dtypes)["delay_seconds"] == "bigint"
    assert back.count() == 2
    assert dict(spark.read.parquet(path).dtypes)["delay_seconds"] == "int"


def test_processed_partitions_and_pruning(spark, tmpdir_fresh):
    raw = raw_df(spark, {}, {"scheduled_time": "2026-05-13T10:00:00+00:00", "vehicle_id": "V2"})
    raw_path = IO.write_raw(raw, f"{tmpdir_fresh}/raw")
    stats = run_clean_job(spark, raw_path, f"{tmpdir_fresh}/processed")
    assert stats["clean_count"] == 2
    back = IO.scan_processed(spark, f"{tmpdir_fresh}/processed")
    assert dict(back.dtypes)["departure_date"] == "date"
    one = back.filter(F.col("departure_date") == F.lit(dt.date(2026, 5, 13)))
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(departure_date" in plan


def test_build_models_and_run_all(spark, tmpdir_fresh):
    docs = X.liveboard_documents(spark, SF_SMALL)
    out = run_all(spark, docs, tmpdir_fresh, ingested_at=F.lit("2024-02-01T00:00:00+00:00"))
    assert out["tests_passed"] == 16
    assert out["published"] + out["failed"] == out["departures_fetched"] > 0
    assert out["raw_count"] == out["published"]
    models = {n: IO.read_model(spark, f"{tmpdir_fresh}/warehouse", n) for n in
              ("dim_stations", "dim_time", "fct_delays", "mart_delay_summary")}
    assert models["mart_delay_summary"].agg(F.sum("total_departures")).first()[0] == out["clean_count"]
    assert spark.read.json(f"{tmpdir_fresh}/dead_letters").count() == out["failed"]


def test_run_all_stops_on_empty_ingest(spark, tmpdir_fresh):
    docs = X.liveboard_documents(spark, SF_SMALL)
    with pytest.raises(ValueError):
        run_all(spark, docs, tmpdir_fresh, stations=["Nowhere"])


def test_build_models_reads_back_tables(spark, tmpdir_fresh):
    raw_path = IO.write_raw(X.raw_departures(spark, SF_SMALL), f"{tmpdir_fresh}/raw")
    run_clean_job(spark, raw_path, f"{tmpdir_fresh}/processed")
    models = build_models(spark, f"{tmpdir_fresh}/processed", f"{tmpdir_fresh}/wh")
    star = M.StarSchema(spark, C.clean_departures(X.raw_departures(spark, SF_SMALL)))
    assert models["mart_delay_summary"].exceptAll(star.mart).isEmpty()
    assert models["dim_time"].count() == 24
    assert spark.table("mart_delay_summary").count() == star.mart.count()


def test_processed_read_unites_by_name(spark, tmpdir_fresh):
    # an older file without is_delayed still reads (as null) next to a complete one
    df = C.clean_departures(raw_df(spark, {}, {"vehicle_id": "V2", "scheduled_time": "2026-05-13T10:00:00+00:00"}))
    IO.write_processed(df.filter(F.col("vehicle_id") == "V1"), f"{tmpdir_fresh}/p")
    (df.filter(F.col("vehicle_id") == "V2").drop("is_delayed")
       .write.mode("append").partitionBy("departure_date").parquet(f"{tmpdir_fresh}/p"))
    back = IO.scan_processed(spark, f"{tmpdir_fresh}/p")
    got = {r["vehicle_id"]: r["is_delayed"] for r in back.collect()}
    assert got == {"V1": False, "V2": None}
    assert dict(back.dtypes)["departure_date"] == "date"
    merged = IO.scan_processed(spark, f"{tmpdir_fresh}/p", merge_schema=True)
    assert merged.count() == 2


def test_retried_run_does_not_land_twice(spark, tmpdir_fresh):
    docs = X.liveboard_documents(spark, SF_SMALL)
    ts = F.lit("2024-02-01T00:00:00+00:00")
    first = run_all(spark, docs, tmpdir_fresh, ingested_at=ts, run_id="2024-02-01T00")
    again = run_all(spark, docs, tmpdir_fresh, ingested_at=ts, run_id="2024-02-01T00")
    assert again["raw_count"] == first["raw_count"] == first["published"]
    assert again["clean_count"] == first["clean_count"]


def test_incremental_clean_equals_full_clean(spark, tmpdir_fresh):
    from tardy.plans.jobs import run_incremental_clean

    raw = X.raw_departures(spark, SF_SMALL)
    cut = "2024-01-16T00:00:00+00:00"            # batches split by arrival time
    IO.write_raw(raw.filter(F.col("ingested_at") < cut), f"{tmpdir_fresh}/raw1")
    IO.write_raw(raw.filter(F.col("ingested_at") >= cut), f"{tmpdir_fresh}/raw2")
    run_clean_job(spark, f"{tmpdir_fresh}/raw1", f"{tmpdir_fresh}/p")
    inc = run_incremental_clean(spark, f"{tmpdir_fresh}/raw2", f"{tmpdir_fresh}/p")
    assert 0 < inc["dates_rewritten"] < 31
    got = IO.scan_processed(spark, f"{tmpdir_fresh}/p").drop("processed_at")
    want = C.clean_departures(raw).drop("processed_at")
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    # a second application of the same batch changes nothing
    run_incremental_clean(spark, f"{tmpdir_fresh}/raw2", f"{tmpdir_fresh}/p")
    assert IO.scan_processed(spark, f"{tmpdir_fresh}/p").count() == want.count()


def test_incremental_models_equal_full_build(spark, tmpdir_fresh):
    from tardy.plans.jobs import refresh_models, run_incremental_clean
    from tardy.functions.scalars import departure_date

    raw = X.raw_departures(spark, SF_SMALL)
    cut = "2024-01-16T00:00:00+00:00"
    IO.write_raw(raw.filter(F.col("ingested_at") < cut), f"{tmpdir_fresh}/raw1")
    IO.write_raw(raw.filter(F.col("ingested_at") >= cut), f"{tmpdir_fresh}/raw2")
    run_clean_job(spark, f"{tmpdir_fresh}/raw1", f"{tmpdir_fresh}/p")
    refresh_models(spark, f"{tmpdir_fresh}/p", f"{tmpdir_fresh}/wh")
    run_incremental_clean(spark, f"{tmpdir_fresh}/raw2", f"{tmpdir_fresh}/p")
    touched = C.filter_required(C.filter_ready(IO.scan_raw(spark, f"{tmpdir_fresh}/raw2"))) \
        .select(departure_date("scheduled_time").alias("departure_date")).distinct()
    inc = refresh_models(spark, f"{tmpdir_fresh}/p", f"{tmpdir_fresh}/wh", touched)
    full = build_models(spark, f"{tmpdir_fresh}/p", f"{tmpdir_fresh}/wh_full")
    for name in ("mart_delay_summary", "dim_stations", "fct_delays"):
        cols = sorted(full[name].columns)
        a = sorted((tuple(r) for r in inc[name].select(*cols).collect()), key=str)
        b = sorted((tuple(r) for r in full[name].select(*cols).collect()), key=str)
        assert a == b, name
    assert sorted(map(tuple, Q.quality_report(inc).collect())) == sorted(map(tuple, Q.quality_report(full).collect()))


def test_incremental_runs_equal_one_full_run(spark, tmpdir_fresh):
    docs = X.liveboard_documents(spark, SF_SMALL)
    ts = F.lit("2024-02-01T00:00:00+00:00")
    half = docs.agg(F.max("doc_id")).first()[0] // 2          # two fetches: earlier and later documents
    run_all(spark, docs.filter(F.col("doc_id") <= half), f"{tmpdir_fresh}/inc", ingested_at=ts,
            run_id="r1", incremental=True)
    out = run_all(spark, docs.filter(F.col("doc_id") > half), f"{tmpdir_fresh}/inc",
                  ingested_at=ts, run_id="r2", incremental=True)
    assert out["tests_passed"] == 16
    run_all(spark, docs, f"{tmpdir_fresh}/full", ingested_at=ts)
    a = IO.read_model(spark, f"{tmpdir_fresh}/inc/warehouse", "mart_delay_summary")
    b = IO.read_model(spark, f"{tmpdir_fresh}/full/warehouse", "mart_delay_summary")
    cols = sorted(b.columns)
    assert sorted((tuple(r) for r in a.select(*cols).collect()), key=str) == \
        sorted((tuple(r) for r in b.select(*cols).collect()), key=str)


def test_readers_see_one_whole_version_whatever_happens_to_a_build(spark, tmpdir_fresh):
    rows = [spark.createDataFrame([(dt.date(2024, 1, d), f"S{k}", k) for d in days], "departure_date date, station_id string, n int")
            for k, days in enumerate([(1, 2, 3), (2,)])]
    first = versions.Build(spark, tmpdir_fresh)
    first.write("t", rows[0], by_date=True)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, tmpdir_fresh, "t")              # written, not published
    assert first.publish() == 1
    old = versions.read(spark, tmpdir_fresh, "t")
    killed = versions.Build(spark, tmpdir_fresh)
    killed.write("t", rows[1], by_date=True, touched=["2024-01-02", "2024-01-03"])
    assert versions.read(spark, tmpdir_fresh, "t").agg(F.sum("n")).first()[0] == 0
    second = versions.Build(spark, tmpdir_fresh)
    second.write("t", rows[1], by_date=True, touched=["2024-01-02", "2024-01-03"])
    assert second.publish() == 2
    got = {(str(r["departure_date"]), r["n"]) for r in versions.read(spark, tmpdir_fresh, "t").collect()}
    assert got == {("2024-01-01", 0), ("2024-01-02", 1)} and old.count() == 3
    with pytest.raises(versions.StaleBuildError):
        killed.publish()
    assert versions.read(spark, tmpdir_fresh, "t", version=1).count() == 3
    assert versions.vacuum(spark, tmpdir_fresh, keep=1) == 1                # the killed build's folder
    assert versions.versions(spark, tmpdir_fresh) == [2] and versions.read(spark, tmpdir_fresh, "t").count() == 2
    empty = versions.Build(spark, tmpdir_fresh)
    empty.write("u", rows[0].limit(0), by_date=True)
    empty.publish()
    assert versions.read(spark, tmpdir_fresh, "u").dtypes == rows[0].dtypes and versions.read(spark, tmpdir_fresh, "t").count() == 2


def test_a_restarted_run_goes_on_at_the_stage_that_failed(spark, tmpdir_fresh):
    docs = X.liveboard_documents(spark, SF_SMALL)
    ran = []

    def stop_after_clean(stage):
        ran.append(stage)
        if stage == "clean":
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        run_all(spark, docs, tmpdir_fresh, ingested_at=F.lit("2024-02-01T00:00:00+00:00"), run_id="r", after=stop_after_clean)
    out = run_all(spark, docs, tmpdir_fresh, ingested_at=F.lit("2024-02-01T00:00:00+00:00"), run_id="r", after=ran.append)
    assert ran == ["land", "clean", "build", "test"] and out["tests_passed"] == 16
    assert out["raw_count"] == out["published"] and out["clean_count"] + out["duplicates_removed"] == out["raw_count"]

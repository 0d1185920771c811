"""Composed jobs: the cleaning job (D4/D5 with one action), the model build (K2) and the
end-to-end run (K1). Plain functions over DataFrames, callable from any scheduler.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tardy.functions import scalars as S
from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.operators import quality as Q
from tardy.session import pin_utc, scratch_path
from tardy.sources import liveboard as L
from tardy.sources import messages as P
from tardy.sources import parquet as IO
from tardy.sources import versions

READY_COLUMNS = ["station_id", "station_name", "destination", "destination_id", "scheduled_time",
                 "delay_seconds", "canceled", "vehicle_id", "vehicle_type", "platform", "occupancy",
                 "ingested_at"]


def run_clean_job(spark: SparkSession, raw_path: str, processed_root: str, processed_at=None) -> dict:
    """Read raw, clean, write and publish processed, with both counts observed on the one write."""
    pin_utc(spark)
    seen, kept = Observation("raw"), Observation("clean")
    raw = IO.scan_raw(spark, raw_path).observe(seen, F.count(F.lit(1)).alias("n"))
    clean = C.clean_departures(raw, processed_at).observe(kept, F.count(F.lit(1)).alias("n"))
    IO.publish_processed(spark, clean, processed_root)
    raw_count, clean_count = seen.get["n"], kept.get["n"]
    return {"raw_count": raw_count, "clean_count": clean_count, "duplicates_removed": raw_count - clean_count}


def _dates(df: DataFrame) -> list[str]:
    """The dates of a frame as text: one value per calendar day."""
    return sorted(str(r[0]) for r in df.select("departure_date").distinct().collect() if r[0] is not None)


def _on(df: DataFrame, dates: list[str]) -> DataFrame:
    """The rows of some dates; the filter reaches the scan and prunes its folders."""
    return df.filter(F.col("departure_date").isin([dt.date.fromisoformat(d) for d in dates]))


def merge_clean(spark: SparkSession, ready: DataFrame, processed_root: str, processed_at=None) -> list[str]:
    """Merge parsed, filtered rows into the processed data; returns the dates they touch.

    ``departure_date`` is a function of the dedup key (it is the date of ``scheduled_time``), so
    every copy of a departure lives in one date partition. The rows are deduplicated together with
    the stored rows of only the dates they touch, and a new version is published in which only
    those dates have new folders. The rule that picks a row is total, so merging the same
    rows again, in any order or number of parts, gives the same result as cleaning them at once.
    """
    pin_utc(spark)
    dates = _dates(ready.select(S.departure_date("scheduled_time").alias("departure_date")))
    merged, touched = ready.select(*READY_COLUMNS), dates
    if _exists(spark, processed_root):
        existing = IO.scan_processed(spark, processed_root)
        if versions.versions(spark, processed_root):
            existing = _on(existing, dates)
        else:
            touched = None                     # plain files become the first version, all dates of them
        merged = merged.unionByName(existing.select(*READY_COLUMNS))
    IO.publish_processed(spark, C.finish(merged, processed_at), processed_root, touched)
    return dates


def run_incremental_clean(spark: SparkSession, new_raw_path: str, processed_root: str,
                          processed_at=None) -> dict:
    """Clean only what a new raw batch touches, with the same result as a full re-clean."""
    ready = C.filter_required(C.filter_ready(IO.scan_raw(spark, new_raw_path)))
    dates = merge_clean(spark, ready, processed_root, processed_at)
    stored = _on(IO.scan_processed(spark, processed_root), dates)
    return {"new_rows": ready.count(), "rewritten_rows": stored.count(), "dates_rewritten": len(dates)}


def build_models(spark: SparkSession, processed_root: str, warehouse_root: str) -> dict[str, DataFrame]:
    """K2: stg (view) -> dim_stations, dim_time, fct_delays (tables) -> mart (table), published as one version.

    Each layer is written and re-read before the next one uses it, so the mart is built from
    the stored fact and dimensions (lineage cut, real sizes for the join planner).
    """
    pin_utc(spark)
    stg = M.stg_departures(IO.scan_processed(spark, processed_root))
    build = versions.Build(spark, warehouse_root)
    out = IO.write_models(build, {"stg_departures": stg, "dim_stations": M.dim_stations(stg),
                                  "dim_time": M.dim_time(spark), "fct_delays": M.fct_delays(stg)})
    mart = M.mart_delay_summary(out["fct_delays"], out["dim_stations"], out["dim_time"])
    out |= IO.write_models(build, {"mart_delay_summary": mart})
    build.publish()
    return out


def _by_date_names(stg: DataFrame) -> DataFrame:
    """Per date, the (station_id, station_name) pairs seen: the dimension is their distinct union."""
    return (stg.filter(F.col("station_id").isNotNull())
               .select("departure_date", "station_id", "station_name").distinct())


def refresh_models(spark: SparkSession, processed_root: str, warehouse_root: str,
                   dates: DataFrame | None = None) -> dict[str, DataFrame]:
    """K2, incrementally: refresh the models for the dates in ``dates`` (all dates when None).

    The fact and two small per-date summaries — station/name pairs by date, station x hour
    sums by date — get new folders for the touched dates only. The station dimension is the distinct union of
    the pairs and the mart the merge of the sums, so both equal a full rebuild exactly (a pair or a sum that a
    re-clean removed from a date disappears with that date's folder). Their inputs are
    summaries — dates x stations x 24 rows at most — never the fact. All tables are published as one version.
    """
    pin_utc(spark)
    stg_all = M.stg_departures(IO.scan_processed(spark, processed_root))
    touched = None if dates is None else _dates(dates)
    stg = stg_all if touched is None else _on(stg_all, touched)
    build = versions.Build(spark, warehouse_root)

    def by_date(name: str, df: DataFrame) -> DataFrame:
        return build.write(name, df, by_date=True, touched=touched, order=IO.CLUSTER)

    out = {"stg_departures": stg_all, "fct_delays": by_date("fct_delays", M.fct_delays(stg))}
    names = by_date("_names_by_date", _by_date_names(stg))
    sums = by_date("_sums_by_date", M.hour_sums(stg, "departure_date"))
    out |= IO.write_models(build, {"dim_stations": M.dim_stations(names), "dim_time": M.dim_time(spark)})
    mart = M.mart_from_sums(M.merged_sums(sums), out["dim_stations"], out["dim_time"])
    out |= IO.write_models(build, {"mart_delay_summary": mart})
    for name in ("stg_departures", "fct_delays"):
        out[name].createOrReplaceTempView(name)
    build.publish()
    return out


def land_events(events: DataFrame, raw_path: str, dead_letter_path: str, mode: str = "append") -> dict:
    """Route parsed events: publishable ones land as raw Parquet, the rest as dead letters.

    The documents are parsed and judged once, into one routed table under the shared scratch folder; the
    counts and both sinks are read from it.
    """
    spark = events.sparkSession
    path = scratch_path(spark, f"routed-{uuid.uuid4().hex}")
    P.routed(events).write.parquet(path)
    table = spark.read.parquet(path)
    counts = table.agg(F.count_if(F.col("failure_reason").isNull()).alias("published"),
                       F.count_if(F.col("failure_reason").isNotNull()).alias("failed")).first()
    if counts["published"]:
        IO.write_raw(table.filter(F.col("failure_reason").isNull()).select(*P.EVENT_COLUMNS), raw_path, mode)
    if counts["failed"]:
        dead = table.filter(F.col("failure_reason").isNotNull()).select("value")
        dead.write.mode(mode).json(dead_letter_path)
    return {"departures_fetched": counts["published"] + counts["failed"], **counts.asDict()}


class _Stages:
    """The stages of a run that are done, with their results: one small file each under the run's folder."""

    def __init__(self, spark: SparkSession, workdir: str, run_id: str | None, after: Callable[[str], None] | None):
        self.spark, self.after = spark, after
        self.folder = None if run_id is None else f"{workdir}/_runs/{run_id}"

    def do(self, name: str, stage: Callable[[], dict]) -> dict:
        """The stored result of a stage, or its result after running it."""
        path = None if self.folder is None else f"{self.folder}/{name}.json"
        if path:
            fs, target = _hadoop(self.spark, path)
            if fs.exists(target):
                return json.loads(self.spark.read.option("wholetext", True).text(path).first()[0])
        result = stage()
        if path:
            draft = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
            out = fs.create(draft, True)
            out.write(bytearray(json.dumps(result).encode()))
            out.close()
            fs.rename(draft, target)
        if self.after:
            self.after(name)
        return result


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def run_all(spark: SparkSession, documents: DataFrame, workdir: str, stations: list[str] | None = None,
            ingested_at: Column | None = None, processed_at=None, run_id: str | None = None,
            incremental: bool = False, after: Callable[[str], None] | None = None) -> dict:
    """K1: ingest -> land -> clean -> build -> test. Stops on an empty ingest or a failed test.

    With a ``run_id`` the run lands into ``raw/run_id=<id>`` (and the same for dead letters) with
    overwrite, so a retried run replaces what its failed attempt landed instead of adding it again, and each
    stage that is done is noted under ``_runs/<id>``: a restarted run takes its result from there and goes on at
    the stage that failed.
    With ``incremental=True`` (needs a ``run_id``) only this run's raw folder is cleaned and only
    the dates it touches are rewritten, in the processed data and in the models. ``after`` is called with
    the name of every stage that was run.
    """
    pin_utc(spark)
    if incremental and run_id is None:
        raise ValueError("an incremental run needs a run_id")
    stages = _Stages(spark, workdir, run_id, after)
    raw, dead = f"{workdir}/raw", f"{workdir}/dead_letters"
    processed, warehouse = f"{workdir}/processed", f"{workdir}/warehouse"
    run_raw = raw if run_id is None else f"{raw}/run_id={run_id}"

    def land() -> dict:
        docs = documents if stations is None else documents.filter(F.col("requested_station").isin(list(stations)))
        events = L.liveboard_events(docs, ingested_at)
        if run_id is None:
            done = land_events(events, raw, dead)
        else:
            done = land_events(events, run_raw, f"{dead}/run_id={run_id}", mode="overwrite")
        if done["departures_fetched"] == 0:
            raise ValueError("No departures fetched — the run cannot continue")
        return done

    def clean() -> dict:
        if not incremental:
            return run_clean_job(spark, raw, processed, processed_at)
        if not _exists(spark, processed):
            return run_clean_job(spark, run_raw, processed, processed_at) | {"all_dates": True}
        return run_incremental_clean(spark, run_raw, processed, processed_at)

    def touched() -> DataFrame:
        return (C.filter_required(C.filter_ready(IO.scan_raw(spark, run_raw)))
                 .select(S.departure_date("scheduled_time").alias("departure_date")).distinct())

    landed = stages.do("land", land)
    stats = stages.do("clean", clean)
    part = incremental and not stats.pop("all_dates", False)

    def build() -> dict:
        if incremental:
            refresh_models(spark, processed, warehouse, touched() if part else None)
        else:
            build_models(spark, processed, warehouse)
        return {"version": versions.versions(spark, warehouse)[-1]}

    def test() -> dict:
        models = {n: IO.read_model(spark, warehouse, n) for n in ("dim_stations", "dim_time", "fct_delays", "mart_delay_summary")}
        models["stg_departures"] = M.stg_departures(IO.scan_processed(spark, processed))
        if part:
            # row-level tests only need the touched dates: keys embed the scheduled time, so rows of
            # other dates cannot collide with them, and those dates passed when they were written
            dates = _dates(touched())
            models |= {name: _on(models[name], dates) for name in ("stg_departures", "fct_delays")}
        rows = Q.quality_report(models).collect()          # one row per declared test (16)
        if failed := {r.test_name: r.failures for r in rows if r.failures}:
            raise AssertionError(f"data tests failed: {failed}")
        return {"tests_passed": len(rows)}

    stages.do("build", build)
    return {**landed, **stats, **stages.do("test", test)}


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset, published or plain, exists at ``path`` (lists it and reads one footer, no data)."""
    if versions.versions(spark, path):
        return True
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False

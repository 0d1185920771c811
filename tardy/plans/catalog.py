"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each with its DuckDB oracle.

Every query starts from the driver tables under ``sf_dir`` (via the fixtures) so its work grows
with them. Columns that carry the wall clock (``processed_at``) are left out of query outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.operators import quality as Q
from tardy.operators import reports as R
from tardy.plans import jobs as J
from tardy.functions.scalars import round_tenths_ratio, tenths
from tardy.plans.oracle import (
    ORACLE,
    PEAK_SQL,
    PERIOD_SQL,
    register,
    tenths_mean,
    with_ctes,
    with_keyed,
    with_liveboards,
)
from tardy.sources import fixtures as X
from tardy.sources import liveboard as L
from tardy.sources import messages as P
from tardy.sources import parquet as IO
from tardy.sources import versions
from tardy.schemas import RAW_COLUMNS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            register(name, sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared builders
# ---------------------------------------------------------------------------

def _scratch(spark, tag):
    import uuid

    from tardy.session import scratch_path
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


def raw(spark, sf_dir) -> DataFrame:
    return X.raw_departures(spark, sf_dir)


def cleaned(spark, sf_dir) -> DataFrame:
    return C.clean_departures(raw(spark, sf_dir)).drop("processed_at")


def star(spark, sf_dir) -> M.StarSchema:
    return M.StarSchema(spark, C.clean_departures(raw(spark, sf_dir)))


_WAREHOUSES: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored(spark, sf_dir) -> M.StarSchema:
    """The models as the dashboard finds them: built once per session and table folder by the clean
    job and the model build, written, and read back."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        root = _scratch(spark, "warehouse")
        J.run_clean_job(spark, IO.write_raw(raw(spark, sf_dir), f"{root}/raw"), f"{root}/processed")
        _WAREHOUSES[key] = J.build_models(spark, f"{root}/processed", f"{root}/models")
    return M.StoredModels(_WAREHOUSES[key])


CLEAN_COLS = ("station_id, station_name, destination, destination_id, scheduled_time, delay_seconds, "
              "canceled, vehicle_id, vehicle_type, platform, occupancy, ingested_at, is_delayed, "
              "delay_minutes, departure_hour, departure_date, day_of_week")
STG_COLS = ("departure_key, station_id, station_name, destination, destination_id, scheduled_time, "
            "departure_hour, day_of_week, departure_date, delay_seconds, delay_minutes, is_delayed, "
            "is_canceled, vehicle_id, vehicle_type, platform, occupancy, ingested_at")


# ---------------------------------------------------------------------------
# cleaning (B6-B13, C1, D1, D4, D5)
# ---------------------------------------------------------------------------

@query("clean_departures", with_ctes("clean", f"select {CLEAN_COLS} from clean"))
def q_clean_departures(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query("clean_stats", with_ctes("clean", """
select (select count(*) from raw_departures) as raw_count,
       (select count(*) from clean) as clean_count,
       (select count(*) from raw_departures) - (select count(*) from clean) as duplicates_removed"""))
def q_clean_stats(spark, sf_dir):
    return C.clean_stats(raw(spark, sf_dir))


# ---------------------------------------------------------------------------
# star schema
# ---------------------------------------------------------------------------

@query("stg_departures", with_ctes("stg", f"select {STG_COLS} from stg"))
def q_stg(spark, sf_dir):
    return star(spark, sf_dir).stg.drop("processed_at")


@query("dim_stations", with_ctes("dim_stations", "select * from dim_stations"))
def q_dim_stations(spark, sf_dir):
    return star(spark, sf_dir).dim_stations


@query("fct_delays", with_ctes("fct", "select * from fct"))
def q_fct(spark, sf_dir):
    return star(spark, sf_dir).fct


@query("mart_delay_summary", with_ctes("mart", "select * from mart"))
def q_mart(spark, sf_dir):
    return star(spark, sf_dir).mart


# ---------------------------------------------------------------------------
# per-step keys of the cleaning job
# ---------------------------------------------------------------------------

READY_COLS = ("station_id, station_name, destination, destination_id, scheduled_time, delay_seconds, "
              "canceled, vehicle_id, vehicle_type, platform, occupancy, ingested_at")
KEY3 = "station_id, vehicle_id, scheduled_time"


@query("parse_timestamps", with_ctes("raw_departures", """
select station_id, vehicle_id, scheduled_time as scheduled_text, ingested_at as ingested_text,
       try_cast(scheduled_time as timestamp) as scheduled_time, try_cast(ingested_at as timestamp) as ingested_at
from raw_departures"""))
def q_parse_timestamps(spark, sf_dir):
    r = raw(spark, sf_dir)
    return C.parse_timestamps(r.select("station_id", "vehicle_id",
                                       F.col("scheduled_time").alias("scheduled_text"),
                                       F.col("ingested_at").alias("ingested_text"),
                                       "scheduled_time", "ingested_at"))


@query("fill_defaults", with_ctes("ready", f"select {READY_COLS} from ready"))
def q_fill_defaults(spark, sf_dir):
    return C.filter_ready(raw(spark, sf_dir))


@query("filter_required", with_ctes("ready", f"""
select {READY_COLS} from ready
where station_id is not null and vehicle_id is not null and scheduled_time is not null"""))
def q_filter_required(spark, sf_dir):
    return C.filter_required(C.filter_ready(raw(spark, sf_dir)))


@query("dedup_departures", with_ctes("clean", f"select {READY_COLS} from clean"))
def q_dedup(spark, sf_dir):
    return C.dedup_departures(C.filter_required(C.filter_ready(raw(spark, sf_dir))))


def _derived(name, col, sql_col):
    @query(name, with_ctes("clean", f"select {KEY3}, {sql_col} as {col} from clean"))
    def q(spark, sf_dir):
        return cleaned(spark, sf_dir).select("station_id", "vehicle_id", "scheduled_time", col)
    return q


_derived("derive_is_delayed", "is_delayed", "is_delayed")
_derived("derive_delay_minutes", "delay_minutes", "delay_minutes")
_derived("derive_hour", "departure_hour", "departure_hour")
_derived("derive_date", "departure_date", "departure_date")
_derived("derive_day_of_week", "day_of_week", "day_of_week")


# ---------------------------------------------------------------------------
# staging / dimension scalars (B14, B15, B17-B19, B21), filters (C3, C4), joins
# ---------------------------------------------------------------------------

@query("surrogate_key", with_ctes("stg", "select departure_key, station_id, vehicle_id, scheduled_time from stg"))
def q_surrogate_key(spark, sf_dir):
    return star(spark, sf_dir).stg.select("departure_key", "station_id", "vehicle_id", "scheduled_time")


@query("stage_casts", with_ctes("stg", """
select departure_key, departure_hour, day_of_week, delay_seconds, delay_minutes, is_delayed, is_canceled from stg"""))
def q_stage_casts(spark, sf_dir):
    return star(spark, sf_dir).stg.select("departure_key", "departure_hour", "day_of_week", "delay_seconds",
                                          "delay_minutes", "is_delayed", "is_canceled")


@query("primary_name", with_ctes("stg", """
select departure_key, station_name, split_part(station_name, '/', 1) as station_name_primary from stg"""))
def q_primary_name(spark, sf_dir):
    from tardy.functions.scalars import primary_name
    return star(spark, sf_dir).stg.select("departure_key", "station_name",
                                          primary_name("station_name").alias("station_name_primary"))


@query("peak_flag", with_ctes("fct", f"""
select departure_key, departure_hour, {PEAK_SQL.format(h="departure_hour")} as is_peak_hour from fct"""))
def q_peak_flag(spark, sf_dir):
    from tardy.functions.scalars import peak_flag
    return star(spark, sf_dir).fct.select("departure_key", "departure_hour",
                                          peak_flag("departure_hour").alias("is_peak_hour"))


@query("time_period", with_ctes("fct", f"""
select departure_key, departure_hour, {PERIOD_SQL.format(h="departure_hour")} as time_period from fct"""))
def q_time_period(spark, sf_dir):
    from tardy.functions.scalars import time_period
    return star(spark, sf_dir).fct.select("departure_key", "departure_hour",
                                          time_period("departure_hour").alias("time_period"))


@query("hour_label", with_ctes("mart", """
select station_id, station_name, departure_hour, cast(departure_hour as varchar) || ':00' as hour_label from mart"""))
def q_hour_label(spark, sf_dir):
    from tardy.functions.scalars import hour_label
    return star(spark, sf_dir).mart.select("station_id", "station_name", "departure_hour",
                                           hour_label("departure_hour").alias("hour_label"))


@query("filter_known_station", with_ctes("ready", f"select {READY_COLS} from ready where station_id is not null"))
def q_filter_known_station(spark, sf_dir):
    return C.filter_ready(raw(spark, sf_dir)).filter(F.col("station_id").isNotNull())


@query("filter_delayed", with_ctes("fct", "select * from fct where is_delayed"))
def q_filter_delayed(spark, sf_dir):
    return star(spark, sf_dir).fct.filter(F.col("is_delayed"))


@query("join_fact_station", with_ctes("mart", """
select f.departure_key, f.station_id, s.station_name, s.station_name_primary
from fct f left join dim_stations s on f.station_id = s.station_id"""))
def q_join_fact_station(spark, sf_dir):
    m = star(spark, sf_dir)
    return m.fct.select("departure_key", "station_id").join(m.dim_stations, "station_id", "left") \
        .select("departure_key", "station_id", "station_name", "station_name_primary")


@query("join_fact_time", with_ctes("mart", """
select f.departure_key, f.departure_hour, t.is_peak_hour, t.time_period
from fct f left join dim_time t on f.departure_hour = t.hour_of_day"""))
def q_join_fact_time(spark, sf_dir):
    m = star(spark, sf_dir)
    return (m.fct.select("departure_key", "departure_hour")
             .join(F.broadcast(m.dim_time), F.col("departure_hour") == F.col("hour_of_day"), "left")
             .select("departure_key", "departure_hour", "is_peak_hour", "time_period"))


@query("load_departures", with_ctes("mart", """
select f.*, s.station_name_primary from fct f left join dim_stations s on f.station_id = s.station_id"""))
def q_load_departures(spark, sf_dir):
    m = stored(spark, sf_dir)
    return M.load_departures(m.fct, m.dim_stations)


@query("load_summary", with_ctes("mart", "select * from mart"))
def q_load_summary(spark, sf_dir):
    return stored(spark, sf_dir).mart


# ---------------------------------------------------------------------------
# mart metric parts (F2-F6), per station x hour over the fact
# ---------------------------------------------------------------------------

def _part(name, spark_aggs, sql_aggs):
    @query(name, with_ctes("fct", f"""
select station_id, departure_hour, {sql_aggs} from fct group by station_id, departure_hour"""))
    def q(spark, sf_dir):
        return star(spark, sf_dir).fct.groupBy("station_id", "departure_hour").agg(*spark_aggs())
    return q


_part("agg_total", lambda: [F.count(F.lit(1)).alias("total_departures")], "count(*) as total_departures")
_part("agg_conditional_counts",
      lambda: [F.count_if("is_delayed").alias("delayed_departures"),
               F.count_if("is_canceled").alias("canceled_departures")],
      "cast(sum(case when is_delayed then 1 else 0 end) as bigint) as delayed_departures, "
      "cast(sum(case when is_canceled then 1 else 0 end) as bigint) as canceled_departures")
_part("agg_avg_rounded",
      lambda: [F.round(F.avg("delay_seconds"), 1).alias("avg_delay_seconds"),
               round_tenths_ratio(F.sum(tenths("delay_minutes")), F.count("delay_minutes"))
               .alias("avg_delay_minutes")],
      "round(avg(delay_seconds), 1) as avg_delay_seconds, " + tenths_mean(
          "cast(sum(cast(round(delay_minutes * 10) as bigint)) as bigint)", "count(delay_minutes)")
      + " as avg_delay_minutes")
_part("agg_max", lambda: [F.max("delay_seconds").alias("max_delay_seconds")],
      "max(delay_seconds) as max_delay_seconds")
_part("agg_rate_pct",
      lambda: [F.round(F.count_if("is_delayed") * F.lit(100.0) / F.count(F.lit(1)), 1).alias("delay_rate_pct")],
      "round(sum(case when is_delayed then 1 else 0 end) * 100.0 / count(*), 1) as delay_rate_pct")


# ---------------------------------------------------------------------------
# reports (F7-F14, G1-G4)
# ---------------------------------------------------------------------------

_KPI_MEAN = tenths_mean("b.t", "b.n", half_even=True)
_DEPS = "(select f.*, s.station_name_primary from fct f left join dim_stations s on f.station_id = s.station_id)"


@query("kpi_summary", with_ctes("mart", f"""
select a.total_departures, a.total_delayed,
       case when a.total_departures > 0
            then cast(printf('%.1f', a.total_delayed / a.total_departures * 100) as double)
            else 0.0 end as overall_delay_rate,
       case when b.n > 0 then {_KPI_MEAN} else 0.0 end as avg_delay
from (select cast(coalesce(sum(total_departures), 0) as bigint) as total_departures,
             cast(coalesce(sum(delayed_departures), 0) as bigint) as total_delayed from mart) a,
     (select cast(sum(cast(round(delay_minutes * 10) as bigint)) as bigint) as t, count(delay_minutes) as n
      from {_DEPS} where is_delayed) b"""))
def q_kpi_summary(spark, sf_dir):
    m = stored(spark, sf_dir)
    return R.kpi_summary(m.mart, m.fct, m.dim_stations)


@query("analysis_period", with_ctes("fct", """
select min(departure_date) as min_date, max(departure_date) as max_date,
       count(distinct departure_date) as unique_dates from fct"""))
def q_analysis_period(spark, sf_dir):
    return R.analysis_period(stored(spark, sf_dir).fct)


@query("delay_by_station", with_ctes("mart", """
select *, cast(row_number() over (order by delay_rate asc nulls last, station_name_primary asc) as integer) as rate_rank
from (select station_name_primary, cast(sum(total_departures) as bigint) as total,
             cast(sum(delayed_departures) as bigint) as delayed,
             round(avg(avg_delay_minutes), 6) as avg_delay,
             round_even(sum(delayed_departures) / sum(total_departures) * 100, 1) as delay_rate
      from mart where station_name_primary is not null group by station_name_primary)"""))
def q_delay_by_station(spark, sf_dir):
    return R.delay_by_station(stored(spark, sf_dir).mart)


@query("rank_stations_by_rate", with_ctes("mart", """
select station_name_primary, delay_rate,
       cast(row_number() over (order by delay_rate asc nulls last, station_name_primary asc) as integer) as rate_rank
from (select station_name_primary,
             round_even(sum(delayed_departures) / sum(total_departures) * 100, 1) as delay_rate
      from mart where station_name_primary is not null group by station_name_primary)"""))
def q_rank_stations(spark, sf_dir):
    return R.delay_by_station(stored(spark, sf_dir).mart).select("station_name_primary", "delay_rate", "rate_rank")


@query("delay_by_hour", with_ctes("mart", """
select departure_hour, cast(sum(total_departures) as bigint) as total, cast(sum(delayed_departures) as bigint) as delayed,
       round_even(sum(delayed_departures) / sum(total_departures) * 100, 1) as delay_rate
from mart where departure_hour is not null group by departure_hour"""))
def q_delay_by_hour(spark, sf_dir):
    return R.delay_by_hour(stored(spark, sf_dir).mart)


_PERIOD_RANK = ("case time_period when 'Morning' then 1 when 'Afternoon' then 2 when 'Evening' then 3 "
                "when 'Night' then 4 end")
_OCC_RANK = "case occupancy when 'low' then 1 when 'medium' then 2 when 'high' then 3 when 'unknown' then 4 end"


@query("delay_by_period", with_ctes("mart", f"""
select time_period, cast(sum(total_departures) as bigint) as total, cast(sum(delayed_departures) as bigint) as delayed,
       round(avg(avg_delay_minutes), 6) as avg_delay,
       round_even(sum(delayed_departures) / sum(total_departures) * 100, 1) as delay_rate,
       cast({_PERIOD_RANK} as integer) as sort_rank
from mart where time_period is not null group by time_period"""))
def q_delay_by_period(spark, sf_dir):
    return R.delay_by_period(stored(spark, sf_dir).mart)


@query("order_periods", with_ctes("mart", f"""
select time_period, cast({_PERIOD_RANK} as integer) as sort_rank
from mart where time_period is not null group by time_period"""))
def q_order_periods(spark, sf_dir):
    return R.delay_by_period(stored(spark, sf_dir).mart).select("time_period", "sort_rank")


@query("delay_by_occupancy", with_ctes("mart", f"""
select occupancy, count(departure_key) as total, cast(sum(case when is_delayed then 1 else 0 end) as bigint) as delayed,
       round(avg(delay_minutes), 6) as avg_delay,
       round_even(sum(case when is_delayed then 1 else 0 end) / count(departure_key) * 100, 1) as delay_rate,
       cast({_OCC_RANK} as integer) as sort_rank
from {_DEPS} where occupancy is not null group by occupancy"""))
def q_delay_by_occupancy(spark, sf_dir):
    m = stored(spark, sf_dir)
    return R.delay_by_occupancy(m.fct, m.dim_stations)


@query("order_occupancy", with_ctes("mart", f"""
select occupancy, cast({_OCC_RANK} as integer) as sort_rank from {_DEPS} where occupancy is not null group by occupancy"""))
def q_order_occupancy(spark, sf_dir):
    m = stored(spark, sf_dir)
    return R.delay_by_occupancy(m.fct, m.dim_stations).select("occupancy", "sort_rank")


_HEAT_FILTER = "station_name_primary is not null and departure_hour is not null"


@query("delay_heatmap", with_ctes("mart", "select station_name_primary, " + ", ".join(
    f"coalesce(round(avg(delay_rate_pct) filter (where departure_hour = {h}), 6), 0.0) as h{h:02d}"
    for h in range(24)) + f" from mart where {_HEAT_FILTER} group by station_name_primary"))
def q_delay_heatmap(spark, sf_dir):
    return R.delay_heatmap(stored(spark, sf_dir).mart)


@query("delay_heatmap_long", with_ctes("mart", f"""
select n.station_name_primary, h.departure_hour, cast(h.departure_hour as varchar) || ':00' as hour_label,
       round_even(coalesce(c.v, 0.0), 1) as delay_rate_pct
from (select distinct station_name_primary from mart where {_HEAT_FILTER}) n
cross join (select distinct departure_hour from mart where {_HEAT_FILTER}) h
left join (select station_name_primary, departure_hour, avg(delay_rate_pct) as v from mart
           where {_HEAT_FILTER} group by 1, 2) c
  on c.station_name_primary = n.station_name_primary and c.departure_hour = h.departure_hour"""))
def q_delay_heatmap_long(spark, sf_dir):
    return R.delay_heatmap_long(stored(spark, sf_dir).mart)


@query("station_list", with_ctes("dim_stations", """
select station_id, station_name, station_name_primary,
       cast(row_number() over (order by station_name_primary asc nulls last, station_id asc, station_name asc nulls last)
            as integer) as list_rank
from dim_stations"""))
def q_station_list(spark, sf_dir):
    return R.station_list(stored(spark, sf_dir).dim_stations)


# ---------------------------------------------------------------------------
# data quality (H1-H5, E4); H1-H4 run on dirty input so a pass is not an empty set
# ---------------------------------------------------------------------------

_SQL_MODEL = {"stg_departures": "stg", "dim_stations": "dim_stations", "dim_time": "dim_time",
              "fct_delays": "fct", "mart_delay_summary": "mart"}


def _sql_literal(v):
    if isinstance(v, bool):
        return "true" if v else "false"
    return "'" + str(v).replace("'", "''") + "'"


def _test_sql(t: Q.Test) -> str:
    m, c = _SQL_MODEL[t.model], t.column
    if t.kind == "unique":
        f = f"(select count(*) from (select {c} from {m} where {c} is not null group by {c} having count(*) > 1))"
    elif t.kind == "not_null":
        f = f"(select count(*) from {m} where {c} is null)"
    elif t.kind == "accepted_values":
        vals = ", ".join(_sql_literal(v) for v in t.values)
        f = f"(select count(distinct {c}) from {m} where {c} is not null and {c} not in ({vals}))"
    else:
        p = _SQL_MODEL[t.to]
        f = (f"(select count(*) from {m} x where x.{c} is not null and not exists "
             f"(select 1 from {p} y where y.{t.to_field} = x.{c}))")
    return (f"select '{t.name}' as test_name, '{t.model}' as model, '{c}' as column_name, "
            f"cast({f} as bigint) as failures")


@query("dq_report", with_ctes("mart", "\nunion all\n".join(_test_sql(t) for t in Q.DECLARED_TESTS)))
def q_dq_report(spark, sf_dir):
    return Q.quality_report(stored(spark, sf_dir).models)


@query("dq_unique", with_ctes("raw_departures", """
select departure_key, count(*) as n_records
from (select md5(station_id || '-' || vehicle_id || '-' || scheduled_time) as departure_key from raw_departures)
where departure_key is not null group by departure_key having count(*) > 1"""))
def q_dq_unique(spark, sf_dir):
    from tardy.functions.scalars import surrogate_key
    r = raw(spark, sf_dir).select(surrogate_key("station_id", "vehicle_id", "scheduled_time").alias("departure_key"))
    return Q.dq_unique(r, "departure_key")


@query("dq_not_null", with_ctes("raw_departures", "select * from raw_departures where station_id is null"))
def q_dq_not_null(spark, sf_dir):
    return Q.dq_not_null(raw(spark, sf_dir), "station_id")


_KNOWN_NAMES = ", ".join(_sql_literal(v) for v in X.STATION_NAMES)


@query("dq_accepted_values", with_ctes("raw_departures", f"""
select station_name, count(*) as n_records from raw_departures
where station_name is not null and station_name not in ({_KNOWN_NAMES}) group by station_name"""))
def q_dq_accepted_values(spark, sf_dir):
    return Q.dq_accepted_values(raw(spark, sf_dir), "station_name", X.STATION_NAMES)


@query("dq_relationships", with_ctes("mart", """
select f.* from fct f where f.destination_id is not null
and not exists (select 1 from dim_stations s where s.station_id = f.destination_id)"""))
def q_dq_relationships(spark, sf_dir):
    m = star(spark, sf_dir)
    return Q.dq_relationships(m.fct, "destination_id", m.dim_stations, "station_id")


# ---------------------------------------------------------------------------
# ingest: liveboard documents -> events -> messages / dead letters
# ---------------------------------------------------------------------------

EV11 = ["station_id", "station_name", "destination", "destination_id", "scheduled_time", "delay_seconds",
        "canceled", "vehicle_id", "vehicle_type", "platform", "occupancy"]
EV11_SQL = ", ".join(EV11)
_OK = "parse_error is null"
_PUBLISHABLE = "coalesce(station_id, '') <> '' and coalesce(vehicle_id, '') <> ''"


def lb_events(spark, sf_dir) -> DataFrame:
    return L.liveboard_events(X.liveboard_documents(spark, sf_dir))


@query("flatten_liveboards", with_liveboards(f"select doc_id, pos, {EV11_SQL} from lb_events where {_OK}"))
def q_flatten(spark, sf_dir):
    return lb_events(spark, sf_dir).filter(F.col("parse_error").isNull()).select("doc_id", "pos", *EV11)


_SOME_STATIONS = ["Brussels-South", "Brussels-Central", "Antwerpen-Centraal"]


@query("multi_station_ingest", with_liveboards(f"""
select {EV11_SQL} from lb_events where {_OK}
and requested_station in ('Brussels-South', 'Brussels-Central', 'Antwerpen-Centraal')"""))
def q_multi_station(spark, sf_dir):
    return L.multi_station_ingest(X.liveboard_documents(spark, sf_dir), _SOME_STATIONS).select(*EV11)


@query("epoch_to_iso", with_liveboards("select doc_id, pos, scheduled_time from lb_events"))
def q_epoch_to_iso(spark, sf_dir):
    return lb_events(spark, sf_dir).select("doc_id", "pos", "scheduled_time")


@query("parse_int_default", with_liveboards(f"select doc_id, pos, delay_seconds from lb_events where {_OK}"))
def q_parse_int_default(spark, sf_dir):
    return lb_events(spark, sf_dir).filter(F.col("parse_error").isNull()).select("doc_id", "pos", "delay_seconds")


@query("decode_flag", with_liveboards("select doc_id, pos, canceled from lb_events"))
def q_decode_flag(spark, sf_dir):
    return lb_events(spark, sf_dir).select("doc_id", "pos", "canceled")


_NESTED = ["station_id", "station_name", "destination", "destination_id", "vehicle_id", "vehicle_type",
           "platform", "occupancy"]


@query("nested_default", with_liveboards(f"select doc_id, pos, {', '.join(_NESTED)} from lb_events"))
def q_nested_default(spark, sf_dir):
    return lb_events(spark, sf_dir).select("doc_id", "pos", *_NESTED)


@query("filter_publishable", with_liveboards(f"select {EV11_SQL} from lb_events where {_OK} and {_PUBLISHABLE}"))
def q_filter_publishable(spark, sf_dir):
    ev = lb_events(spark, sf_dir)
    return ev.filter(F.col("parse_error").isNull() & P.publishable()).select(*EV11)


@query("publish_valid", with_liveboards(f"""
select station_id as key, {EV11_SQL} from lb_events where {_OK} and {_PUBLISHABLE}"""))
def q_publish_valid(spark, sf_dir):
    msgs = P.to_messages(lb_events(spark, sf_dir))
    return msgs.select("key", P.parse_message(F.col("value")).alias("m")).select("key", *[f"m.{c}" for c in EV11])


@query("dead_letter", with_liveboards(f"""
select coalesce(parse_error, 'Missing required fields') as failure_reason, {EV11_SQL}, cast(dep as varchar) as original_text
from lb_events where not ({_OK} and {_PUBLISHABLE})"""))
def q_dead_letter(spark, sf_dir):
    from tardy.schemas import DEAD_LETTER_SCHEMA
    dl = P.to_dead_letters(lb_events(spark, sf_dir))
    m = F.from_json(F.col("value"), DEAD_LETTER_SCHEMA)
    return dl.select(m.alias("m")).select("m.failure_reason", *[f"m.original_message.{c}" for c in EV11],
                                          "m.original_text")


@query("publish_counts", with_liveboards(f"""
select count(*) filter (where {_OK} and {_PUBLISHABLE}) as published,
       count(*) filter (where not ({_OK} and {_PUBLISHABLE})) as failed from lb_events"""))
def q_publish_counts(spark, sf_dir):
    return P.publish_counts(lb_events(spark, sf_dir))


@query("json_round_trip", with_liveboards(f"select {EV11_SQL} from lb_events where {_OK}"))
def q_json_round_trip(spark, sf_dir):
    ev = L.flatten_liveboards(X.liveboard_documents(spark, sf_dir))
    back = ev.select(P.parse_message(P.event_json()).alias("m"))
    return back.select(*[f"m.{c}" for c in EV11])


@query("distinct_station_count", with_liveboards(f"""
select count(distinct station_name) as station_count from lb_events where {_OK}"""))
def q_distinct_station_count(spark, sf_dir):
    return L.distinct_station_count(L.flatten_liveboards(X.liveboard_documents(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Parquet sources and sinks (A1-A4): written under the shared checkpoint folder, read back
# ---------------------------------------------------------------------------

RAW_SQL_COLS = ("station_id, station_name, destination, destination_id, scheduled_time, delay_seconds, canceled, "
                "vehicle_id, vehicle_type, platform, occupancy, ingested_at")


@query("write_raw", with_ctes("raw_departures", f"select {RAW_SQL_COLS} from raw_departures"))
def q_write_raw(spark, sf_dir):
    path = IO.write_raw(raw(spark, sf_dir), _scratch(spark, "raw"))
    return spark.read.parquet(path)


@query("scan_raw", with_ctes("raw_departures", """
select station_id, station_name, destination, destination_id, scheduled_time, cast(delay_seconds as bigint) as delay_seconds,
       canceled, vehicle_id, vehicle_type, platform, occupancy, ingested_at from raw_departures"""))
def q_scan_raw(spark, sf_dir):
    path = IO.write_raw(raw(spark, sf_dir), _scratch(spark, "raw"))
    return IO.scan_raw(spark, path)


def _processed(spark, sf_dir):
    root = _scratch(spark, "processed")
    path = IO.write_raw(raw(spark, sf_dir), f"{root}/raw")
    J.run_clean_job(spark, path, f"{root}/processed")
    return IO.scan_processed(spark, f"{root}/processed")


@query("scan_processed", with_ctes("clean", f"select {CLEAN_COLS} from clean"))
def q_scan_processed(spark, sf_dir):
    return _processed(spark, sf_dir).drop("processed_at")


@query("write_processed", with_ctes("clean", """
select departure_date, count(*) as n_rows, count(distinct station_id) as n_stations from clean group by departure_date"""))
def q_write_processed(spark, sf_dir):
    return _processed(spark, sf_dir).groupBy("departure_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("station_id").alias("n_stations"))


# ---------------------------------------------------------------------------
# published tables (A5), the model build (K2) and the whole run (K1)
# ---------------------------------------------------------------------------

@query("materialize", with_ctes("mart", "select * from mart").replace(
    "from events", "from (select * from events where event_id % 2 = 0)"))
def q_materialize(spark, sf_dir):
    # half of the events are published; a build over all of them writes its tables and is never published
    ev = X.events(spark, sf_dir)
    root = _scratch(spark, "published")
    half = M.StarSchema(spark, C.clean_departures(X.raw_departures_from_events(ev.filter(F.col("event_id") % 2 == 0))))
    IO.materialize(half.tables(), root, spark)
    killed = versions.Build(spark, root)
    IO.write_models(killed, star(spark, sf_dir).tables())
    return IO.read_model(spark, root, "mart_delay_summary")


@query("build_models", with_ctes("mart", """
select 'stg_departures' as model, count(*) as n_rows from stg
union all select 'dim_stations', count(*) from dim_stations
union all select 'dim_time', count(*) from dim_time
union all select 'fct_delays', count(*) from fct
union all select 'mart_delay_summary', count(*) from mart"""))
def q_build_models(spark, sf_dir):
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("model"), "n_rows")
             for name, df in stored(spark, sf_dir).models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("run_pipeline", with_liveboards(f"""
select count(*) as departures_fetched, count(*) filter (where {_OK} and {_PUBLISHABLE}) as published,
       count(*) filter (where not ({_OK} and {_PUBLISHABLE})) as failed,
       count(*) filter (where {_OK} and {_PUBLISHABLE}) as raw_count,
       count(distinct (station_id, vehicle_id, scheduled_time)) filter (where {_OK} and {_PUBLISHABLE}) as clean_count,
       count(*) filter (where {_OK} and {_PUBLISHABLE})
         - count(distinct (station_id, vehicle_id, scheduled_time)) filter (where {_OK} and {_PUBLISHABLE}) as duplicates_removed,
       cast({len(Q.DECLARED_TESTS)} as bigint) as tests_passed
from lb_events"""))
def q_run_pipeline(spark, sf_dir):
    # the run ends after cleaning and is started again: it goes on with the build
    root, docs = _scratch(spark, "run"), X.liveboard_documents(spark, sf_dir)

    def stop(stage):
        if stage == "clean":
            raise InterruptedError(stage)

    for after in (stop, None):
        try:
            out = J.run_all(spark, docs, root, ingested_at=F.lit("2024-02-01T00:00:00+00:00"), run_id="r", after=after)
        except InterruptedError:
            continue
    keys = ["departures_fetched", "published", "failed", "raw_count", "clean_count", "duplicates_removed", "tests_passed"]
    return spark.createDataFrame([tuple(int(out[k]) for k in keys)], ", ".join(f"{k} long" for k in keys))


# ---------------------------------------------------------------------------
# streaming replays of the fixture
# ---------------------------------------------------------------------------

@query("stream_validate_route", with_ctes("raw_departures", f"""
select {RAW_SQL_COLS} from raw_departures where coalesce(station_id, '') <> '' and coalesce(vehicle_id, '') <> ''"""))
def q_stream_route(spark, sf_dir):
    from tardy.streaming.replay import replay_landing
    landed, _ = replay_landing(spark, raw(spark, sf_dir))
    return landed


@query("stream_dead_letters", with_ctes("raw_departures", """
select 'Missing required fields' as failure_reason, count(*) as n_messages from raw_departures
where not (coalesce(station_id, '') <> '' and coalesce(vehicle_id, '') <> '')"""))
def q_stream_dead(spark, sf_dir):
    from pyspark.sql.types import StringType, StructField, StructType

    from tardy.streaming.replay import replay_landing
    _, dead = replay_landing(spark, raw(spark, sf_dir))
    reason = F.from_json("value", StructType([StructField("failure_reason", StringType())]))
    return dead.select(reason["failure_reason"].alias("failure_reason")) \
        .groupBy("failure_reason").agg(F.count(F.lit(1)).alias("n_messages"))


@query("stream_dedup", with_ctes("clean", f"select {CLEAN_COLS} from clean"))
def q_stream_dedup(spark, sf_dir):
    from tardy.streaming.replay import replay_clean
    return replay_clean(spark, raw(spark, sf_dir)).drop("processed_at")


@query("stream_mart", with_ctes("mart", "select * from mart"))
def q_stream_mart(spark, sf_dir):
    from tardy.streaming.replay import replay_mart
    return replay_mart(spark, raw(spark, sf_dir))


@query("stream_mart_final", with_ctes("mart", "select * from mart"))
def q_stream_mart_final(spark, sf_dir):
    # every message delivered twice, in any order: the mart is the same
    from tardy.streaming.replay import replay_mart
    return replay_mart(spark, raw(spark, sf_dir), twice=True)


LATE_DAYS = 5


@query("stream_late", with_keyed("ready", f"""
select station_id, vehicle_id, strftime(scheduled_time, '%Y-%m-%dT%H:%M:%S+00:00') as scheduled_time,
       strftime(ingested_at, '%Y-%m-%dT%H:%M:%S+00:00') as ingested_at, 'Late' as failure_reason
from ready
where event_id % 2 = 1 and station_id is not null and vehicle_id is not null and scheduled_time is not null
  and cast(cast(scheduled_time as date) + {LATE_DAYS + 1} as timestamp) <= (
    select max(ingested_at) from ready
    where event_id % 2 = 0 and station_id is not null and vehicle_id is not null and scheduled_time is not null)"""))
def q_stream_late(spark, sf_dir):
    # events with even ids are delivered first; the odd ones' days that have closed by then are late
    from tardy.streaming.replay import replay_late
    keyed = X.raw_departures(spark, sf_dir, keyed=True)
    even, odd = (keyed.filter(F.col("event_id") % 2 == k).select(*RAW_COLUMNS) for k in (0, 1))
    letters = replay_late(spark, even, odd, LATE_DAYS)
    m = F.from_json("value", "original_message struct<station_id: string, vehicle_id: string, scheduled_time: string, "
                             "ingested_at: string>, failure_reason string")
    return letters.select(m.alias("m")).select("m.original_message.*", "m.failure_reason")


@query("stream_consume", with_keyed("raw_departures", f"""
select cast(event_id % 4 as integer) as "partition", 2 * (event_id // 4) + n as "offset", station_id as key,
       case when not ({_PUBLISHABLE}) then 'Missing required fields' end as failure_reason, {RAW_SQL_COLS}
from raw_departures"""))
def q_stream_consume(spark, sf_dir):
    from tardy.streaming.replay import replay_consume
    return replay_consume(spark, X.raw_departures(spark, sf_dir, keyed=True))


_ARRIVAL_SQL = (f"{X.ARRIVAL_START_MS} + event_id // 1000 * 600000 + event_id % 1000 * "
                f"[{', '.join(map(str, X.ARRIVAL_STEPS))}][event_id // 1000 % {len(X.ARRIVAL_STEPS)} + 1] + n * 50")


@query("stream_dual_trigger", with_keyed("raw_departures", f"""
select part as "partition", mine as flush_no, count(*) as messages, min(place) as first_offset, max(place) as last_offset
from (select part, place, unnest([mine]) as mine from walk) group by part, mine""", extra=[f"""placed as (
  select cast(event_id % 4 as integer) as part, 2 * (event_id // 4) + n as place, {_ARRIVAL_SQL} as at_ms from raw_departures
),
seq as (select *, row_number() over (partition by part order by place) as i from placed),
walk(part, i, place, mine, number, held, flushed) as (
  select part, i, place, cast(0 as bigint), cast(0 as bigint), cast(1 as bigint), cast(at_ms as bigint) from seq where i = 1
  union all
  select s.part, s.i, s.place, w.number + timed, w.number + timed + if(if(timed = 1, 0, w.held) + 1 = 100, 1, 0),
         if(if(timed = 1, 0, w.held) + 1 = 100, 0, if(timed = 1, 0, w.held) + 1),
         cast(if(timed = 1 or if(timed = 1, 0, w.held) + 1 = 100, s.at_ms, w.flushed) as bigint)
  from walk w join seq s on s.part = w.part and s.i = w.i + 1,
       lateral (select if(w.held > 0 and s.at_ms - w.flushed >= 60000, 1, 0) as timed) t
)"""]).replace("with ", "with recursive ", 1))
def q_stream_dual_trigger(spark, sf_dir):
    from tardy.streaming.replay import replay_flushes
    return replay_flushes(spark, X.raw_departures(spark, sf_dir, keyed=True))


def _json_text(column: str) -> str:
    return f"""coalesce('"' || {column} || '"', 'null')"""


@query("drop_malformed", with_keyed("raw_departures", f"""
select 'Malformed JSON' as failure_reason,
       substr('{{"station_id":' || {_json_text("station_id")} || ',"station_name":' || {_json_text("station_name")}, 1, 30) as text
from raw_departures where event_id % 29 = 7"""))
def q_drop_malformed(spark, sf_dir):
    from tardy.streaming.replay import replay_malformed
    return replay_malformed(spark, X.raw_departures(spark, sf_dir, keyed=True))


@query("stream_drain", with_ctes("raw_departures", f"""
select 'raw' as sink, count(*) filter (where {_PUBLISHABLE}) as rows from raw_departures
union all select 'dead_letters', count(*) filter (where not ({_PUBLISHABLE})) from raw_departures"""))
def q_stream_drain(spark, sf_dir):
    from tardy.streaming.replay import replay_drain
    return replay_drain(spark, raw(spark, sf_dir))


@query("stream_resume", with_ctes("raw_departures", f"select {RAW_SQL_COLS} from raw_departures where {_PUBLISHABLE}"))
def q_stream_resume(spark, sf_dir):
    from tardy.streaming.replay import replay_resume
    return replay_resume(spark, raw(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}


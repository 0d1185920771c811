"""Reports: fan-out semantics, rounding modes, orderings; every registered query vs DuckDB."""

import pytest
from pyspark.sql import functions as F

from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.operators import reports as R
from tardy.operators.ordering import with_position
from tardy.sources import fixtures as X

from conftest import SF_SMALL
from rows import raw_df


def _star(spark, *overrides):
    return M.StarSchema(spark, C.clean_departures(raw_df(spark, *overrides)))


def test_mart_fans_out_over_names(spark):
    s = _star(spark, {"delay_seconds": 90}, {"station_name": "Alpha/Alfa", "vehicle_id": "V2"},
              {"vehicle_id": "V3", "canceled": True, "scheduled_time": "2026-05-12T08:00:00+00:00"})
    joined = s.fct.join(s.dim_stations, "station_id").groupBy("station_id", "station_name", "departure_hour").count()
    a = sorted(tuple(r) for r in s.mart.select("station_id", "station_name", "departure_hour", "total_departures").collect())
    assert a == sorted(tuple(r) for r in joined.collect()) and len(a) == 4


def test_occupancy_and_kpi_weight_by_fan_out(spark):
    s = _star(spark, {"delay_seconds": 120}, {"station_name": "Alpha/Alfa", "vehicle_id": "V2",
                                              "delay_seconds": 60, "occupancy": "high"})
    deps = M.load_departures(s.fct, s.dim_stations)       # 2 fact rows x 2 names = 4 rows
    assert deps.count() == 4
    occ = {r["occupancy"]: (r["total"], r["delayed"], r["avg_delay"]) for r in
           R.delay_by_occupancy(s.fct, s.dim_stations).collect()}
    assert occ == {"low": (2, 2, 2.0), "high": (2, 2, 1.0)}
    k = R.kpi_summary(s.mart, s.fct, s.dim_stations).first()
    assert (k["total_departures"], k["total_delayed"], k["overall_delay_rate"], k["avg_delay"]) == (4, 4, 100.0, 1.5)


def test_kpi_on_empty_input_is_zero(spark):
    s = _star(spark, {"station_id": None})
    k = R.kpi_summary(s.mart, s.fct, s.dim_stations).first()
    assert (k["total_departures"], k["total_delayed"], k["overall_delay_rate"], k["avg_delay"]) == (0, 0, 0.0, 0.0)


def test_report_rate_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 8)], "d long, t long")      # 12.5 is already one decimal: unchanged
    assert df.select(R._rate("d", "t").alias("r")).first()["r"] == 12.5
    df = spark.createDataFrame([(1, 16)], "d long, t long")     # 6.25 is an exact tie -> 6.2 (to even)
    assert df.select(R._rate("d", "t").alias("r")).first()["r"] == 6.2


def test_period_and_occupancy_order(spark):
    s = M.StarSchema(spark, C.clean_departures(
        __import__("tardy.sources.fixtures", fromlist=["x"]).raw_departures(spark, SF_SMALL)))
    per = {r["time_period"]: r["sort_rank"] for r in R.delay_by_period(s.mart).collect()}
    assert per == {"Morning": 1, "Afternoon": 2, "Evening": 3, "Night": 4}
    occ = {r["occupancy"]: r["sort_rank"] for r in R.delay_by_occupancy(s.fct, s.dim_stations).collect()}
    assert occ == {"low": 1, "medium": 2, "high": 3, "unknown": 4}


def test_unknown_category_ranks_null(spark):
    s = _star(spark, {"occupancy": "packed"})
    r = R.delay_by_occupancy(s.fct, s.dim_stations).first()
    assert r["occupancy"] == "packed" and r["sort_rank"] is None


def test_heatmap_long_grid_covers_present_hours_only(spark):
    s = _star(spark, {}, {"station_name": "Gent", "station_id": "S2", "vehicle_id": "V2",
                          "scheduled_time": "2026-05-12T08:00:00+00:00", "delay_seconds": 60})
    rows = R.delay_heatmap_long(s.mart).collect()
    grid = {(r["station_name_primary"], r["departure_hour"]): r["delay_rate_pct"] for r in rows}
    assert grid == {("Alpha", 15): 0.0, ("Alpha", 8): 0.0, ("Gent", 15): 0.0, ("Gent", 8): 100.0}
    wide = R.delay_heatmap(s.mart).collect()
    assert len(wide) == 2 and len(wide[0]) == 25


@pytest.mark.parametrize("slice_rows", [100, 10_000])
@pytest.mark.parametrize("spread", [700, 100_000])
def test_position_is_exact_across_slices(spark, slice_rows, spread):
    # with the wide spread all rows share the first key of the order
    df = spark.range(0, 2000, 1, 7).select((F.col("id") * 7919 % 2000).alias("k")).withColumn(
        "c", F.when(F.col("k") < 1900, (F.col("k") / spread).cast("int")))        # the last hundred have none
    ranked = with_position(df, [F.col("c").asc_nulls_last(), F.col("k").asc()], "pos", slice_rows)
    assert ranked.columns == ["k", "c", "pos"]
    assert sorted((r["k"], r["pos"]) for r in ranked.collect()) == [(i, i + 1) for i in range(2000)]


def test_no_slice_holds_a_hot_first_key(spark):
    df = spark.range(0, 5000, 1, 4).select(F.lit("same").alias("c"), F.col("id").alias("k"))
    ranked = with_position(df, ["c", "k"], "pos", slice_rows=500)
    sizes = spark.read.parquet(ranked.inputFiles()[0].rsplit("/", 1)[0]).groupBy("_slice").count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 1500


def test_every_registered_query_matches_duckdb(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as E
    from tardy.plans import catalog
    from tools.oracle_check import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sqls = catalog.queries(), E.oracle_sql()
    assert set(qs) <= set(E.queries()) and set(sqls) <= set(E.queries())
    bad = []
    cartesian = []
    for k, fn in qs.items():
        df = fn(spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            cartesian.append(k)
        srows, scols = [tuple(r) for r in df.collect()], df.columns
        if k not in sqls:
            continue
        rel = con.execute(sqls[k])
        dcols = [d[0] for d in rel.description]
        drows = rel.fetchall()
        if sorted(scols) != sorted(dcols) or rows_of(srows, scols) != rows_of(drows, dcols):
            bad.append(k)
    assert bad == []
    assert cartesian == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 100
    assert "delay_rate_pct" in df.columns


def test_tenths_mean_is_exact_on_ties(spark):
    from tardy.functions.scalars import round_tenths_ratio
    df = spark.createDataFrame([(116, 8), (-116, 8), (125, 10), (135, 10), (7, 3), (5, 0)], "t long, n long")
    up = [r[0] for r in df.select(round_tenths_ratio("t", "n")).collect()]
    even = [r[0] for r in df.select(round_tenths_ratio("t", "n", half_even=True)).collect()]
    assert up == [1.5, -1.5, 1.3, 1.4, 0.2, None]      # 1.45 -> 1.5, 1.25 -> 1.3, 1.35 -> 1.4
    assert even == [1.4, -1.4, 1.2, 1.4, 0.2, None]    # half to even


def test_time_dimension_peak_is_not_period(spark):
    rows = {r["hour_of_day"]: (r["is_peak_hour"], r["time_period"]) for r in M.dim_time(spark).collect()}
    assert len(rows) == 24
    assert rows[16] == (True, "Afternoon") and rows[17] == (True, "Evening")
    assert rows[10] == (False, "Morning") and rows[7] == (True, "Morning")
    assert {h for h, (_, p) in rows.items() if p == "Night"} == {21, 22, 23, 0, 1, 2, 3, 4, 5}
    assert {h for h, (pk, _) in rows.items() if pk} == {7, 8, 9, 16, 17, 18}


def test_null_keys_are_dropped_by_reports(spark):
    s = _star(spark, {}, {"vehicle_id": "V2"})
    mart = s.mart.union(s.mart.limit(1).withColumn("station_name_primary", F.lit(None).cast("string"))
                        .withColumn("time_period", F.lit(None).cast("string")))
    assert R.delay_by_station(mart).count() == 1
    assert R.delay_by_period(mart).count() == 1
    assert R.delay_heatmap(mart).count() == 1


def test_rounding_like_numpy_and_like_python(spark):
    import numpy as np

    from tardy.functions.scalars import round_like_numpy, round_like_python
    vals = [0.35, 0.15, 0.05, 66.65, 12.25, 1234.55, 2.675]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select(round_like_numpy("x", 1).alias("n"), round_like_python("x", 1).alias("p")).collect()
    assert [r.n for r in rows] == [float(v) for v in np.round(np.array(vals), 1)]
    assert [r.p for r in rows] == [round(v, 1) for v in vals]
    assert rows[0].n == 0.4 and rows[0].p == 0.3          # the two libraries disagree on 0.35


def test_mart_keeps_null_names_and_names_of_other_hours(spark):
    s = _star(spark, {"station_name": None},
              {"station_name": "Alpha/Alfa", "vehicle_id": "V2", "scheduled_time": "2026-05-12T09:00:00+00:00"},
              {"station_id": "A2", "station_name": "Beta", "vehicle_id": "V3"},
              {"station_id": "A2", "station_name": "Beta/Bèta", "vehicle_id": "V4",
               "scheduled_time": "2026-05-12T20:00:00+00:00", "delay_seconds": 45})
    pairs = {(r["station_id"], r["station_name"], r["departure_hour"]) for r in s.mart.collect()}
    assert len(pairs) == s.mart.count() == 8      # every (station, name) pair at every hour the station has


def test_merged_sums_give_the_same_mart(spark):
    s = M.StarSchema(spark, C.clean_departures(X.raw_departures(spark, SF_SMALL)))
    by_date = M.hour_sums(s.fct, "departure_date")
    merged = M.mart_from_sums(M.merged_sums(by_date), s.dim_stations, s.dim_time)
    assert merged.exceptAll(s.mart).isEmpty() and s.mart.exceptAll(merged).isEmpty()

"""Reporting queries over the mart and the fact.

Rounding: the mart rounds half away from zero (``round``). Report columns round like the
dashboard's dataframe library (numpy: scale, ``rint``, unscale — bit-identical); the KPI rate,
computed on plain floats there, rounds like Python's built-in ``round`` (exact binary value, ties
to even). Means of means are exposed rounded to 6 decimals so addition order cannot show.

Reports that read "departures" (the fact left-joined to the station dimension) are computed
without shuffling the fact: the fact is first aggregated per (station_id, report key) — partial
aggregation on every map task — and the join only brings each station's dimension multiplicity
(how many dimension rows the left join would produce for it, at least 1). Counts and sums are
then weighted by that multiplicity, which is exactly what the row-level join would have summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.functions import scalars as S
from tardy.operators.ordering import with_position
from tardy.schemas import OCCUPANCY_ORDER, PERIOD_ORDER

HOURS = list(range(24))


def _rate(delayed, total):
    """round(delayed / total * 100, 1) as the dataframe library rounds a column (numpy)."""
    return S.round_like_numpy(S.ratio_pct(delayed, total), 1)


def station_multiplicity(stations: DataFrame) -> DataFrame:
    """Rows per station_id in the dimension (a station seen under two names counts 2)."""
    return stations.groupBy("station_id").agg(F.count(F.lit(1)).alias("_m"))


def _weighted(fct_agg: DataFrame, stations: DataFrame) -> DataFrame:
    """Attach the left-join multiplicity (>= 1) to a per-station pre-aggregate."""
    return (fct_agg.join(station_multiplicity(stations), "station_id", "left")
                   .withColumn("_m", F.coalesce(F.col("_m"), F.lit(1)).cast("long")))


def kpi_summary(mart: DataFrame, fct: DataFrame, stations: DataFrame) -> DataFrame:
    """total, delayed, overall rate (0 when empty), mean delay of delayed rows (0 when none).

    One global aggregate over a union of the mart's counts and the weighted delayed-minute sums:
    each input contributes partial aggregates, the final step sees one row per task.
    """
    delayed = (fct.filter(F.col("is_delayed"))
                  .groupBy("station_id")
                  .agg(F.sum(S.tenths("delay_minutes")).alias("_s"), F.count("delay_minutes").alias("_c")))
    delayed = _weighted(delayed, stations)
    parts = (mart.select(F.col("total_departures").cast("long").alias("t"),
                         F.col("delayed_departures").cast("long").alias("d"),
                         F.lit(None).cast("long").alias("s"), F.lit(None).cast("long").alias("c"))
             .unionByName(delayed.select(F.lit(None).cast("long").alias("t"), F.lit(None).cast("long").alias("d"),
                                         (F.col("_s") * F.col("_m")).alias("s"),
                                         (F.col("_c") * F.col("_m")).alias("c"))))
    g = parts.agg(F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("total_departures"),
                  F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("total_delayed"),
                  F.sum("s").alias("_s"), F.sum("c").alias("_c"))
    return g.select(
        "total_departures", "total_delayed",
        F.when(F.col("total_departures") > 0,
               S.round_like_python(S.ratio_pct("total_delayed", "total_departures"), 1))
         .otherwise(F.lit(0.0)).alias("overall_delay_rate"),
        F.when(F.col("_c") > 0, S.round_tenths_ratio("_s", "_c", half_even=True))
         .otherwise(F.lit(0.0)).alias("avg_delay"),
    )


def analysis_period(fct: DataFrame) -> DataFrame:
    """F8: first date, last date, number of distinct dates (a left join cannot change them)."""
    return fct.agg(F.min("departure_date").alias("min_date"),
                   F.max("departure_date").alias("max_date"),
                   F.count_distinct("departure_date").alias("unique_dates"))


def delay_by_station(mart: DataFrame) -> DataFrame:
    """F9 + G2: totals, mean of the mart's rounded means, rate; ranked ascending by rate."""
    g = (mart.filter(F.col("station_name_primary").isNotNull())
             .groupBy("station_name_primary")
             .agg(F.sum("total_departures").alias("total"),
                  F.sum("delayed_departures").alias("delayed"),
                  F.round(F.avg("avg_delay_minutes"), 6).alias("avg_delay")))
    g = g.withColumn("delay_rate", _rate("delayed", "total"))
    return with_position(g, [F.col("delay_rate").asc_nulls_last(), F.col("station_name_primary").asc()], "rate_rank")


def delay_by_hour(mart: DataFrame) -> DataFrame:
    """F10."""
    g = (mart.filter(F.col("departure_hour").isNotNull())
             .groupBy("departure_hour")
             .agg(F.sum("total_departures").alias("total"), F.sum("delayed_departures").alias("delayed")))
    return g.withColumn("delay_rate", _rate("delayed", "total"))


def delay_by_period(mart: DataFrame) -> DataFrame:
    """F11 + G3: by time period, with the fixed period order exposed as ``sort_rank``."""
    g = (mart.filter(F.col("time_period").isNotNull())
             .groupBy("time_period")
             .agg(F.sum("total_departures").alias("total"),
                  F.sum("delayed_departures").alias("delayed"),
                  F.round(F.avg("avg_delay_minutes"), 6).alias("avg_delay")))
    return (g.withColumn("delay_rate", _rate("delayed", "total"))
             .withColumn("sort_rank", S.category_rank("time_period", PERIOD_ORDER)))


def delay_by_occupancy(fct: DataFrame, stations: DataFrame) -> DataFrame:
    """F12 + G4: per occupancy over the departures (fact left-join stations), fixed order rank.

    count(departure_key) counts non-null keys; the mean is over non-null delay minutes.
    """
    pre = (fct.filter(F.col("occupancy").isNotNull())
              .groupBy("station_id", "occupancy")
              .agg(F.count("departure_key").alias("_k"),
                   F.count_if(F.col("is_delayed")).alias("_d"),
                   F.sum("delay_minutes").alias("_s"),
                   F.count("delay_minutes").alias("_c")))
    w = _weighted(pre, stations)
    g = w.groupBy("occupancy").agg(
        F.sum(F.col("_k") * F.col("_m")).alias("total"),
        F.sum(F.col("_d") * F.col("_m")).alias("delayed"),
        F.sum(F.col("_s") * F.col("_m")).alias("_s"),
        F.sum(F.col("_c") * F.col("_m")).alias("_c"))
    return g.select(
        "occupancy", "total", "delayed",
        F.round(F.try_divide(F.col("_s"), F.col("_c")), 6).alias("avg_delay"),
        _rate("delayed", "total").alias("delay_rate"),
        S.category_rank("occupancy", OCCUPANCY_ORDER).alias("sort_rank"))


def _heat_long_cells(mart: DataFrame) -> DataFrame:
    """Mean delay_rate_pct per (primary name, hour) present in the mart (long form)."""
    return (mart.filter(F.col("station_name_primary").isNotNull() & F.col("departure_hour").isNotNull())
                .groupBy("station_name_primary", "departure_hour")
                .agg(F.avg("delay_rate_pct").alias("v")))


def _heat_cells(mart: DataFrame, long_cells: DataFrame | None = None) -> DataFrame:
    """The same cells as a 24-column pivot (null = no data)."""
    cells = long_cells if long_cells is not None else _heat_long_cells(mart)
    p = cells.groupBy("station_name_primary").pivot("departure_hour", HOURS).agg(F.first("v"))
    return p.select("station_name_primary", *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def delay_heatmap(mart: DataFrame) -> DataFrame:
    """wide heatmap, one row per primary station name, ``h00``..``h23``, missing cells 0."""
    cells = _heat_cells(mart)
    return cells.select("station_name_primary",
                        *[F.coalesce(F.round(F.col(f"h{h:02d}"), 6), F.lit(0.0)).alias(f"h{h:02d}")
                          for h in HOURS])


def delay_heatmap_long(mart: DataFrame) -> DataFrame:
    """the heatmap grid in long form over stations x hours present in the data.

    The grid comes from unpivoting the wide rows (a generator on each row), and the set of
    present hours (at most 24 rows) is an equi-join on the hour — no cartesian product.
    """
    long_cells = _heat_long_cells(mart)
    cells = _heat_cells(mart, long_cells)
    long = cells.select("station_name_primary", F.explode(F.array(*[
        F.struct(F.lit(h).alias("departure_hour"), F.col(f"h{h:02d}").alias("v")) for h in HOURS
    ])).alias("cell")).select("station_name_primary", "cell.departure_hour", "cell.v")
    present = long_cells.select("departure_hour").distinct()
    out = long.join(F.broadcast(present), "departure_hour", "inner")
    return out.select("station_name_primary", "departure_hour",
                      S.hour_label("departure_hour").alias("hour_label"),
                      S.round_like_numpy(F.coalesce(F.col("v"), F.lit(0.0)), 1).alias("delay_rate_pct"))


def station_list(stations: DataFrame) -> DataFrame:
    """G1: id, name, primary name, ordered by primary name (id, name break ties)."""
    listed = stations.select("station_id", "station_name", "station_name_primary")
    return with_position(listed, [F.col("station_name_primary").asc_nulls_last(), F.col("station_id").asc(),
                                  F.col("station_name").asc_nulls_last()], "list_rank")

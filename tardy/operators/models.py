"""Star schema: staging, station and time dimensions, delay fact, station x hour mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.functions import scalars as S

STG_COLUMNS = ["departure_key", "station_id", "station_name", "destination", "destination_id",
               "scheduled_time", "departure_hour", "day_of_week", "departure_date", "delay_seconds",
               "delay_minutes", "is_delayed", "is_canceled", "vehicle_id", "vehicle_type", "platform",
               "occupancy", "ingested_at", "processed_at"]

FCT_COLUMNS = ["departure_key", "station_id", "destination_id", "vehicle_id", "departure_date",
               "departure_hour", "day_of_week", "delay_seconds", "delay_minutes", "is_delayed",
               "is_canceled", "vehicle_type", "platform", "occupancy", "scheduled_time", "ingested_at"]

MART_KEYS = ["station_id", "station_name", "station_name_primary", "departure_hour",
             "is_peak_hour", "time_period"]


def stg_departures(clean: DataFrame) -> DataFrame:
    """Keyed, typed staging projection (19 columns)."""
    cols = {
        "departure_key": S.surrogate_key("station_id", "vehicle_id", "scheduled_time"),
        "departure_hour": F.col("departure_hour").cast("int"),
        "day_of_week": F.col("day_of_week").cast("int"),
        "delay_seconds": F.col("delay_seconds").cast("int"),
        "delay_minutes": F.col("delay_minutes").cast("double"),
        "is_delayed": F.col("is_delayed").cast("boolean"),
        "is_canceled": F.col("canceled").cast("boolean"),
    }
    return clean.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in STG_COLUMNS])


def dim_stations(stg: DataFrame) -> DataFrame:
    """D2 + C3 + B17: one row per distinct (station_id, station_name).

    A hash aggregate with map-side combine: the shuffle carries at most one row per distinct
    pair per task, whatever the fact size.
    """
    return (stg.filter(F.col("station_id").isNotNull())
               .select("station_id", "station_name").distinct()
               .withColumn("station_name_primary", S.primary_name("station_name")))


def dim_time(spark: SparkSession) -> DataFrame:
    """A13 + B18 + B19: the 24 hours of a day (a fixed, proven-tiny table)."""
    h = F.col("id").cast("int")
    return spark.range(0, 24, 1, numPartitions=1).select(
        h.alias("hour_of_day"),
        S.peak_flag(h).alias("is_peak_hour"),
        S.time_period(h).alias("time_period"))


def fct_delays(stg: DataFrame) -> DataFrame:
    """The 16-column fact projection."""
    return stg.select(*FCT_COLUMNS)


def hour_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Mergeable sums per (keys, station_id, departure_hour), aggregated before any join.

    Partial aggregation runs on every map task, so the exchange carries stations x 24 rows per
    task however large the fact is, and a hot station costs nothing extra.
    """
    return rows.groupBy(*keys, "station_id", "departure_hour").agg(
        F.count(F.lit(1)).alias("total_departures"),
        F.count_if(F.col("is_delayed")).alias("delayed_departures"),
        F.count_if(F.col("is_canceled")).alias("canceled_departures"),
        F.sum("delay_seconds").alias("_ss"), F.count("delay_seconds").alias("_ns"),
        F.sum(S.tenths("delay_minutes")).alias("_tm"), F.count("delay_minutes").alias("_nm"),
        F.max("delay_seconds").alias("max_delay_seconds"),
    )


def merged_sums(parts: DataFrame) -> DataFrame:
    """The sums of several parts (for example of dates) merged per station and hour."""
    added = ("total_departures", "delayed_departures", "canceled_departures", "_ss", "_ns", "_tm", "_nm")
    return parts.groupBy("station_id", "departure_hour").agg(
        *[F.sum(c).alias(c) for c in added], F.max("max_delay_seconds").alias("max_delay_seconds"))


def mart_delay_summary(fct: DataFrame, stations: DataFrame, hours: DataFrame) -> DataFrame:
    """F1-F6 (+E1, E2): delay metrics per station x hour.

    Same result as joining the fact to both dimensions and grouping by the six keys: the group
    keys include the dimension columns, so every group is one (station_id, hour) of the fact
    paired with one dimension row. A station listed under two names still yields two groups
    with the full counts each (the fan-out the uniqueness test reports).

    Aggregating first shrinks the join inputs to stations x 24 rows; AQE then sees tiny sides and
    broadcasts them at runtime. The time dimension is 24 rows by construction and is hinted.
    """
    return mart_from_sums(hour_sums(fct), stations, hours)


def mart_from_sums(sums: DataFrame, stations: DataFrame, hours: DataFrame) -> DataFrame:
    """The mart from ``hour_sums`` or ``merged_sums``.

    ``avg_delay_minutes`` is the exact mean of the one-decimal minutes rounded half away from
    zero (integer tenths), so a true x.x5 tie rounds the same way on every run.
    """
    j = (sums.join(stations, "station_id", "left")
             .join(F.broadcast(hours), F.col("departure_hour") == F.col("hour_of_day"), "left"))
    return j.select(
        *MART_KEYS,
        "total_departures", "delayed_departures", "canceled_departures",
        F.round(F.col("_ss") / F.col("_ns"), 1).alias("avg_delay_seconds"),
        S.round_tenths_ratio("_tm", "_nm").alias("avg_delay_minutes"),
        "max_delay_seconds",
        F.round(S.pct("delayed_departures", "total_departures"), 1).alias("delay_rate_pct"),
    )


def load_departures(fct: DataFrame, stations: DataFrame) -> DataFrame:
    """Fact.* plus the station's primary name (left join; fan-out kept)."""
    return fct.join(stations.select("station_id", "station_name_primary"), "station_id", "left") \
              .select(*FCT_COLUMNS, "station_name_primary")


class StarSchema:
    """All models from one cleaned frame (K2 order: stg -> dims -> fact -> mart)."""

    def __init__(self, spark: SparkSession, clean: DataFrame):
        self.stg = stg_departures(clean)
        self.dim_stations = dim_stations(self.stg)
        self.dim_time = dim_time(spark)
        self.fct = fct_delays(self.stg)
        self.mart = mart_delay_summary(self.fct, self.dim_stations, self.dim_time)

    def tables(self) -> dict:
        return {"stg_departures": self.stg, "dim_stations": self.dim_stations,
                "dim_time": self.dim_time, "fct_delays": self.fct,
                "mart_delay_summary": self.mart}


class StoredModels:
    """The same models read from the tables a build has written."""

    def __init__(self, models: dict[str, DataFrame]):
        self.models = models
        self.stg, self.fct, self.mart = (models[n] for n in ("stg_departures", "fct_delays", "mart_delay_summary"))
        self.dim_stations, self.dim_time = models["dim_stations"], models["dim_time"]

"""Parquet sources and sinks.

Paths are any Hadoop URI (``file:/``, ``hdfs://``, ``abfss://container@account.dfs.core.windows.net/dir``),
so copying landed files into a lake is just writing to a lake path (A11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.schemas import (
    LAKE_CONTAINER,
    LAKE_DIRECTORY,
    LANDED_SCHEMA,
    PROCESSED_SCHEMA,
    RAW_COLUMNS,
    RAW_SCHEMA,
)
from tardy.sources import versions

PARTITION_COLUMN = "departure_date"
CLUSTER = ("station_id", "departure_hour")     # order of rows inside files, for row-group pruning
PROCESSED = "departures"                        # the processed table's name among a root's published tables
# Files stay well under a block even when one date holds most rows (a hot day is split by
# AQE's rebalance and by this cap, never written by one task as one file).
MAX_RECORDS_PER_FILE = 5_000_000


def lake_path(account: str, container: str = LAKE_CONTAINER, directory: str = LAKE_DIRECTORY) -> str:
    """The lake location of landed raw files."""
    return f"abfss://{container}@{account}.dfs.core.windows.net/{directory}"


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """A1: raw departures under the fixed 12-column schema (no inference pass).

    An INT delay written by the landing step reads cleanly as BIGINT under this schema.
    """
    return spark.read.schema(RAW_SCHEMA).parquet(path).select(*RAW_COLUMNS)


def conform_landed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDED_SCHEMA.fields])


def write_raw(df: DataFrame, path: str, mode: str = "append") -> str | None:
    """A2: append departures with enforced column types; empty input writes nothing -> None.

    The write goes through a ``rebalance``: AQE cuts an oversized input partition (e.g. the
    departures exploded from one very large document, which one task must parse) into several
    write tasks and merges small ones, so landed files are evenly sized.
    """
    out = conform_landed(df)
    if out.isEmpty():
        return None
    out.hint("rebalance").write.mode(mode).parquet(path)
    return path


def write_processed(df: DataFrame, root: str, max_records_per_file: int = MAX_RECORDS_PER_FILE,
                    partition_overwrite: str = "static") -> None:
    """A4: overwrite, snappy, partitioned by departure_date, clustered by station and hour.

    ``rebalance`` on the partition column lets AQE cut a large date into several tasks (and
    merge small ones) instead of one task per date; the sort inside each task clusters rows by
    station and hour for the readers' row-group min/max pruning. ``partition_overwrite="dynamic"``
    replaces only the dates present in ``df`` (incremental runs); "static" replaces everything.
    """
    (df.hint("rebalance", PARTITION_COLUMN)
       .sortWithinPartitions(PARTITION_COLUMN, "station_id", "departure_hour")
       .write.mode("overwrite")
       .option("compression", "snappy")
       .option("maxRecordsPerFile", max_records_per_file)
       .option("partitionOverwriteMode", partition_overwrite)
       .partitionBy(PARTITION_COLUMN)
       .parquet(root))


def scan_processed(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """A3: all processed partitions, columns united by name, departure_date recovered as DATE.

    A root with published versions gives its newest one. Otherwise its files are read
    under the fixed processed schema: files are united by column name (a
    column an older file lacks reads as null) and no footer is opened to infer anything, which
    matters with hundreds of thousands of files; columns beyond that schema are left out.
    ``merge_schema=True`` instead unites whatever
    columns the files carry (reads every footer). Filters on departure_date become partition
    filters (only matching folders are listed and read).
    """
    if versions.versions(spark, root):
        return versions.read(spark, root, PROCESSED)
    if merge_schema:
        return spark.read.option("mergeSchema", "true").parquet(root)
    return spark.read.schema(PROCESSED_SCHEMA).parquet(root)


def publish_processed(spark: SparkSession, df: DataFrame, root: str, touched: list[str] | None = None) -> int:
    """A4, published: the cleaned departures as the next version of ``root``.

    With ``touched`` dates only those are replaced. Readers see the version before or all of this one.
    """
    build = versions.Build(spark, root)
    build.write(PROCESSED, df, by_date=True, touched=touched, order=CLUSTER, max_records=MAX_RECORDS_PER_FILE)
    return build.publish()


def materialize(models: dict[str, DataFrame], root: str, spark: SparkSession,
                views: tuple[str, ...] = ("stg_departures",)) -> dict[str, DataFrame]:
    """A5: staging as a temp view, the other models written as Parquet tables, published together and re-read.

    Re-reading the written tables cuts the lineage (a lost executor recomputes from the table,
    not from the raw files) and gives the planner real file sizes, so small dimensions are
    broadcast by the size check built into the planner and large ones are not.
    """
    build = versions.Build(spark, root)
    out = write_models(build, models, views)
    build.publish()
    return out


def write_models(build: versions.Build, models: dict[str, DataFrame],
                 views: tuple[str, ...] = ("stg_departures",)) -> dict[str, DataFrame]:
    """The writing part of ``materialize``: tables of a build that is not published yet."""
    out = {}
    for name, df in models.items():
        out[name] = df if name in views else build.write(name, df, by_date=name == "fct_delays", order=CLUSTER)
        out[name].createOrReplaceTempView(name)
    return out


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest published build."""
    return versions.read(spark, root, name)

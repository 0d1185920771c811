"""Session helpers: builder defaults, UTC pinning and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"

# Defaults for a large cluster (applied only where spark-submit / the cluster set nothing):
# start shuffles wide and let AQE coalesce to ~256 MB partitions, so a 100 TB dedup shuffle does
# not spill from oversized partitions and small stages do not run thousands of empty tasks.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app_name: str = "tardy",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every job here assumes.

    On a cluster ``master`` stays None so spark-submit decides; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.sources.partitionOverwriteMode": "static",
        # reliable checkpoints written by a query are removed once its frames are garbage
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if not master or not master.startswith("local"):
        from pyspark import SparkConf

        submitted = SparkConf()          # what spark-submit / spark-defaults already set
        conf.update({k: v for k, v in CLUSTER_DEFAULTS.items() if not submitted.contains(k)})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """hour/to_date/date_format and ISO parsing depend on the session zone; pin UTC.

    Expressions bind the zone when a DataFrame is analysed, so calling this before
    building a plan is enough even if the conf changes later.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one on shared storage; only a local master (tests, bench) gets a
    fresh scratch folder of its own when the setting is missing.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
    root = tempfile.mkdtemp(prefix="tardy-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint root for written intermediate tables / stream state.

    All scratch of one application lies under one folder, which ``clear_scratch`` removes.
    """
    return f"{checkpoint_root(spark)}/scratch-{spark.sparkContext.applicationId}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table this application has written.

    Frames that were read back from them are unusable afterwards: call it when results are stored.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

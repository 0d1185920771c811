"""Streaming deduplication (J5) and the running station x hour mart (J6) over keyed state.

Two queries share a root. The *gate* judges lateness: it writes the rows of each micro-batch to
``arrived/batch_id=<n>`` and, in its ledger, the watermark (the latest ``ingested_at``) after the batch. A row is
late if its day has been closed for ``horizon_days`` by the watermark before its batch; late rows go to the dead
letters with their reason and no further. The *fold* aggregates the arrived rows by departure in the state store
(RocksDB): a micro-batch reads and writes the states of the departures that it holds and nothing else, and a
departure's state is dropped when the gate's watermark closes its day, so state is bounded. The rule that
picks a copy is total (the batch job's order), so the result does not depend on how messages are batched or
repeated.

What a fold changes is written as rows of two kinds: ``in`` (a copy that is now the best) and ``out`` (the
copy it replaces, which the state knows by the gate's batch numbers). The mart is kept as counts per (station,
name, hour, delay, canceled): each fold appends its changes (+1 for ``in``, -1 for ``out``) and the
mart is aggregated from the sums, which also gives a maximum that can fall. Every batch writes folders
named by its number, with overwrite, so a replayed batch replaces its own rows; no stored departure is ever
read back.

A running gate folds after every batch, a draining one once at its end; either way a fold sees whole batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tardy.functions import scalars as S
from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.schemas import DEDUP_KEY
from tardy.sources import messages as P
from tardy.streaming import landing as SL

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK_KEY = "spark.watermarkDelayMs"     # marks the time column of a stream (fixed value)
REASON_LATE = "Late"
HORIZON_DAYS = 2

COPY_COLUMNS = C.DEDUP_ORDER                 # a copy without its key, in the order that decides
COLUMNS = [*DEDUP_KEY, *COPY_COLUMNS]
_COUNT_KEYS = ["station_id", "station_name", "departure_hour", "delay_seconds", "canceled"]


def ready_events(events: DataFrame) -> DataFrame:
    """Parse, fill and filter, as the batch job does before it deduplicates."""
    return C.filter_required(C.filter_ready(events))


def _schema(spark: SparkSession, *more: str):
    ready = C.filter_ready(spark.createDataFrame([], C.RAW_SCHEMA)).select(*COLUMNS)
    for column in more:
        ready = ready.withColumn(column.split()[0], F.lit(None).cast(column.split()[1]))
    return ready.schema


def _ledger(root: str, query: str, batch_id: int) -> str:
    return f"{root}/_{query}/{batch_id:012d}.json"


def _entry(spark: SparkSession, root: str, query: str, batch_id: int) -> dict | None:
    return SL.read_entry(spark, _ledger(root, query, batch_id))


# ---------------------------------------------------------------------------
# the gate: lateness
# ---------------------------------------------------------------------------

def _gate_batch(root: str, horizon_days: int, fold_each: bool, with_mart: bool):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _entry(spark, root, "gate", batch_id) is None:          # else written by a run that ended before its commit
            clock = (_entry(spark, root, "gate", batch_id - 1) or {"clock_us": 0})["clock_us"]
            closes = F.date_add(F.to_date("scheduled_time"), 1 + horizon_days).cast("timestamp")
            arrived = F.unix_micros(F.col("ingested_at").cast("timestamp"))
            seen = Observation()
            rows = ready_events(batch).select(
                *COLUMNS, closes.alias("closes"), F.timestamp_micros(F.lit(clock)).alias("clock"),
                (F.unix_micros(closes) <= clock).alias("late"))
            rows = rows.observe(seen, F.max(arrived).alias("us"))
            folder = f"{root}/arrived/batch_id={batch_id}"
            rows.write.mode("overwrite").partitionBy("late").parquet(folder)
            if SL.exists(spark, f"{folder}/late=true"):
                late = spark.read.schema(_schema(spark)).parquet(f"{folder}/late=true")
                _dead_letters(late).write.mode("overwrite").text(f"{root}/dead_letters/batch_id={batch_id}")
            SL.write_entry(spark, _ledger(root, "gate", batch_id), {"clock_us": max(clock, seen.get["us"] or 0)})
        if fold_each:
            SL.finish(_fold(spark, root, with_mart))

    return run


def _dead_letters(late: DataFrame) -> DataFrame:
    event = [S.iso_utc_micros(F.col(c).cast("timestamp")).alias(c) if c in ("scheduled_time", "ingested_at") else F.col(c)
             for c in P.EVENT_COLUMNS]
    letter = F.struct(F.struct(*event).alias("original_message"), F.lit(REASON_LATE).alias("failure_reason"))
    return late.select(F.to_json(letter, {"ignoreNullFields": "false"}).alias("value"))


# ---------------------------------------------------------------------------
# the fold: keyed state
# ---------------------------------------------------------------------------

def changes(arrived: DataFrame) -> DataFrame:
    """The stream of departures that have new copies: key and all distinct copies with their batches."""
    clocked = arrived.withWatermark("clock", "0 seconds")
    # state is dropped by this time column: the end of the departure's horizon, which the gate's clock passes.
    # No arrived row is ever older than the clock, as the gate has left out those that were.
    closes = F.col("closes").alias("closes", metadata={WATERMARK_KEY: 0})
    rows = clocked.select(closes, *COLUMNS, "batch_id")
    return rows.groupBy("closes", *DEDUP_KEY).agg(F.collect_set(F.struct(*COPY_COLUMNS, "batch_id")).alias("copies"))


def _best(copies: Column) -> Column:
    """The copy that the total rule picks; null where there is none."""
    return F.array_max(F.transform(copies, lambda c: F.struct(*[c[n].alias(n) for n in COPY_COLUMNS])))


def _fold_batch(root: str, with_mart: bool):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = (_entry(spark, root, "fold", batch_id - 1) or {"through": -1})["through"]
        seen = Observation()
        last = F.array_max(F.transform("copies", lambda c: c["batch_id"]))
        rows = batch.observe(seen, F.max(last).alias("through")).select(
            *DEDUP_KEY, _best(F.col("copies")).alias("new"),
            _best(F.filter("copies", lambda c: c["batch_id"] <= before)).alias("old"))
        rows = rows.filter(F.col("old").isNull() | (F.col("old") < F.col("new")))
        kinds = F.array(F.struct(F.lit("in").alias("kind"), F.col("new").alias("copy")),
                        F.struct(F.lit("out").alias("kind"), F.col("old").alias("copy")))
        moved = rows.select(*DEDUP_KEY, F.explode(F.filter(kinds, lambda k: k["copy"].isNotNull())).alias("k"))
        folder = f"{root}/changes/batch_id={batch_id}"
        # one write evaluates the batch once; what follows reads the written rows of this batch only
        moved.select(*DEDUP_KEY, "k.copy.*", "k.kind").write.mode("overwrite").partitionBy("kind").parquet(folder)
        if with_mart:
            counted = C.derive(spark.read.schema(_schema(spark, "kind string")).parquet(folder))
            sign = F.when(F.col("kind") == "in", 1).otherwise(-1)
            counted.groupBy(*_COUNT_KEYS).agg(F.sum(sign).alias("n")).filter("n <> 0") \
                .write.mode("overwrite").parquet(f"{root}/counts/batch_id={batch_id}")
        through = seen.get["through"]
        SL.write_entry(spark, _ledger(root, "fold", batch_id), {"through": before if through is None else max(before, through)})

    return run


def _fold(spark: SparkSession, root: str, with_mart: bool) -> StreamingQuery:
    # read when the query starts; what the clock has closed is dropped by the next batch that has rows
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    schema = _schema(spark, "closes timestamp", "clock timestamp", "batch_id long", "late boolean")
    arrived = spark.readStream.schema(schema).parquet(f"{root}/arrived").filter("not late")
    return (changes(arrived).writeStream.outputMode("update").foreachBatch(_fold_batch(root, with_mart))
            .option("checkpointLocation", f"{root}/checkpoint-fold").trigger(availableNow=True).start())


# ---------------------------------------------------------------------------
# running and reading
# ---------------------------------------------------------------------------

def _gate(events: DataFrame, root: str, horizon_days: int, fold_each: bool, with_mart: bool):
    return (events.writeStream.foreachBatch(_gate_batch(root, horizon_days, fold_each, with_mart))
            .option("checkpointLocation", f"{root}/checkpoint-gate"))


def start_stream(events: DataFrame, root: str, seconds: int = 60, horizon_days: int = HORIZON_DAYS,
                 with_mart: bool = True) -> StreamingQuery:
    """J5 and, ``with_mart``, J6 over a stream of raw events: results under ``root`` are current after every batch."""
    return _gate(events, root, horizon_days, True, with_mart).trigger(processingTime=f"{seconds} seconds").start()


def drain_stream(events: DataFrame, root: str, horizon_days: int = HORIZON_DAYS, with_mart: bool = True) -> None:
    """The same over what is there now; returns when it is folded."""
    SL.finish(_gate(events, root, horizon_days, False, with_mart).trigger(availableNow=True).start())
    if SL.exists(events.sparkSession, f"{root}/arrived"):
        SL.finish(_fold(events.sparkSession, root, with_mart))


def read_departures(spark: SparkSession, root: str, processed_at=None) -> DataFrame:
    """The departures as the batch job would clean them: the best copy of each key among the ``in`` rows.

    A copy is only ever replaced by a better one, so the batch numbers are not needed.
    """
    rows = spark.read.schema(_schema(spark, "kind string")).parquet(f"{root}/changes")
    return C.finish(rows.filter("kind = 'in'").select(*COLUMNS), processed_at)


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """The copies that came too late, as dead letters (value)."""
    if not SL.exists(spark, f"{root}/dead_letters"):
        return spark.createDataFrame([], "value string")
    return spark.read.text(f"{root}/dead_letters").select("value")


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    """The mart over all departures received so far."""
    hist = spark.read.parquet(f"{root}/counts").groupBy(*_COUNT_KEYS).agg(F.sum("n").alias("n")).filter("n > 0")
    tenths = S.tenths(S.delay_minutes("delay_seconds"))
    sums = hist.groupBy("station_id", "departure_hour").agg(
        F.sum("n").alias("total_departures"),
        F.sum(F.when(S.is_delayed("delay_seconds"), F.col("n")).otherwise(0)).alias("delayed_departures"),
        F.sum(F.when(F.col("canceled"), F.col("n")).otherwise(0)).alias("canceled_departures"),
        F.sum(F.col("delay_seconds") * F.col("n")).alias("_ss"), F.sum("n").alias("_ns"),
        F.sum(tenths * F.col("n")).alias("_tm"), F.sum("n").alias("_nm"),
        F.max(F.col("delay_seconds").cast("int")).alias("max_delay_seconds"))
    return M.mart_from_sums(sums, M.dim_stations(hist), M.dim_time(spark))

"""Replay a batch of events through the streaming path (for checks against the batch path).

The events are written as JSON-lines message files under the shared checkpoint folder (never a
machine-local temp folder on a cluster), consumed with ``availableNow`` in several micro-batches,
and the stored result is read back as a table. Each replay uses a fresh sub-folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.session import scratch_path
from tardy.sources import fixtures as X
from tardy.sources import messages as P
from tardy.streaming import flushing as FL
from tardy.streaming import landing as SL
from tardy.streaming import messagelog as ML
from tardy.streaming import stateful as ST

BATCHES = 8


def write_message_files(events: DataFrame, folder: str, files: int | None = None, mode: str = "overwrite") -> int:
    """Events -> JSON text messages (nulls kept), dealt round-robin over ``files`` files.

    By default one file per core of the cluster and at least one per micro-batch, so writing and
    reading them is as wide as the cluster. Returns the number of files.
    """
    files = files or max(BATCHES, events.sparkSession.sparkContext.defaultParallelism)
    text = events.select(F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))
    text.repartition(files).write.mode(mode).text(folder)
    return files


def _workdir(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, f"replay-{tag}-{uuid.uuid4().hex[:12]}")


def received(spark: SparkSession, folder: str, files_per_trigger: int) -> DataFrame:
    """The events of a message folder as a stream. Only messages that are no JSON are left out here:
    cleaning has its own rule for missing fields."""
    policy = SL.FlushPolicy(files_per_trigger=files_per_trigger)
    msgs = SL.parse_messages(SL.read_messages(spark, folder, policy=policy))
    return msgs.filter(F.coalesce(F.col("failure_reason") != SL.REASON_MALFORMED_JSON, F.lit(True))).select(*P.EVENT_COLUMNS)


def replay_landing(spark: SparkSession, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Land ``events`` through two queries with checkpoints of their own into one root, in several
    micro-batches each; returns (landed raw rows, dead-letter values)."""
    root = _workdir(spark, "landing")
    half = F.pmod(F.xxhash64(*events.columns), F.lit(2)) == 0
    for name, part in (("a", events.filter(half)), ("b", events.filter(~half))):
        files = write_message_files(part, f"{root}/in-{name}")
        SL.drain(spark, f"{root}/in-{name}", f"{root}/raw", f"{root}/dead", f"{root}/ck-{name}",
                 policy=SL.FlushPolicy(files_per_trigger=-(-files // 4)))
    return SL.read_landed(spark, f"{root}/raw"), spark.read.text(f"{root}/dead")


# The fixture's messages span a month and are replayed in any order: no departure is late.
REPLAY_HORIZON_DAYS = 400


def replay_clean(spark: SparkSession, events: DataFrame, batches: int = BATCHES) -> DataFrame:
    """J5 over ``events`` in ``batches`` micro-batches; the deduplicated departures."""
    root = _workdir(spark, "clean")
    files = write_message_files(events, f"{root}/in")
    ST.drain_stream(received(spark, f"{root}/in", max(1, files // batches)), root, REPLAY_HORIZON_DAYS, with_mart=False)
    return ST.read_departures(spark, root)


def replay_mart(spark: SparkSession, events: DataFrame, batches: int = BATCHES, twice: bool = False) -> DataFrame:
    """J6 over ``events`` in ``batches`` micro-batches; ``twice`` delivers every message again, as
    an at-least-once source may."""
    root = _workdir(spark, "mart")
    files = write_message_files(events, f"{root}/in")
    if twice:
        files += write_message_files(events, f"{root}/in", mode="append")
    ST.drain_stream(received(spark, f"{root}/in", max(1, files // batches)), root, REPLAY_HORIZON_DAYS)
    return ST.read_mart(spark, root)


def replay_late(spark: SparkSession, first: DataFrame, then: DataFrame, horizon_days: int) -> DataFrame:
    """J5 over two deliveries, one micro-batch each: the dead letters of the late departures."""
    root = _workdir(spark, "late")
    for part in (first, then):
        write_message_files(part, f"{root}/in", mode="append")
        ST.drain_stream(received(spark, f"{root}/in", 10_000), root, horizon_days, with_mart=False)
    return ST.read_late(spark, root)


def log_messages(events: DataFrame) -> DataFrame:
    """Fixture events (with ``event_id`` and copy number ``n``) as messages of a log with four partitions."""
    value = F.to_json(F.struct(*P.EVENT_COLUMNS), {"ignoreNullFields": "false"})
    return events.select(F.expr("cast(event_id % 4 as int)").alias("partition"),
                         F.expr("2 * (event_id div 4) + n").alias("offset"), F.col("station_id").alias("key"),
                         value.alias("value"), F.timestamp_millis(X.arrival_ms()).alias("timestamp"))


def _kept(spark: SparkSession, frame: DataFrame, root: str, mode: str = "append") -> None:
    """Drain a stream into folders by batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    SL.finish(frame.writeStream.outputMode(mode).foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
              .trigger(availableNow=True).start())


SEGMENTS = 64                  # of a partition of the replayed log, while a segment is not too long for one task


def _span(messages: DataFrame) -> int:
    """Offsets of a segment, so that the number of segments does not grow with the messages until segments have
    as many offsets as a task reads."""
    last = messages.agg(F.max("offset")).first()[0]
    return min(ML.TASK_OFFSETS, max(ML.SEGMENT_SPAN, -(-((last or 0) + 1) // SEGMENTS)))


def _in_two_parts(spark: SparkSession, events: DataFrame, tag: str, frame, mode: str = "append") -> DataFrame:
    """Append the first segments of the messages to a log, drain it, append the rest and drain again."""
    root = _workdir(spark, tag)
    messages = log_messages(events)
    span = _span(messages)
    for half in (messages.filter(F.col("offset") < span), messages.filter(F.col("offset") >= span)):
        ML.append_messages(half, f"{root}/log", span)
        _kept(spark, frame(ML.consume(spark, f"{root}/log")), root, mode)
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def replay_consume(spark: SparkSession, events: DataFrame) -> DataFrame:
    """A10: every message of the log once, at its place, parsed and judged."""
    def parsed(messages: DataFrame) -> DataFrame:
        judged = SL.parse_messages(messages.select("value", F.struct("partition", "offset", "key").alias("place")), ["place"])
        return judged.select("place.*", "failure_reason", *P.EVENT_COLUMNS)

    return _in_two_parts(spark, events, "consume", parsed)


def replay_flushes(spark: SparkSession, events: DataFrame) -> DataFrame:
    """One row per flush: partition, flush_no, messages, first and last offset."""
    numbered = _in_two_parts(spark, events, "flush", FL.flush_numbers, "update")
    return numbered.groupBy("partition", "flush_no").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def truncated(events: DataFrame) -> DataFrame:
    """Messages (value) of which every 29th is cut off after 30 characters."""
    text = F.to_json(F.struct(*P.EVENT_COLUMNS), {"ignoreNullFields": "false"})
    return events.select(F.when(F.expr("event_id % 29 = 7"), F.substring(text, 1, 30)).otherwise(text).alias("value"))


def replay_malformed(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The dead letters of messages that are no JSON: reason and text as received."""
    root = _workdir(spark, "malformed")
    truncated(events).write.text(f"{root}/in")
    SL.drain(spark, f"{root}/in", f"{root}/raw", f"{root}/dead", f"{root}/ck", policy=SL.FlushPolicy(files_per_trigger=10_000))
    letter = F.from_json("value", "failure_reason string, original_text string")
    rows = spark.read.text(f"{root}/dead").select(letter.alias("x")).select("x.*")
    return rows.filter(F.col("failure_reason") == SL.REASON_MALFORMED_JSON).select(
        "failure_reason", F.get_json_object("original_text", "$.text").alias("text"))


def replay_drain(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Rows that one drain lands and rejects."""
    root = _workdir(spark, "drain")
    write_message_files(events, f"{root}/in")
    SL.drain(spark, f"{root}/in", f"{root}/raw", f"{root}/dead", f"{root}/ck", policy=SL.FlushPolicy(files_per_trigger=4))
    landed = SL.read_landed(spark, f"{root}/raw").agg(F.count(F.lit(1)).alias("rows")).withColumn("sink", F.lit("raw"))
    dead = spark.read.text(f"{root}/dead").agg(F.count(F.lit(1)).alias("rows")).withColumn("sink", F.lit("dead_letters"))
    return landed.unionByName(dead)


class Stopped(RuntimeError):
    """A replay was stopped on purpose."""


def replay_resume(spark: SparkSession, events: DataFrame) -> DataFrame:
    """A landing stopped once after a batch's write, before its ledger entry, and once after the entry,
    before the engine's commit; then restarted and drained. Everything that landed."""
    root = _workdir(spark, "resume")
    files = write_message_files(events, f"{root}/in")
    policy = SL.FlushPolicy(files_per_trigger=max(1, files // BATCHES))

    def stop_at(step: str, batch: int):
        def after(done: str, batch_id: int) -> None:
            if (done, batch_id) == (step, batch):
                raise Stopped(f"{step} {batch}")

        return after

    for after in (stop_at("written", 1), stop_at("ledgered", 2), None):
        try:
            SL.drain(spark, f"{root}/in", f"{root}/raw", f"{root}/dead", f"{root}/ck", policy=policy, after=after)
        except StreamingQueryException as e:
            if Stopped.__name__ not in str(e):
                raise
    return SL.read_landed(spark, f"{root}/raw")

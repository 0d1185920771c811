"""Structured Streaming: consume departure messages, validate, route and land them.

Source: a topic (``kafka``; the connector must be on the classpath), a message log over files
(``message_log``, the same consumer contract without a broker) or a folder of JSON-lines
text files (``text``). All yield one ``value`` string per message.

Flush policy (J2): with Kafka, ``minOffsetsPerTrigger`` + ``maxTriggerDelay`` flush at N
messages or after T seconds, whichever first (a batch is capped only if the caller asks for it); with
files, ``maxFilesPerTrigger`` bounds a batch and a processing-time trigger sets the cadence.
Drain (J3) is ``availableNow``: consume what is there, in bounded batches, then stop.
Resume (J4) is the checkpoint: a restarted query continues after the last committed batch, and
a first start reads from the earliest offset.

A batch is landed once its ledger entry (query, batch, row counts, files) is written, after both of its sinks
and before the engine commits it. A restarted query reads the ledger: a batch that has an entry is not
written again, one that was cut off before it is. Readers see ledgered batches only.

Routing (J1) runs in ``foreachBatch``; each batch writes its valid rows and its dead letters to
folders named by the query's own id (kept in its checkpoint) and the batch id, with overwrite: a
batch replayed after a failure replaces its own output instead of doubling it, and a query with a
new checkpoint, whose batch numbers begin at 0 again, never touches what another query landed.
``compact_landed`` merges the small folders of finished batches.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tardy.schemas import (
    CONSUMER_GROUP,
    EVENT_SCHEMA,
    FLUSH_MESSAGES,
    FLUSH_SECONDS,
    LANDED_SCHEMA,
    TOPIC_DEPARTURES,
)
from tardy.sources import messages as P
from tardy.sources.parquet import conform_landed
from tardy.streaming import messagelog

CORRUPT = "_corrupt_record"
REASON_MALFORMED_JSON = "Malformed JSON"
_LANDED_PARTITIONED = StructType([*LANDED_SCHEMA.fields, StructField("query", StringType()), StructField("batch_id", LongType())])
_PARSE_SCHEMA = StructType(list(EVENT_SCHEMA.fields) + [StructField(CORRUPT, StringType())])


@dataclass(frozen=True)
class FlushPolicy:
    """Flush at ``messages`` or after ``seconds``, whichever comes first."""
    messages: int = FLUSH_MESSAGES
    seconds: int = FLUSH_SECONDS
    max_messages: int | None = None       # cap per batch; none by default
    files_per_trigger: int = 1            # file source only
    poll_seconds: int = 1                 # Kafka: how often the size-or-time rule is evaluated

    def trigger_interval(self, fmt: str) -> str:
        """Kafka polls often and lets min offsets / max delay decide; files flush on the timer."""
        return f"{self.poll_seconds} seconds" if fmt == "kafka" else f"{self.seconds} seconds"

    def kafka_options(self) -> dict:
        out = {"minOffsetsPerTrigger": str(self.messages), "maxTriggerDelay": f"{self.seconds}s"}
        return out if self.max_messages is None else out | {"maxOffsetsPerTrigger": str(self.max_messages)}


def kafka_source_options(bootstrap: str, topic: str = TOPIC_DEPARTURES, group: str = CONSUMER_GROUP,
                         policy: FlushPolicy = FlushPolicy(), skip_lost_data: bool = False) -> dict:
    """Options of the Kafka source: subscribe from the earliest offset at first start.

    Expired or deleted offsets stop the query; ``skip_lost_data`` goes on without them, and says so.
    """
    if skip_lost_data:
        logging.getLogger(__name__).warning("topic %s: lost offsets will be skipped", topic)
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": "earliest",
            "groupIdPrefix": group, "failOnDataLoss": str(not skip_lost_data).lower(), **policy.kafka_options()}


def read_messages(spark: SparkSession, source: str, fmt: str = "text", options: dict | None = None,
                  policy: FlushPolicy = FlushPolicy()) -> DataFrame:
    """A streaming frame with one ``value`` string per message."""
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**(options or {})).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    if fmt == messagelog.FORMAT:
        asked = options or {}
        return messagelog.consume(spark, source, asked.get("startingOffsets", "earliest"),
                                  asked.get("failOnDataLoss", "true") == "false").select("value")
    return (spark.readStream.format("text")
                 .option("maxFilesPerTrigger", policy.files_per_trigger)
                 .options(**(options or {}))
                 .load(source))


def parse_messages(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """JSON value -> the 12 event columns plus ``failure_reason`` (C5: bad JSON is kept, routed).

    ``keep`` names further columns to carry along; they must not be named like an event's.
    """
    j = F.from_json(F.col("value"), _PARSE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    keep = keep or []
    # a generator of one row: a filter that is pushed down does not parse the message again
    parsed = messages.select(*keep, F.col("value"), F.explode(F.array(j)).alias("m"))
    cols = [F.col(f"m.{c}").alias(c) for c in P.EVENT_COLUMNS]
    broken = F.col(f"m.{CORRUPT}").isNotNull() | F.col("m").isNull()
    out = parsed.select(*keep, "value", *cols, broken.alias("_broken"))
    reason = F.when(F.col("_broken"), F.lit(REASON_MALFORMED_JSON)).otherwise(P.failure_reason(out))
    return out.withColumn("failure_reason", reason).drop("_broken")


def dead_letter_values(routed: DataFrame) -> DataFrame:
    """Dead letters keep the original text when it did not parse, else the parsed event."""
    orig = F.when(F.col("failure_reason") == REASON_MALFORMED_JSON, F.to_json(F.struct(F.col("value").alias("text"))))
    return routed.select(F.to_json(F.struct(
        F.struct(*P.EVENT_COLUMNS).alias("original_message"),
        F.col("failure_reason"),
        orig.alias("original_text")), {"ignoreNullFields": "false"}).alias("value"))


def batch_folder(root: str, batch: DataFrame, batch_id: int) -> str:
    """``<root>/query=<id>/batch_id=<n>``; the query id lives in the checkpoint and survives restarts."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("not inside a streaming batch: no query id")
    return f"{root}/query={query}/batch_id={batch_id}"


def _ledger_file(raw_root: str, query: str, batch_id: int) -> str:
    return f"{raw_root}/_ledger/{query}-{batch_id:012d}.json"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_entry(spark: SparkSession, path: str, entry: dict) -> None:
    """Write a small file so that it appears whole or not at all."""
    fs, target = _hadoop(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if fs.exists(target):                     # of the same batch, by a run that ended before the engine's commit
        fs.delete(target, False)
    if not fs.rename(draft, target):
        raise RuntimeError(f"ledger entry {path} was not written")


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def read_entry(spark: SparkSession, path: str) -> dict | None:
    """A file that ``write_entry`` has written, or None."""
    return json.loads(spark.read.option("wholetext", True).text(path).first()[0]) if exists(spark, path) else None


def land_batch(raw_root: str, dead_root: str, after: Callable[[str, int], None] | None = None):
    """The ``foreachBatch`` function: valid rows -> raw Parquet, the rest -> dead letters, then the ledger.

    ``after`` is called with the step that was done ("written", "ledgered") and the batch; tests use it
    to stop a query at that point.
    """
    def _fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = batch_folder(raw_root, batch, batch_id)
        query = folder.split("/query=")[-1].split("/")[0]
        fs, entry = _hadoop(spark, _ledger_file(raw_root, query, batch_id))
        if fs.exists(entry):                  # landed by a run that ended before the engine's commit
            return
        valid = conform_landed(batch.filter(F.col("failure_reason").isNull()))
        valid.write.mode("overwrite").parquet(folder)
        dead = batch.filter(F.col("failure_reason").isNotNull())
        dead_letter_values(dead).write.mode("overwrite").text(batch_folder(dead_root, batch, batch_id))
        if after:
            after("written", batch_id)
        names = [s.getPath().getName() for s in fs.listStatus(_hadoop(spark, folder)[1])]
        write_entry(spark, _ledger_file(raw_root, query, batch_id),
                     {"query": query, "batch_id": batch_id, "files": sorted(n for n in names if n.startswith("part-"))})
        if after:
            after("ledgered", batch_id)

    return _fn


def read_ledger(spark: SparkSession, raw_root: str) -> DataFrame:
    """The batches that have landed: query, batch_id, files."""
    return spark.read.schema("query string, batch_id long, files array<string>").json(f"{raw_root}/_ledger")


def read_landed(spark: SparkSession, raw_root: str) -> DataFrame:
    """Everything landed under a root, whichever queries and batches wrote it; batches without a ledger
    entry are still being written and are left out."""
    last = {r["query"]: r["last"] for r in read_ledger(spark, raw_root).groupBy("query").agg(
        F.max("batch_id").alias("last")).collect()}            # one row per query that ever landed here
    rows = spark.read.schema(_LANDED_PARTITIONED).parquet(raw_root)
    done = F.lit(False)
    for query, batch in last.items():
        done = done | ((F.col("query") == query) & (F.col("batch_id") <= batch))
    return rows.filter(done).select(*LANDED_SCHEMA.fieldNames())


def compact_landed(spark: SparkSession, raw_root: str) -> int:
    """Merge the folders of finished batches, query by query; returns how many were merged.

    The newest batch of a query stays as it is (a restart may write it again). The merged rows are
    written to a folder that readers ignore; then the old folders go and the new one takes its
    name. Run it while no reader is at work. A run that was interrupted is finished by the next.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(raw_root).getFileSystem(conf)
    merged = 0
    for query in [s.getPath() for s in fs.listStatus(path(raw_root)) if s.getPath().getName().startswith("query=")]:
        names = {s.getPath().getName(): s.getPath() for s in fs.listStatus(query)}
        for name in [n for n in names if n.startswith("_merged-")]:
            if fs.exists(path(names[name], "_SUCCESS")):
                _swap(fs, path, query, name)
            else:
                fs.delete(names[name], True)
        batches = _batches(fs, query)
        if len(batches) > 2:
            last = batches[-2]
            target = f"_merged-{last}"
            old = [f"{query.toString()}/batch_id={n}" for n in batches[:-1]]
            rows = spark.read.schema(LANDED_SCHEMA).parquet(*old)
            rows.hint("rebalance").write.parquet(f"{query.toString()}/{target}")
            _swap(fs, path, query, target)
            merged += len(old)
    return merged


def _batches(fs, query) -> list[int]:
    names = [s.getPath().getName() for s in fs.listStatus(query)]
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _swap(fs, path, query, merged: str) -> None:
    """Replace the batches up to the merged one by the merged folder."""
    last = int(merged.removeprefix("_merged-"))
    for n in _batches(fs, query):
        if n <= last:
            fs.delete(path(query, f"batch_id={n}"), True)
    fs.rename(path(query, merged), path(query, f"batch_id={last}"))


def start_landing(spark: SparkSession, source: str, raw_root: str, dead_root: str, checkpoint: str,
                  fmt: str = "text", options: dict | None = None, policy: FlushPolicy = FlushPolicy(),
                  drain: bool = False, query_name: str | None = None,
                  after: Callable[[str, int], None] | None = None) -> StreamingQuery:
    """Start the landing stream; ``drain=True`` consumes what is available and stops."""
    routed = parse_messages(read_messages(spark, source, fmt, options, policy))
    w = (routed.writeStream.foreachBatch(land_batch(raw_root, dead_root, after))
               .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if drain else w.trigger(processingTime=policy.trigger_interval(fmt))
    return w.start()


def drain(spark: SparkSession, source: str, raw_root: str, dead_root: str, checkpoint: str,
          fmt: str = "text", options: dict | None = None, policy: FlushPolicy = FlushPolicy(),
          timeout_s: float | None = None, after: Callable[[str, int], None] | None = None) -> None:
    """Land everything available now, then return (replaces fixed sleeps and threads)."""
    q = start_landing(spark, source, raw_root, dead_root, checkpoint, fmt, options, policy, drain=True, after=after)
    finish(q, timeout_s)


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for a draining query; raise what it raised, or stop it and raise when time runs out."""
    if not (query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)) and query.isActive:
        query.stop()
        raise TimeoutError(f"not drained after {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()

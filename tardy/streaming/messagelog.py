"""A partitioned message log over files and its streaming reader (A10), for consumers without a broker.

Layout: ``<root>/span=<s>/partition=<p>/segment=<n>/part-*.parquet``. Segment ``n`` of a partition holds the
messages with offsets ``n*s`` to ``(n+1)*s - 1`` (gaps are allowed) and is never changed once written, so
folder names alone tell which offsets exist. Expired segments may be removed from the front.

The consumer contract: a first start reads from the earliest offset (or the latest, or given ones); a
restarted query goes on at its committed offsets, which its checkpoint keeps; offsets that were
committed but are gone stop the query, unless ``failOnDataLoss`` is false. An input partition is a run of segments of
one log partition: a batch has about ``minPartitions`` of them and none holds more than ``TASK_OFFSETS`` offsets (or one
segment), however short the segments are. Its task reads them as Arrow batches, so nothing but folder names passes the driver.
Paths may be any URI that ``pyarrow.fs`` opens (``file:``, ``hdfs:``, ``s3:``, ``gs:``, ``abfss:``).
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers need no copy of the package

FORMAT = "message_log"
SEGMENT_SPAN = 1000
TASK_OFFSETS = 250_000          # of one input partition
BATCH_ROWS = 10_000             # of one Arrow batch
MESSAGE_SCHEMA = "partition int, offset long, key string, value string, timestamp timestamp"
_STORED = ["offset", "key", "value", "timestamp"]
_SEGMENT = re.compile(r"span=(\d+)/partition=(\d+)/segment=(\d+)$")


class LostOffsetsError(RuntimeError):
    """Offsets that a consumer still needs are gone."""


class SegmentRun(InputPartition):
    """Consecutive segments of a partition: (folder, first offset, last offset (left out)) of each."""

    def __init__(self, partition: int, segments: list[tuple[str, int, int]]):
        super().__init__((partition, segments))
        self.partition, self.segments = partition, segments


class _Log:
    """What the folder names of a log say."""

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.fail_on_loss = str(options.get("failOnDataLoss", "true")).lower() != "false"
        self.min_partitions = int(options.get("minPartitions", 1))

    def segments(self) -> dict[int, dict[int, tuple[str, int]]]:
        """partition -> segment -> (path, span)."""
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") \
            else (fs.LocalFileSystem(), self.root)
        level = [base]
        for _ in range(3):               # folders by span, partition and segment; the files in them are not listed
            level = [info.path for folder in level
                     for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                     if info.type == fs.FileType.Directory]
        found: dict[int, dict[int, tuple[str, int]]] = {}
        for path in level:
            if hit := _SEGMENT.search(path):
                span, partition, segment = map(int, hit.groups())
                found.setdefault(partition, {})[segment] = (path, span)
        return found

    def ends(self, first: bool) -> dict[str, int]:
        """Per partition the earliest offset, or the one after the latest."""
        out = {}
        for partition, segments in self.segments().items():
            n = min(segments) if first else max(segments) + 1
            span = next(iter(segments.values()))[1]
            out[str(partition)] = n * span
        return out

    def ranges(self, start: dict, end: dict) -> list[SegmentRun]:
        """The segments between two positions; raises where some of them are gone."""
        wanted, held = {}, self.segments()
        if gone := [name for name in start if name not in end]:
            if self.fail_on_loss:
                raise LostOffsetsError(f"partitions {', '.join(gone)} are gone")
        for name, last in end.items():
            segments = held.get(int(name), {})
            span = next((s for _, s in segments.values()), SEGMENT_SPAN)
            # a partition that is new to the consumer begins at its first segment
            first = start.get(name, min(segments, default=0) * span)
            earliest = min(segments) * span if segments else last
            if self.fail_on_loss and first < min(earliest, last):
                raise LostOffsetsError(f"partition {name}: offsets {first} to {min(earliest, last) - 1} are gone")
            wanted[int(name)] = [(segments[n][0], max(first, n * span), min(last, (n + 1) * span))
                                 for n in sorted(segments) if n * span < last and (n + 1) * span > first]
        return self.runs(wanted)

    def runs(self, wanted: dict[int, list[tuple[str, int, int]]]) -> list[SegmentRun]:
        """Segments by partition -> input partitions."""
        total = sum(high - low for segments in wanted.values() for _, low, high in segments)
        most = min(TASK_OFFSETS, -(-total // self.min_partitions))
        out = []
        for partition, segments in wanted.items():
            run, size = [], 0
            for segment in segments:
                width = segment[2] - segment[1]
                if run and size + width > most:
                    out.append(SegmentRun(partition, run))
                    run, size = [], 0
                run.append(segment)
                size += width
            if run:
                out.append(SegmentRun(partition, run))
        return out

    def read(self, part: SegmentRun) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow import fs

        store = fs.FileSystem.from_uri(self.root)[0] if "://" in self.root or self.root.startswith("file:") else fs.LocalFileSystem()
        for path, first, last in part.segments:
            wanted = (pc.field("offset") >= first) & (pc.field("offset") < last)
            rows = ds.dataset(path, filesystem=store, format="parquet", partitioning=None)
            for batch in rows.to_batches(columns=_STORED, filter=wanted, batch_size=BATCH_ROWS, batch_readahead=1,
                                         fragment_readahead=1, use_threads=False):
                if len(batch):
                    number = pa.array([part.partition] * len(batch), pa.int32())
                    time = batch.column(3).cast(pa.timestamp("us", tz="UTC"))
                    yield pa.RecordBatch.from_arrays([number, *batch.columns[:3], time], names=["partition", *_STORED])


class MessageLogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.log, self.starting = _Log(options), options.get("startingOffsets", "earliest")

    def initialOffset(self) -> dict:
        if self.starting in ("earliest", "latest"):
            return self.log.ends(first=self.starting == "earliest")
        return {str(k): int(v) for k, v in json.loads(self.starting).items()}

    def latestOffset(self) -> dict:
        return self.log.ends(first=False)

    def partitions(self, start: dict, end: dict) -> list[SegmentRun]:
        return self.log.ranges(start, end)

    def read(self, partition: SegmentRun) -> Iterator:
        return self.log.read(partition)


class MessageLogBatch(DataSourceReader):
    def __init__(self, options: dict):
        self.log = _Log(options)

    def partitions(self) -> list[SegmentRun]:
        return self.log.ranges(self.log.ends(first=True), self.log.ends(first=False))

    def read(self, partition: SegmentRun) -> Iterator:
        return self.log.read(partition)


class MessageLogSource(DataSource):
    """``spark.read(Stream).format("message_log").option("path", root)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def reader(self, schema) -> MessageLogBatch:
        return MessageLogBatch(self.options)

    def streamReader(self, schema) -> MessageLogStream:
        return MessageLogStream(self.options)


def append_messages(messages: DataFrame, root: str, span: int = SEGMENT_SPAN) -> None:
    """Write messages (partition, offset, key, value, timestamp) as new segments.

    Offsets are the producer's and must lie beyond the segments that exist; a segment that exists is
    left as it is and the write fails. One task writes the messages of a segment, sorted by offset.
    """
    spark = messages.sparkSession
    base = f"{root}/span={span}"
    rows = messages.withColumn("segment", F.expr(f"offset div {span}"))
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        held = spark.createDataFrame([(p, n) for p, n in _held(fs, path)], "partition int, segment long")
        taken = rows.select(F.col("partition").cast("int").alias("partition"), "segment").distinct().join(
            F.broadcast(held), ["partition", "segment"]).head(1)          # one row per folder that was listed
        if taken:
            raise ValueError(f"segment {taken[0]['segment']} of partition {taken[0]['partition']} exists")
    (rows.repartition("partition", "segment").sortWithinPartitions("partition", "segment", "offset")
         .write.mode("append").partitionBy("partition", "segment").parquet(base))


def _held(fs, path) -> list[tuple[int, int]]:
    out = []
    for p in fs.listStatus(path):
        name = p.getPath().getName()
        if name.startswith("partition="):
            for s in fs.listStatus(p.getPath()):
                out.append((int(name[10:]), int(s.getPath().getName()[8:])))
    return out


def _register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLogSource)


def _min_partitions(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """All messages of a log."""
    _register(spark)
    return spark.read.format(FORMAT).option("path", root).option("minPartitions", _min_partitions(spark)).load()


def consume(spark: SparkSession, root: str, starting: str = "earliest", skip_lost_data: bool = False) -> DataFrame:
    """A10: the messages of a log as a stream, one ``value`` per message with its place and time.

    ``starting`` (earliest, latest or a JSON object of partition -> offset) matters at the first start
    only; afterwards the checkpoint's offsets do.
    """
    _register(spark)
    return (spark.readStream.format(FORMAT).option("path", root).option("startingOffsets", starting)
                 .option("minPartitions", _min_partitions(spark))
                 .option("failOnDataLoss", str(not skip_lost_data).lower()).load())

"""Flush numbers by size or time (J2): which messages a consumer writes together.

A consumer holds its messages until there are ``messages`` of them or ``seconds`` have passed since its
last flush, whichever comes first. Per topic partition and in the order of offsets: a message that
finds held messages and comes ``seconds`` or more after the last flush begins the next group (the held ones are
flushed just before it); the message that fills the group is flushed with it. Times are the messages' own,
so the numbers do not depend on when or in which micro-batches the messages are read.

The open group (number, messages, time of the last flush, offset that is done) is one small state per
partition in RocksDB; the next micro-batch goes on from it. Messages of a repeated delivery, at
offsets that are done, get no second number.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tardy.schemas import FLUSH_MESSAGES, FLUSH_SECONDS
from tardy.streaming.stateful import ROCKSDB

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_SCHEMA = "number long, held long, flushed_us long, done long"
NUMBERED_SCHEMA = "partition int, offset long, flush_no long, reason string"


class FlushNumbers(StatefulProcessor):
    """Numbers the messages of one partition. ``reason`` is set on the last message of a flush by size
    and on the first message after a flush by time."""

    def __init__(self, messages: int, seconds: int):
        self.messages, self.micros = messages, seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open_group", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # places and times only (16 bytes a message): the order of offsets is not that of arrival
        batch = pd.concat([r[["offset", "at_us"]] for r in rows]).drop_duplicates("offset").sort_values("offset")
        number, held, flushed, done = self.open.get() if self.open.exists() else (0, 0, None, -1)
        out = []
        for offset, at in batch.itertuples(index=False, name=None):
            if offset <= done:
                continue
            flushed, reason = at if flushed is None else flushed, None
            if held and at - flushed >= self.micros:
                number, held, flushed, reason = number + 1, 0, at, "time"
            mine, held = number, held + 1
            if held == self.messages:
                number, held, flushed, reason = number + 1, 0, at, "size"
            out.append((key[0], offset, mine, reason))
            done = offset
        if out:
            self.open.update((number, held, flushed, done))
            yield pd.DataFrame(out, columns=["partition", "offset", "flush_no", "reason"])

    def close(self) -> None:
        pass


def flush_numbers(messages: DataFrame, size: int = FLUSH_MESSAGES, seconds: int = FLUSH_SECONDS) -> DataFrame:
    """(partition, offset, flush_no, reason) of a stream of messages (partition, offset, timestamp)."""
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    places = messages.select("partition", "offset", F.unix_micros("timestamp").alias("at_us"))
    return places.groupBy("partition").transformWithStateInPandas(
        FlushNumbers(size, seconds), NUMBERED_SCHEMA, "update", "None")

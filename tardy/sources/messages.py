"""Validation and routing of departure events to a message sink and a dead-letter sink.

(A8, A9, C2, F15, B22.) An event is publishable when ``station_id`` and ``vehicle_id`` are both
present and non-empty (the truthiness check) and it parsed cleanly. Publishable events become
keyed messages: ``key = station_id`` (so a partitioned topic keeps a station in order) and
``value`` = the event as JSON with nulls kept. Everything else becomes a dead letter
``{original_message, failure_reason, original_text}`` without a key.

Sinks take a ``format`` argument: ``kafka`` (needs the connector on the classpath; pass
``kafka.bootstrap.servers`` and ``topic`` options) or any file format for tests and lakes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.schemas import EVENT_SCHEMA, PUBLISH_REQUIRED, REASON_MISSING

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
_KEEP_NULLS = {"ignoreNullFields": "false"}


def publishable() -> Column:
    """Required fields neither null nor empty."""
    cond = None
    for c in PUBLISH_REQUIRED:
        part = F.coalesce(F.col(c), F.lit("")) != F.lit("")
        cond = part if cond is None else cond & part
    return cond


def _error_col(df: DataFrame) -> Column:
    return F.col("parse_error") if "parse_error" in df.columns else F.lit(None).cast("string")


def failure_reason(df: DataFrame) -> Column:
    """Null for a publishable event, else the reason it goes to the dead letters."""
    err = _error_col(df)
    return F.when(err.isNotNull(), err).when(~publishable(), F.lit(REASON_MISSING))


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn("failure_reason", failure_reason(df))


def event_json(cols: list[str] | None = None) -> Column:
    """B22 (out): the event as JSON text, nulls written as null."""
    return F.to_json(F.struct(*(cols or EVENT_COLUMNS)), _KEEP_NULLS)


def to_messages(df: DataFrame) -> DataFrame:
    """Publishable events as (key, value)."""
    routed = with_route(df)
    return routed.filter(F.col("failure_reason").isNull()).select(
        F.col("station_id").alias("key"), event_json().alias("value"))


def _dead_letter_value(df: DataFrame) -> Column:
    text = F.col("original_text") if "original_text" in df.columns else F.lit(None).cast("string")
    return F.to_json(F.struct(F.struct(*EVENT_COLUMNS).alias("original_message"), "failure_reason",
                              text.alias("original_text")), _KEEP_NULLS)


def to_dead_letters(df: DataFrame) -> DataFrame:
    """The rest as (value) with value = {original_message, failure_reason, original_text}.

    ``original_text`` is the departure as received, where its parser kept it, so a value that did
    not parse is not lost.
    """
    routed = with_route(df)
    return routed.filter(F.col("failure_reason").isNotNull()).select(_dead_letter_value(df).alias("value"))


def routed(df: DataFrame) -> DataFrame:
    """Every event once: the 12 columns, ``failure_reason`` and, where there is one, the dead letter (``value``)."""
    rows = with_route(df)
    value = F.when(F.col("failure_reason").isNotNull(), _dead_letter_value(df))
    return rows.select(*EVENT_COLUMNS, "failure_reason", value.alias("value"))


def parse_message(value: Column) -> Column:
    """B22 (in): JSON text -> typed event struct."""
    return F.from_json(value, EVENT_SCHEMA)


def publish_counts(df: DataFrame) -> DataFrame:
    """{published, failed} in one aggregate."""
    reason = failure_reason(df)
    return df.agg(F.count_if(reason.isNull()).alias("published"),
                  F.count_if(reason.isNotNull()).alias("failed"))


def write_messages(msgs: DataFrame, path_or_topic: str, fmt: str = "json", options: dict | None = None) -> None:
    """Write (key, value) messages to a topic (``fmt='kafka'``) or to files."""
    w = msgs.write.options(**(options or {}))
    if fmt == "kafka":
        w.format("kafka").option("topic", path_or_topic).save()
    else:
        w.mode("append").format(fmt).save(path_or_topic)


def route_and_write(df: DataFrame, valid_target: str, dead_target: str, fmt: str = "json",
                    options: dict | None = None) -> None:
    """Write both sinks from one routing of ``df`` (persist it first when it is expensive)."""
    write_messages(to_messages(df), valid_target, fmt, options)
    write_messages(to_dead_letters(df), dead_target, fmt, options)

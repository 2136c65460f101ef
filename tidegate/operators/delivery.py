"""From events to topic records and back, with a place for what fails on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.deadletter import LINE_FIELDS, dead_letter_line, unescape
from tidegate.functions.keys import topic_or_default
from tidegate.functions.wire import EVENT_FIELDS, decode_records, encodable, encode_event


def to_records(events: DataFrame, topic: Column | None = None, default_topic: str = "events",
               time: Column | None = None) -> DataFrame:
    """Topic records of events: topic, key, value and one time for the whole batch.

    An event that cannot be encoded (a string that is not UTF-8) has no record; see
    `unencodable`.
    """
    topic = F.lit("") if topic is None else topic
    return events.where(_encodable()).select(
        topic_or_default(topic, default_topic).alias("topic"),
        F.coalesce("event_id", F.lit("")).cast("binary").alias("key"),
        encode_event(*[F.col(name) for name, _, _ in EVENT_FIELDS]).alias("value"),
        (F.current_timestamp() if time is None else time).alias("time"))


def unencodable(events: DataFrame) -> DataFrame:
    """The events that `to_records` leaves out."""
    return events.where(~_encodable())


def _encodable() -> Column:
    return encodable(F.col("event_id"), F.col("tenant_id"), F.col("payload"))


def decode_split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded events, and the records that could not be decoded with their error."""
    decoded = decode_records(records)
    names = [name for name, _, _ in EVENT_FIELDS]
    return (decoded.where("error IS NULL").drop("error"),
            decoded.where("error IS NOT NULL").drop(*names))


def dead_letter_lines(failed: DataFrame) -> DataFrame:
    """One text line per failed record (`failed_at`, `topic`, `key`, `error`, `value`)."""
    return failed.select(dead_letter_line(
        F.col("failed_at"), F.col("topic"), F.col("key"), F.col("error"), F.col("value"))
        .alias("line"))


def parse_dead_letters(lines: DataFrame, column: str = "value") -> DataFrame:
    """The fields of dead-letter lines, with the value as bytes again."""
    parts = F.split(F.col(column), "\t", -1)
    text = {name: unescape(F.get(parts, F.lit(i))) for i, name in enumerate(LINE_FIELDS[:-1])}
    return lines.select(
        *[text[name].alias(name) for name in LINE_FIELDS[:-1]],
        F.unbase64(F.get(parts, F.lit(len(LINE_FIELDS) - 1))).alias("value"))


def failure_counters(failed: DataFrame, batch: str = "batch_id",
                     dead_lettered: Column | None = None) -> DataFrame:
    """Failures of publishing per batch, and failed and dead-lettered records per record."""
    kept = F.lit(True) if dead_lettered is None else dead_lettered
    return failed.agg(F.count_distinct(batch).alias("publish_errors"),
                      F.count(F.lit(1)).alias("async_errors"),
                      F.count_if(kept).alias("dead_lettered"))

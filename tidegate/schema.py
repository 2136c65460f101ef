"""Row layouts of events, acknowledgements, topic records and the event table."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

BATCH = T.StructType([
    T.StructField("tenant_id", T.StringType()),
    T.StructField("events", T.ArrayType(EVENT)),
])

EVENT_ACK = T.StructType([
    T.StructField("accepted", T.BooleanType()),
    T.StructField("message", T.StringType()),
    T.StructField("processed_at", T.LongType()),
])

BATCH_ACK = T.StructType([
    T.StructField("accepted", T.BooleanType()),
    T.StructField("accepted_count", T.IntegerType()),
    T.StructField("rejected_count", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("processed_at", T.LongType()),
])

STREAM_ACK = T.StructType([
    T.StructField("accepted", T.BooleanType()),
    T.StructField("total_received", T.LongType()),
    T.StructField("accepted_count", T.LongType()),
    T.StructField("rejected_count", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("processed_at", T.LongType()),
])

RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("failed_at", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("value_b64", T.StringType()),
])

STORED = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
])

# The acknowledgement messages.
MSG_QUEUED = "event queued successfully"
MSG_QUOTA = "rate limit exceeded"
MSG_SHED = "buffer full; shed load"
MSG_EMPTY_BATCH = "empty batch"
MSG_BATCH = "batch processed"
MSG_STREAM = "stream ingestion completed"

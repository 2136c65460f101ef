"""Topics: a Kafka topic where the connector is installed, or files with the same columns.

The Kafka forms only pass options to Spark's connector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegate import schema as S
from tidegate.functions.keys import topic_or_default
from tidegate.settings import TopicSettings

# Fixed value: compression of published records.
COMPRESSION = "snappy"


def read_topic(spark: SparkSession, topic: str = "events", format: str = "kafka",
               path: str | None = None, **options) -> DataFrame:
    """Records of a topic as a batch: `topic`, `key`, `value`, `time`."""
    return _records(spark.read, topic, format, path, options)


def read_topic_stream(spark: SparkSession, topic: str = "events", format: str = "kafka",
                      path: str | None = None, **options) -> DataFrame:
    """Records of a topic as a stream.

    A micro-batch is bounded by `maxOffsetsPerTrigger` (Kafka) or `maxFilesPerTrigger`
    (files); Kafka's `minOffsetsPerTrigger` and `maxTriggerDelay` wait for a fuller one.
    """
    return _records(spark.readStream, topic, format, path, options)


def _records(reader, topic: str, format: str, path: str | None, options: dict) -> DataFrame:
    if format == "kafka":
        rows = reader.format("kafka").option("subscribe", topic).options(**options).load()
    else:
        rows = reader.format(format).schema(S.RECORD).options(**options).load(path)
        rows = rows.where(F.col("topic") == topic)
    return rows.select("topic", "key", "value", F.col("timestamp").alias("time"))


def _outgoing(records: DataFrame, format: str, default_topic: str) -> DataFrame:
    topic = topic_or_default(F.col("topic"), default_topic).alias("topic")
    if format == "kafka":
        return records.select(topic, F.col("key").cast("binary"), "value")
    time = F.col("time") if "time" in records.columns else F.current_timestamp()
    return records.select(topic, F.col("key").cast("binary"), "value", time.alias("timestamp"))


def _producer_options(settings: TopicSettings) -> dict[str, str]:
    return {"kafka.compression.type": COMPRESSION,
            "kafka.linger.ms": str(settings.producer_timeout_ms)}


def publish(records: DataFrame, format: str = "kafka", path: str | None = None,
            settings: TopicSettings = TopicSettings(), mode: str = "append", **options) -> None:
    """Write records; a missing topic becomes the default one."""
    writer = _outgoing(records, format, settings.topic).write.format(format)
    if format == "kafka":
        writer.options(**_producer_options(settings)).options(**options).save()
    else:
        writer.mode(mode).option("compression", COMPRESSION).options(**options).save(path)


def publish_stream(records: DataFrame, checkpoint: str, format: str = "kafka",
                   path: str | None = None, settings: TopicSettings = TopicSettings(),
                   **options) -> DataStreamWriter:
    """A stream writer of records; the caller sets the trigger and starts it."""
    writer = (_outgoing(records, format, settings.topic).writeStream.format(format)
              .option("checkpointLocation", checkpoint))
    if format == "kafka":
        return writer.options(**_producer_options(settings)).options(**options)
    return writer.option("compression", COMPRESSION).option("path", path).options(**options)

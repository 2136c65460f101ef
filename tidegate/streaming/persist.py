"""From a topic to the event table, one micro-batch at a time.

Offsets are committed after the batch function returns, so a batch that fails is not passed
over: the restarted query gets it again under the same number, and the table and the
dead-letter folder replace what that number wrote. Numbers belong to a checkpoint, so its
identity names the writer; a stream that starts over with a new checkpoint replaces nothing.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.wire import EVENT_FIELDS, decode_records, encode_event
from tidegate.operators.delivery import dead_letter_lines
from tidegate.operators.persistence import constraint_reason
from tidegate.settings import FlushSettings
from tidegate.sources.table import insert_batch
from tidegate.streaming.flush import FLUSH_SCHEMA, with_trigger


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a checkpoint's query. Spark notes it there before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_persist(records: DataFrame, name: str, order: list[str], dead_letters: str,
                  flushes: str, checkpoint: str, flush: FlushSettings = FlushSettings(),
                  drain: bool = False,
                  after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Decode records (`topic`, `key`, `value` and the `order` columns), set aside those that
    cannot be decoded or stored, and write the rest to the event table `name`.

    `dead_letters` gets their lines and `flushes` one row of counts per micro-batch.
    `after_write` is called on the driver with a batch's number when all of it is written, before
    its offsets are committed: to tell others, who may hear of a batch twice. If it raises, the
    query fails and the batch comes again.
    """

    @lru_cache(maxsize=1)
    def writer_id(spark: SparkSession) -> str:
        return writer_of(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        begin = time.monotonic()
        writer = writer_id(batch.sparkSession)
        decoded = decode_records(batch).withColumn(
            "_undecoded", F.col("error").isNotNull()).withColumn(
            "error", F.coalesce("error", constraint_reason()))
        # Only a dead letter needs the record itself; the others are kept by their fields alone.
        decoded = decoded.withColumns({
            c: F.when(F.col("error").isNotNull(), F.col(c)) for c in ("topic", "key", "value")
            if c not in order}).persist()
        try:
            failed = decoded.agg(
                F.count_if("_undecoded").alias("undecodable"),
                F.count_if(~F.col("_undecoded") & F.col("error").isNotNull()).alias("broken")).first()
            lines = decoded.where("error IS NOT NULL").withColumn(
                "failed_at", F.current_timestamp())
            dead_letter_lines(lines).write.mode("overwrite").text(
                f"{dead_letters}/writer={writer}/batch_id={batch_id}")
            counts = insert_batch(decoded.where("error IS NULL"), name, batch_id, order, writer)
        finally:
            decoded.unpersist()
        row = (batch_id, counts.attempted, counts.inserted, failed["undecodable"],
               failed["broken"], int((time.monotonic() - begin) * 1000))
        (batch.sparkSession.createDataFrame([row], FLUSH_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(f"{flushes}/writer={writer}/flush={batch_id}"))
        if after_write is not None:
            after_write(batch_id)

    stream = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(stream, flush, drain).start()


def as_records(events: DataFrame, order: list[str], topic: str = "events") -> DataFrame:
    """Events of a stream as records that keep their order columns."""
    return events.select(
        F.lit(topic).alias("topic"), F.col("event_id").cast("binary").alias("key"),
        encode_event(*[F.col(field) for field, _, _ in EVENT_FIELDS]).alias("value"), *order)

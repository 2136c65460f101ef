"""When a stream hands over a micro-batch, and what it reports about it."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegate.settings import FlushSettings

FLUSH_SCHEMA = ("batch_id long, attempted long, inserted long, undecodable long, "
                "constraint_failures long, latency_ms long")


def size_options(format: str, flush: FlushSettings = FlushSettings(), files_per_flush: int = 1,
                 bytes_per_flush: int | None = None) -> dict[str, str]:
    """Reader options that bound a micro-batch: records of a Kafka topic, and elsewhere files, or
    the bytes of files (one file is taken whole). Files should hold no more rows than a flush."""
    if format == "kafka":
        return {"maxOffsetsPerTrigger": str(flush.batch_size)}
    if bytes_per_flush is not None:
        return {"maxBytesPerTrigger": str(bytes_per_flush)}
    return {"maxFilesPerTrigger": str(files_per_flush)}


def with_trigger(writer: DataStreamWriter, flush: FlushSettings = FlushSettings(),
                 drain: bool = False) -> DataStreamWriter:
    """Flush on time; with `drain`, take everything that is there, in bounded micro-batches,
    and stop."""
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{flush.batch_timeout_ms} milliseconds")


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; its failure is raised here."""
    query.awaitTermination()
    return query


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Settings for the queries started inside; a running query keeps those it started with."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Size and latency of the recent micro-batches of a query."""
    return [{"batch_id": p["batchId"], "rows": p["numInputRows"],
             "latency_ms": p["durationMs"].get("triggerExecution")}
            for p in query.recentProgress]


def flush_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per flush of a persisting stream, with the writer's running total attempted."""
    rows = spark.read.schema(f"{FLUSH_SCHEMA}, writer string").parquet(path)
    upto = (Window.partitionBy("writer").orderBy("batch_id")
            .rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("total_persisted", F.sum("attempted").over(upto))

"""Dead letters back into the event table, with a bounded number of attempts.

A stream over the dead-letter files decodes each record again and stores what the table can hold,
once per key. What fails again goes back to the dead letters as a line whose error tells the
attempt, and the stream finds it there like any other; after the last attempt it goes to the poison
lines instead, which nothing reads on its own. Lines keep their time, topic, key and value.

Retried and poison lines are folders named by writer and batch, and the table replaces a batch that
comes again, so a batch that failed in between leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.wire import decode_records
from tidegate.operators.delivery import dead_letter_lines, parse_dead_letters
from tidegate.operators.persistence import constraint_reason
from tidegate.settings import FlushSettings
from tidegate.sources.table import insert_batch
from tidegate.streaming.flush import run_to_end, size_options, with_trigger
from tidegate.streaming.persist import writer_of

ATTEMPT = r"^attempt (\d+): "


def attempt_of(error: Column) -> Column:
    """How often a line's record has been tried again, from its error."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(error, ATTEMPT, 1), F.lit("")),
                                      F.lit("999999999")).cast("int"), F.lit(0))


def start_replay(spark: SparkSession, letters: str, name: str, order: list[str], poison: str,
                 checkpoint: str, attempts: int = 3, flush: FlushSettings = FlushSettings(),
                 drain: bool = False, **bounds: str) -> StreamingQuery:
    """Replay the lines below `letters` into the event table `name`. `order` tells which of equal
    keys is first, by `failed_at` and the event's columns; `bounds` are reader options."""
    if attempts <= 0:
        raise ValueError(f"attempts must be positive, got {attempts}")

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch.sparkSession, checkpoint)
        folder = f"writer={writer}/batch_id={batch_id}"
        lines = parse_dead_letters(batch).withColumn(
            "failed_at", F.try_to_timestamp("failed_at")).withColumnRenamed("error", "before")
        decoded = decode_records(lines).withColumn(
            "error", F.coalesce("error", constraint_reason())).withColumn(
            "attempt", attempt_of(F.col("before")) + 1).persist()
        try:
            failed = decoded.where("error IS NOT NULL").withColumn(
                "error", F.concat(F.lit("attempt "), "attempt", F.lit(": "), "error"))
            again = failed.where(F.col("attempt") < attempts)
            if not again.isEmpty():
                dead_letter_lines(again).write.mode("overwrite").text(
                    f"{letters}/retries/{folder}")
            dead_letter_lines(failed.where(F.col("attempt") >= attempts)).write.mode(
                "overwrite").text(f"{poison}/{folder}")
            insert_batch(decoded.where("error IS NULL"), name, batch_id, order, writer)
        finally:
            decoded.unpersist()

    lines = (spark.readStream.option("recursiveFileLookup", "true")
             .options(**(bounds or size_options("text", flush, files_per_flush=1000)))
             .text(letters))
    stream = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(stream, flush, drain).start()


def drain_replay(start: Callable[[], StreamingQuery]) -> None:
    """Run the draining replay that `start` starts until no line is left to be tried."""
    while sum(p["numInputRows"] for p in run_to_end(start()).recentProgress):
        pass

"""Bounded removal of repeated deliveries within a stream.

The event table removes repeats for good. This opt-in form forgets a key once the watermark
has passed it by `within`, and so keeps a bounded state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidegate.functions.keys import nanos_to_timestamp


def _first_deliveries(events: DataFrame, key: str, arrival: str) -> DataFrame:
    """The first delivery of each key among the rows that a task reads together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_arrival = pc.sort_indices(batch.column(arrival), null_placement="at_end")
            place = np.empty(batch.num_rows, np.int64)
            place[by_arrival] = np.arange(batch.num_rows)
            table = pa.table({"key": batch.column(key), "place": place})
            first = table.group_by("key").aggregate([("place", "min")]).column("place_min")
            yield batch.take(pa.array(np.sort(np.asarray(by_arrival)[first.to_numpy()])))
    return events.mapInArrow(run, events.schema)


def drop_repeats(events: DataFrame, within: str = "10 minutes", arrival: str = "timestamp",
                 key: str = "event_id", salts: int = 1, ahead: bool = True) -> DataFrame:
    """Pass one delivery of a key among those that arrive within `within` of it; null is a key.

    A micro-batch passes a key once. With `ahead` its repeats among the rows that a task reads
    together are dropped before the shuffle, so that a key that a third of the rows hold sends a row
    per Arrow batch. With `salts` above 1 repeats are first dropped among the rows of the same input
    partition, up to `salts` of them apart, across micro-batches too. That is a second shuffle with
    state of its own.
    """
    once = _first_deliveries(events, key, arrival) if ahead else events
    stamped = (once.withColumn("_arrived", nanos_to_timestamp(F.col(arrival)))
               .withWatermark("_arrived", within))
    if salts > 1:
        stamped = (stamped.withColumn("_salt", F.spark_partition_id() % salts)
                   .dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt"))
    return stamped.dropDuplicatesWithinWatermark([key]).drop("_arrived")

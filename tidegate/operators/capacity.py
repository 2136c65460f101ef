"""Bounded intake per interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.quota import admit_within
from tidegate.operators.running import HOT_ROWS, Slices, find_slices, running_total
from tidegate.settings import Capacity


def row_cap(events: DataFrame, capacity: Capacity, interval: str, order: list[str],
            taking: Column | None = None, taken: DataFrame | None = None,
            slices: Slices | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `buffered`: whether a row is among the first `capacity.total` of its interval.

    Rows for which `taking` does not hold (denied by the quota, say) need no room. `taken`
    holds `(interval, used)` of earlier runs.
    """
    room = None if taking is None else taking.cast("long")
    reserved = None
    if taken is not None:
        reserved = taken.select(interval, F.col("used").alias("amount"))
    return admit_within(events, [interval], order, capacity.total, room, reserved, slices,
                        hot_rows, out="buffered")


def batch_cap(batches: DataFrame, capacity: Capacity, interval: str, order: list[str],
              size: str = "n", taking: Column | None = None, slices: Slices | None = None,
              hot_rows: int = HOT_ROWS, taken: DataFrame | None = None) -> DataFrame:
    """Add `batch_no`, `shard` and `accepted_count`, the length of the prefix that fits.

    The batches of an interval go to the shards in turn, starting at `1 % shards`; a shard
    takes events until it is full. Only batches for which `taking` holds (default: the
    non-empty ones) are numbered and submitted; the others get no number and accept 0.

    `taken` holds `(interval, shard, batches, used)` of earlier runs: how many batches went to a
    shard, and their events (see `batch_room`). It enters both running totals as one row per group
    ahead of the others.
    """
    if slices is None:
        slices = find_slices(batches, [interval], order, hot_rows)
    columns = batches.columns
    takes = F.col(size) > 0 if taking is None else taking & (F.col(size) > 0)
    sent = F.when(takes, F.col(size)).otherwise(0).cast("long")
    marked = batches.withColumns({"_sent": sent, "_count": (sent > 0).cast("long")})
    if taken is not None:
        earlier = taken.groupBy(interval).agg(F.sum("batches").alias("_count"))
        marked = _ahead(marked, earlier.withColumn("_sent", F.lit(0).cast("long")))
    numbered = running_total(marked, [interval], order, "_number", F.col("_count"), slices)
    # The order is the same within a shard, so the ranges of hot intervals serve here too.
    placed = numbered.withColumn("shard", F.col("_number") % capacity.shards)
    if taken is not None:
        placed = _ahead(placed.where("_real").drop("_real"), taken.select(
            interval, "shard", F.col("used").cast("long").alias("_sent")))
    filled = running_total(placed, [interval, "shard"], order, "_filled", F.col("_sent"), slices)
    if taken is not None:
        filled = filled.where("_real")
    free = F.lit(capacity.per_shard) - (F.col("_filled") - F.col("_sent"))
    sent = F.col("_sent") > 0
    return filled.select(
        *columns, F.when(sent, F.col("_number")).alias("batch_no"),
        F.when(sent, F.col("shard")).alias("shard"),
        F.greatest(F.lit(0), F.least(F.col("_sent"), free)).cast("int").alias("accepted_count"))


def _ahead(rows: DataFrame, reserved: DataFrame) -> DataFrame:
    """Rows and reserved ones, which have no place in the order and so come first."""
    return rows.withColumn("_real", F.lit(True)).unionByName(
        reserved.withColumn("_real", F.lit(False)), allowMissingColumns=True)


def batch_room(placed: DataFrame, capacity: Capacity, interval: str, size: str = "n",
               taken: DataFrame | None = None) -> DataFrame:
    """(interval, shard, batches, used) after the batches that `batch_cap` placed. A full shard
    stays at its size."""
    own = placed.where("batch_no is not null").groupBy(interval, "shard").agg(
        F.count(F.lit(1)).alias("batches"), F.sum(F.col(size).cast("long")).alias("used"))
    if taken is not None:
        own = own.unionByName(taken).groupBy(interval, "shard").agg(
            F.sum("batches").alias("batches"), F.sum("used").alias("used"))
    return own.withColumn("used", F.least("used", F.lit(capacity.per_shard).cast("long")))

"""Acknowledgements of events, batches and client streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidegate import schema as S
from tidegate.operators.capacity import batch_cap
from tidegate.operators.quota import QUOTA_KEYS, quota_admission
from tidegate.operators.running import HOT_ROWS, find_slices
from tidegate.settings import Capacity, QuotaPolicy


def now_nanos() -> Column:
    return F.unix_micros(F.current_timestamp()) * F.lit(1000)


def event_acks(events: DataFrame, processed_at: Column | None = None,
               admitted: str = "admitted", buffered: str | None = None) -> DataFrame:
    """Turn the quota flag, and the capacity flag if there is one, into `accepted`, `message`
    and `processed_at`."""
    fits = F.lit(True) if buffered is None else F.col(buffered)
    flags = [c for c in (admitted, buffered) if c]
    return events.withColumns({
        "accepted": F.col(admitted) & fits,
        "message": F.when(~F.col(admitted), S.MSG_QUOTA).when(~fits, S.MSG_SHED)
        .otherwise(S.MSG_QUEUED),
        "processed_at": now_nanos() if processed_at is None else processed_at,
    }).drop(*flags)


def split_accepted(acks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows; the latter keep their reason."""
    return acks.where("accepted"), acks.where("NOT accepted")


def batch_acks(batches: DataFrame, policy: QuotaPolicy, capacity: Capacity, order: list[str],
               interval: str = "window_idx", processed_at: Column | None = None,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """One acknowledgement per batch, from rows with quota keys and the batch size `n`.

    The quota takes a batch whole or not at all; the buffers take a prefix of it. An empty
    batch is accepted and touches neither.
    """
    # Ranges of the hot intervals, found once, serve the finer quota groups as well.
    slices = find_slices(batches, [interval], order, hot_rows)
    quota_slices = slices if interval in QUOTA_KEYS else None
    charged = quota_admission(batches, policy, order, charge=F.col("n"), slices=quota_slices,
                              hot_rows=hot_rows)
    placed = batch_cap(charged, capacity, interval, order, taking=F.col("admitted"),
                       slices=slices)
    return batch_ack_columns(placed, batches.columns, processed_at)


def batch_ack_columns(placed: DataFrame, columns: list[str],
                      processed_at: Column | None = None) -> DataFrame:
    """The acknowledgements of batches of size `n` that the quota judged (`admitted`) and the
    buffers took (`accepted_count`), next to the `columns` to keep."""
    n, taken, empty = F.col("n"), F.col("accepted_count"), F.col("n") == 0
    return placed.withColumns({
        "accepted": empty | (F.col("admitted") & (taken == n)),
        "rejected_count": (n - taken).cast("int"),
        "message": F.when(empty, S.MSG_EMPTY_BATCH).when(~F.col("admitted"), S.MSG_QUOTA)
        .otherwise(S.MSG_BATCH),
        "processed_at": now_nanos() if processed_at is None else processed_at,
    }).select(*columns, "accepted", "accepted_count", "rejected_count", "message",
              "processed_at")


def stream_acks(events: DataFrame, stream: str = "stream_id",
                processed_at: Column | None = None) -> DataFrame:
    """One summary per client stream from its acknowledged events."""
    closed = now_nanos() if processed_at is None else processed_at
    return (
        events.groupBy(stream)
        .agg(F.count(F.lit(1)).alias("total_received"),
             F.count_if("accepted").alias("accepted_count"),
             F.count_if(~F.col("accepted")).alias("rejected_count"),
             *([] if processed_at is None else [F.max(processed_at).alias("processed_at")]))
        .select(stream, (F.col("accepted_count") > 0).alias("accepted"), "total_received",
                "accepted_count", "rejected_count", F.lit(S.MSG_STREAM).alias("message"),
                closed.alias("processed_at") if processed_at is None else "processed_at"))


def observe_outcomes(acks: DataFrame, observation: Observation) -> DataFrame:
    """Count accepted and rejected rows while they are written, without another pass. The
    counts are in `observation.get` after an action, or in a stream's progress under its name.
    They are for watching a run: a task that runs again counts again.
    """
    return acks.observe(observation, F.count_if("accepted").alias("accepted_total"),
                        F.count_if(~F.col("accepted")).alias("rejected_total"))


def outcome_totals(acks: DataFrame) -> DataFrame:
    """Accepted and rejected totals of acknowledged events."""
    return acks.agg(F.count_if("accepted").alias("accepted_total"),
                    F.count_if(~F.col("accepted")).alias("rejected_total"))


def batch_totals(acks: DataFrame) -> DataFrame:
    """The same totals from batch acknowledgements; they count events, not batches."""
    return acks.agg(
        F.coalesce(F.sum("accepted_count"), F.lit(0)).alias("accepted_total"),
        F.coalesce(F.sum("rejected_count"), F.lit(0)).alias("rejected_total"))

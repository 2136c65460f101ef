"""Idempotent persistence: constraints, first write wins, and what is still missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_KEY_CHARS = 64


def constraint_reason(max_chars: int = MAX_KEY_CHARS) -> Column:
    """Why the event table cannot hold a row; null when it can."""
    reason = F.lit(None).cast("string")
    for name in ("tenant_id", "event_id"):
        reason = F.when(F.char_length(name) > max_chars,
                        f"{name} longer than {max_chars}").otherwise(reason)
    for name in ("timestamp", "payload", "tenant_id", "event_id"):
        reason = F.when(F.col(name).isNull(), f"{name} is null").otherwise(reason)
    return reason


def constraint_split(events: DataFrame,
                     max_chars: int = MAX_KEY_CHARS) -> tuple[DataFrame, DataFrame]:
    """Rows the event table can hold, and the others with a `reason`."""
    checked = events.withColumn("reason", constraint_reason(max_chars))
    return (checked.where("reason IS NULL").drop("reason"), checked.where("reason IS NOT NULL"))


def first_write(events: DataFrame, order: list[str], key: str = "event_id") -> DataFrame:
    """The earliest row of each key. `order` must be total within a key.

    The limit on the rank is applied before the shuffle as well, so a key that holds much of
    the data sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return events.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def not_stored(events: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key the target does not hold yet.

    An outer join, since Spark moves an anti-join below the step that made `events` unique, and
    would then join every repeat of a key.
    """
    known = stored.select(F.col(key).alias("_known"))
    return (events.join(known, F.col(key) == F.col("_known"), "left")
            .where(F.col("_known").isNull()).drop("_known"))


def stored_rows(events: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The columns of the event table."""
    return events.select(
        "event_id", "tenant_id", "payload", F.col("timestamp").alias("event_timestamp"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"))


def backlog(accepted: DataFrame, stored: DataFrame) -> DataFrame:
    """Accepted events that are not in the target yet, per tenant."""
    # Counted per key first: a key delivered very often then is one row in the join.
    per_key = accepted.groupBy("event_id", "tenant_id").agg(F.count(F.lit(1)).alias("_n"))
    return (not_stored(per_key, stored)
            .groupBy("tenant_id").agg(F.sum("_n").alias("waiting")))

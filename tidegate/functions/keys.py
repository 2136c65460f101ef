"""Column expressions for event defaults, quota keys and time units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NANOS_PER_SECOND = 1_000_000_000


def with_event_defaults(df: DataFrame) -> DataFrame:
    """Absent strings become "" and an absent timestamp 0; other columns pass through."""
    return df.withColumns({
        "event_id": F.coalesce("event_id", F.lit("")),
        "tenant_id": F.coalesce("tenant_id", F.lit("")),
        "payload": F.coalesce("payload", F.lit("")),
        "timestamp": F.coalesce("timestamp", F.lit(0).cast("long")),
    })


def quota_tenant(tenant: Column) -> Column:
    """The tenant charged: the unnamed tenant, absent or "", shares the quota of "default"."""
    return F.when(F.coalesce(tenant, F.lit("")) == "", F.lit("default")).otherwise(tenant)


def batch_tenant(tenant: Column, first_event_tenant: Column) -> Column:
    """The tenant of a batch: its own, else that of its first event."""
    return F.when(tenant != "", tenant).otherwise(F.coalesce(first_event_tenant, F.lit("")))


def window_index(ts_ns: Column, window_sec: int) -> Column:
    """Epoch-aligned number of the fixed window that a nanosecond stamp falls in."""
    return F.call_function(
        "div", F.call_function("div", ts_ns, F.lit(NANOS_PER_SECOND)), F.lit(window_sec))


# Fixed value: the format of a ledger key.
LEDGER_KEY = "ratelimit:%s:%d"


def ledger_key(tenant: Column, window_idx: Column) -> Column:
    return F.format_string(LEDGER_KEY, tenant, window_idx)


def topic_or_default(topic: Column, default: str = "events") -> Column:
    return F.when(F.coalesce(topic, F.lit("")) == "", F.lit(default)).otherwise(topic)


def nanos_to_timestamp(ts_ns: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp, cut to Spark's microseconds."""
    return F.timestamp_micros(F.call_function("div", ts_ns, F.lit(1000)))


def timestamp_to_nanos(ts: Column) -> Column:
    return F.unix_micros(ts) * F.lit(1000)


def ntz_to_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp, whatever the session zone is."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def ntz_to_nanos(ts: Column) -> Column:
    return ntz_to_micros(ts) * F.lit(1000)

"""Every registered query: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions.keys import ledger_key, nanos_to_timestamp, with_event_defaults
from tidegate.functions.wire import decode_records
from tidegate.operators import acks, delivery, persistence, report
from tidegate.operators.capacity import batch_cap, row_cap
from tidegate.operators.leased import leased_admission
from tidegate.operators.quota import quota_admission, quota_ledger, with_quota_keys
from tidegate.operators.running import HOT_ROWS, find_slices
from tidegate.plans import streams, views
from tidegate.settings import Capacity, QuotaPolicy, SampleSettings
from tidegate.sources import deadletter, table as event_table, topic
from tidegate.sources.events import unpack_batches
from tidegate.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_SEC = 21_600
QUOTA = QuotaPolicy(limit=6, window_sec=WINDOW_SEC)
LEASED = QuotaPolicy(limit=6, lease=4, window_sec=WINDOW_SEC)
LEASED_IDLE = QuotaPolicy(limit=6, lease=4, window_sec=WINDOW_SEC, idle_ttl_sec=3600)
BATCH_QUOTA = QuotaPolicy(limit=40, window_sec=views.MONTH_SEC)
BATCH_LEASED = QuotaPolicy(limit=40, lease=10, window_sec=views.MONTH_SEC)
ROWS = Capacity(shards=4, buffer=40, min_per_shard=1)
BATCHES = Capacity(shards=4, buffer=80, min_per_shard=1)
ARRIVAL = ["timestamp", "seq"]
BATCH_ORDER = ["timestamp", "batch_id"]
HALF_NS = 1_705_287_600 * 1_000_000_000  # 2024-01-15 03:00 UTC, inside a window
PRIOR_SHIPDATE = "1996-01-01"


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_quota_keys(views.events(spark, sf_dir), QUOTA)


# --- quota ------------------------------------------------------------------------------------

def ingest_events(spark, sf_dir):
    ev = with_event_defaults(views.events(spark, sf_dir))
    return ev.select("event_id", "tenant_id", "payload", "timestamp",
                     F.unix_micros(nanos_to_timestamp(F.col("timestamp"))).alias("arrival_us"))


def quota_keys(spark, sf_dir):
    return _keyed(spark, sf_dir).select(
        "event_id", "tenant_id", "quota_tenant", "window_idx",
        ledger_key(F.col("quota_tenant"), F.col("window_idx")).alias("ledger_key"))


def _ack_columns(frame: DataFrame) -> DataFrame:
    return frame.select("event_id", "tenant_id", "quota_tenant", "window_idx", "accepted",
                        "message", "processed_at")


def _event_acks(spark, sf_dir, hot_rows=HOT_ROWS) -> DataFrame:
    admitted = quota_admission(_keyed(spark, sf_dir), QUOTA, ARRIVAL, hot_rows=hot_rows)
    return acks.event_acks(admitted, F.col("timestamp"))


def quota_admission_query(spark, sf_dir):
    return _ack_columns(_event_acks(spark, sf_dir))


def quota_admission_split(spark, sf_dir):
    """The same with every larger group cut into ranges, as hot groups are at scale."""
    return _ack_columns(_event_acks(spark, sf_dir, hot_rows=8))


def admission_rejects(spark, sf_dir):
    _, rejected = acks.split_accepted(_event_acks(spark, sf_dir))
    return rejected.select("event_id", "tenant_id", "payload", "message")


def quota_ledger_query(spark, sf_dir):
    return quota_ledger(_keyed(spark, sf_dir), QUOTA)


def quota_incremental(spark, sf_dir):
    """Two runs, the second on top of the ledger of the first."""
    ev = _keyed(spark, sf_dir)
    earlier, later = ev.where(F.col("timestamp") < HALF_NS), ev.where(F.col("timestamp") >= HALF_NS)
    first = quota_admission(earlier, QUOTA, ARRIVAL)
    second = quota_admission(later, QUOTA, ARRIVAL, ledger=quota_ledger(earlier, QUOTA))
    return _ack_columns(acks.event_acks(first.unionByName(second), F.col("timestamp")))


def _leased(spark, sf_dir, policy) -> DataFrame:
    return leased_admission(_keyed(spark, sf_dir), policy, ARRIVAL).select(
        "event_id", "quota_tenant", "window_idx", "admitted")


def quota_leased(spark, sf_dir):
    return _leased(spark, sf_dir, LEASED)


def quota_leased_idle(spark, sf_dir):
    return _leased(spark, sf_dir, LEASED_IDLE)


def quota_leased_weighted(spark, sf_dir):
    requests = views.batch_requests(spark, sf_dir)
    return leased_admission(requests, BATCH_LEASED, BATCH_ORDER, charge="n").select(
        "batch_id", "quota_tenant", "window_idx", "n", "admitted")


# --- batches, streams, capacity ---------------------------------------------------------------

def batch_unpack(spark, sf_dir):
    events = unpack_batches(views.batches(spark, sf_dir), ["batch_id", "part"])
    position = F.col("position") + F.col("part") * views.BATCH_EVENTS
    return events.withColumn("position", position.cast("int")).drop("part")


def _batch_acks(spark, sf_dir) -> DataFrame:
    return acks.batch_acks(views.batch_requests(spark, sf_dir), BATCH_QUOTA, BATCHES, BATCH_ORDER,
                           processed_at=F.col("timestamp"))


def batch_accepted_events(spark, sf_dir):
    """The events of the accepted prefix of every batch."""
    taken = _batch_acks(spark, sf_dir).where("accepted_count > 0").select(
        "batch_id", "accepted_count")
    first = F.col("part") * views.BATCH_EVENTS
    prefix = F.greatest(F.lit(0), F.least(F.size("events"), F.col("accepted_count") - first))
    parts = views.batches(spark, sf_dir).join(taken, "batch_id").withColumn(
        "prefix", prefix.cast("int"))
    return unpack_batches(parts, accepted="prefix").drop("position")


def batch_acks(spark, sf_dir):
    return _batch_acks(spark, sf_dir).select("batch_id", "quota_tenant", "n", "accepted", "accepted_count",
                      "rejected_count", "message", "processed_at")


def stream_acks(spark, sf_dir):
    """An event of a client stream counts as accepted if quota and buffers took it."""
    return acks.stream_acks(_capped_acks(spark, sf_dir), processed_at=F.col("timestamp"))


def _capped_acks(spark, sf_dir) -> DataFrame:
    """Quota first, then room in the buffers."""
    ev = _keyed(spark, sf_dir)
    slices = find_slices(ev, ["window_idx"], ARRIVAL)
    admitted = quota_admission(ev, QUOTA, ARRIVAL, slices=slices)
    buffered = row_cap(admitted, ROWS, "window_idx", ARRIVAL, F.col("admitted"), slices=slices)
    return acks.event_acks(buffered, F.col("timestamp"), buffered="buffered")


def event_acks(spark, sf_dir):
    return _ack_columns(_capped_acks(spark, sf_dir))


def accepted_records(spark, sf_dir):
    """Single events from intake to topic records."""
    accepted, _ = acks.split_accepted(_capped_acks(spark, sf_dir))
    return delivery.to_records(accepted).select(
        "topic", F.col("key").cast("string").alias("key"), F.hex("value").alias("value_hex"))


def row_cap_query(spark, sf_dir):
    return row_cap(_keyed(spark, sf_dir), ROWS, "window_idx", ARRIVAL).select(
        "event_id", "window_idx", "buffered")


def batch_cap_query(spark, sf_dir):
    requests = views.batch_requests(spark, sf_dir)
    return batch_cap(requests, BATCHES, "window_idx", BATCH_ORDER).select(
        "batch_id", "window_idx", "n", "batch_no", "shard", "accepted_count")


# --- records and dead letters -----------------------------------------------------------------

def broker_records(spark, sf_dir):
    ev = views.events(spark, sf_dir).withColumn(
        "topic", F.when(F.col("seq") % 5 == 0, "").otherwise("events-in"))
    out = delivery.to_records(ev, F.col("topic"))
    return out.select("topic", F.col("key").cast("string").alias("key"),
                      F.hex("value").alias("value_hex"))


def topic_round_trip(spark, sf_dir):
    """Published to a topic (files with a topic's columns) and read back."""
    path = scratch_path(spark, "topic")
    topic.publish(views.records(spark, sf_dir), format="parquet", path=path)
    back = topic.read_topic(spark, "events", format="parquet", path=path)
    return back.select("topic", F.col("key").cast("string").alias("key"),
                       F.hex("value").alias("value_hex"), F.unix_micros("time").alias("time_us"))


def decode_quarantine(spark, sf_dir):
    return decode_records(views.records(spark, sf_dir)).select(
        F.col("key").cast("string").alias("key"), "event_id", "tenant_id", "payload",
        "timestamp", F.col("error").isNull().alias("decoded"))


def dead_letter_lines(spark, sf_dir):
    return delivery.dead_letter_lines(views.failures(spark, sf_dir))


def dead_letter_replay(spark, sf_dir):
    """Failed records written as lines, read back and decoded."""
    path = scratch_path(spark, "dead-letters")
    ev = views.events(spark, sf_dir).where("event_type = 'error'")
    failed = delivery.to_records(ev, time=nanos_to_timestamp(F.col("timestamp"))).select(
        F.col("time").alias("failed_at"), "topic", F.col("key").cast("string").alias("key"),
        F.lit("timed out").alias("error"), "value")
    deadletter.append_dead_letters(failed, path)
    events, _ = deadletter.replay_dead_letters(spark, path)
    return events.select("event_id", "tenant_id", "payload", "timestamp")


def failure_counters(spark, sf_dir):
    return delivery.failure_counters(views.failures(spark, sf_dir))


# --- persistence ------------------------------------------------------------------------------

def constraint_quarantine(spark, sf_dir):
    checked = views.wide_keys(spark, sf_dir)
    good, bad = persistence.constraint_split(checked)
    return good.select("doc_id", "event_id", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("doc_id", "event_id", "reason"))


def persist_first_write(spark, sf_dir):
    first = persistence.first_write(views.deliveries(spark, sf_dir), views.DELIVERY_ORDER)
    return persistence.stored_rows(first).drop("created_at")


def _two_batches(spark, sf_dir):
    """Two deliveries into a fresh table; the first is delivered again at the end."""
    path = scratch_path(spark, "event-table")
    name = "tidegate_" + path[-12:]
    got = views.deliveries(spark, sf_dir)
    prior = F.col("l_shipdate") < F.lit(PRIOR_SHIPDATE).cast("timestamp_ntz")
    event_table.create_table(spark, name, path, buckets=8)
    counts = [event_table.insert_batch(part, name, i, views.DELIVERY_ORDER)
              for i, part in enumerate([got.where(prior), got.where(~prior)])]
    event_table.insert_batch(got.where(prior), name, 0, views.DELIVERY_ORDER)
    spark.sql(f"DROP TABLE {name}")
    return path, counts


def persist_incremental(spark, sf_dir):
    path, _ = _two_batches(spark, sf_dir)
    stored = spark.read.parquet(path)
    return stored.select("event_id", "tenant_id", "payload", "event_timestamp",
                         F.col("batch_id").cast("long").alias("batch_id"))


def persist_counts(spark, sf_dir):
    _, counts = _two_batches(spark, sf_dir)
    rows = [(i, c.attempted, c.inserted) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "batch_id long, attempted long, inserted long")


def table_compacted(spark, sf_dir):
    """Deliveries in four batches, merged after the third, of which the first comes again after
    that; then the fourth, another merge, and the replaced files deleted."""
    path = scratch_path(spark, "compacted")
    name = "tidegate_" + path[-12:]
    event_table.create_table(spark, name, path, buckets=8)
    year = F.year("l_shipdate")
    got = views.deliveries(spark, sf_dir).withColumn(
        "part", F.when(year < 1994, 0).when(year < 1996, 1).when(year < 1998, 2).otherwise(3))
    for part in range(4):
        rows = got.where(F.coalesce(F.col("part"), F.lit(0)) == part)
        event_table.insert_batch(rows, name, part, views.DELIVERY_ORDER)
        if part == 2:
            event_table.compact_table(spark, name)
            again = got.where(F.coalesce(F.col("part"), F.lit(0)) == 0)
            event_table.insert_batch(again, name, 0, views.DELIVERY_ORDER)
    event_table.compact_table(spark, name)
    event_table.vacuum_table(spark, name)
    return event_table.read_table(spark, name).select(
        "event_id", "tenant_id", "payload", "event_timestamp")


def backlog(spark, sf_dir):
    got = views.deliveries(spark, sf_dir)
    prior = F.col("l_shipdate") < F.lit(PRIOR_SHIPDATE).cast("timestamp_ntz")
    stored = persistence.first_write(got.where(prior), views.DELIVERY_ORDER)
    return persistence.backlog(got, stored)


# --- reports ----------------------------------------------------------------------------------

def outcome_report(spark, sf_dir):
    return report.outcome_report(_capped_acks(spark, sf_dir))


def outcome_counters(spark, sf_dir):
    """Counters over all intake: single events and batches."""
    outcomes = [acks.outcome_totals(_capped_acks(spark, sf_dir)),
                acks.batch_totals(_batch_acks(spark, sf_dir))]
    failed = delivery.failure_counters(views.failures(spark, sf_dir))
    return report.counter_set(outcomes, backlog(spark, sf_dir), failed)


def live_counters(spark, sf_dir):
    """The same counters, with those of intake from what the streams kept while they ran."""
    failed = delivery.failure_counters(views.failures(spark, sf_dir))
    return report.counter_set(streams.intake_totals(spark, sf_dir), backlog(spark, sf_dir), failed)


def load_summary(spark, sf_dir):
    elapsed = (F.max("started_us") - F.min("started_us")) / F.lit(1_000_000)
    return report.load_summary(views.calls(spark, sf_dir), elapsed)


def latency_ranks(spark, sf_dir):
    return report.latency_ranks(views.calls(spark, sf_dir), ["mode"])


def latency_of_runs(spark, sf_dir):
    """Ranks over the samples of several runs taken together."""
    calls = views.calls(spark, sf_dir).select("mode", "worker_id", "latency")
    runs = [calls.where(F.col("worker_id") % 3 == i) for i in range(3)]
    return report.latency_ranks(report.combine_runs(runs), ["mode"])


def latency_sample(spark, sf_dir):
    kept = report.latency_sample(views.calls(spark, sf_dir), ["mode", "worker_id"],
                                 views.CALL_ORDER, SampleSettings(step=10, cap=50))
    return kept.select("mode", "worker_id", "call_no", "sample_no", "latency")


QUERIES: dict[str, Query] = {
    "ingest_events": ingest_events,
    "quota_keys": quota_keys,
    "quota_admission": quota_admission_query,
    "quota_admission_split": quota_admission_split,
    "admission_rejects": admission_rejects,
    "quota_ledger": quota_ledger_query,
    "quota_incremental": quota_incremental,
    "quota_leased": quota_leased,
    "quota_leased_idle": quota_leased_idle,
    "quota_leased_weighted": quota_leased_weighted,
    "batch_unpack": batch_unpack,
    "batch_acks": batch_acks,
    "stream_acks": stream_acks,
    "event_acks": event_acks,
    "accepted_records": accepted_records,
    "batch_accepted_events": batch_accepted_events,
    "row_cap": row_cap_query,
    "batch_cap": batch_cap_query,
    "broker_records": broker_records,
    "topic_round_trip": topic_round_trip,
    "decode_quarantine": decode_quarantine,
    "dead_letter_lines": dead_letter_lines,
    "dead_letter_replay": dead_letter_replay,
    "failure_counters": failure_counters,
    "constraint_quarantine": constraint_quarantine,
    "persist_first_write": persist_first_write,
    "persist_incremental": persist_incremental,
    "persist_counts": persist_counts,
    "table_compacted": table_compacted,
    "backlog": backlog,
    "outcome_report": outcome_report,
    "outcome_counters": outcome_counters,
    "live_counters": live_counters,
    "load_summary": load_summary,
    "latency_ranks": latency_ranks,
    "latency_of_runs": latency_of_runs,
    "latency_sample": latency_sample,
    **streams.QUERIES,
}

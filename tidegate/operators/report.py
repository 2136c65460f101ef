"""Outcome, load and latency reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.running import (HOT_ROWS, broadcast_if_small, find_slices,
                                       running_total)
from tidegate.settings import SampleSettings

# The ranks of a latency report.
LATENCY_RANKS = (("p50", 0.50), ("p95", 0.95), ("p99", 0.99))


def outcome_report(acks: DataFrame, tenant: str = "tenant_id") -> DataFrame:
    """Events per tenant and acknowledgement message."""
    return acks.groupBy(tenant, "message").agg(F.count(F.lit(1)).alias("events"))


# The names of a run's counters, by the column that holds them.
OUTCOME_COUNTERS = {"accepted_total": "events_accepted_total",
                    "rejected_total": "events_rejected_total"}
BACKLOG_COUNTERS = {"depth": "worker_queue_depth"}
FAILURE_COUNTERS = {"publish_errors": "worker_publish_errors_total",
                    "async_errors": "kafka_async_errors_total",
                    "dead_lettered": "dlq_persisted_total"}


def counter_set(outcomes: list[DataFrame], waiting: DataFrame, failures: DataFrame) -> DataFrame:
    """The counters of a run as `(counter, value)` rows, from one-row totals (`outcome_totals`,
    `batch_totals`) of each kind of intake, the per-tenant backlog and `failure_counters`. Each
    source is read once: its counters are taken from its row together."""
    intake = reduce(DataFrame.unionByName, outcomes).agg(
        *[F.sum(c).alias(c) for c in OUTCOME_COUNTERS])
    depth = waiting.agg(F.coalesce(F.sum("waiting"), F.lit(0)).alias("depth"))

    def stacked(totals: DataFrame, names: dict[str, str]) -> DataFrame:
        pairs = [x for column, name in names.items()
                 for x in (F.lit(name), F.col(column).cast("long"))]
        return totals.select(F.stack(F.lit(len(names)), *pairs).alias("counter", "value"))

    return reduce(DataFrame.unionByName, [
        stacked(intake, OUTCOME_COUNTERS), stacked(depth, BACKLOG_COUNTERS),
        stacked(failures, FAILURE_COUNTERS)])


def load_summary(calls: DataFrame, elapsed_sec: Column) -> DataFrame:
    """Calls, events, rates and error share per mode.

    `calls` has `mode` ("unary", "batch" or "stream"), `ok`, `n_events` (events sent) and the
    acknowledged `accepted_count` and `rejected_count`. `elapsed_sec` is an aggregate.

    A unary call is one event. A batch call that is not fully accepted counts all its events
    as errors, and so does a stream that fails; otherwise the acknowledged counts are used.
    """
    ok, unary = F.col("ok"), F.col("mode") == "unary"
    good = F.when(~ok, 0).when(unary, 1).otherwise(F.col("accepted_count"))
    bad = (F.when(unary, F.when(ok, 0).otherwise(1))
           .when(ok, F.col("rejected_count")).otherwise(F.col("n_events")))
    totals = calls.groupBy("mode").agg(
        F.count(F.lit(1)).alias("total_rpcs"), F.count_if(ok).alias("ok_rpcs"),
        F.sum(good).cast("long").alias("ok_events"),
        F.sum(bad).cast("long").alias("error_events"),
        elapsed_sec.cast("double").alias("elapsed_sec"))
    events = F.col("ok_events") + F.col("error_events")
    elapsed = F.col("elapsed_sec")
    return totals.select(
        "mode", "total_rpcs", "ok_rpcs", (F.col("total_rpcs") - F.col("ok_rpcs")).alias("error_rpcs"),
        events.alias("total_events"), "ok_events", "error_events", "elapsed_sec",
        F.when(elapsed > 0, F.col("ok_events") / elapsed).alias("events_per_sec"),
        F.when(elapsed > 0, F.col("ok_rpcs") / elapsed).alias("rpcs_per_sec"),
        F.when(events > 0, F.col("error_events") / events * 100).otherwise(F.lit(0.0))
        .alias("error_pct"))


def latency_sample(calls: DataFrame, worker: list[str], order: list[str],
                   settings: SampleSettings = SampleSettings(),
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every `step`-th call of a worker, if it succeeded, up to `cap` kept per worker."""
    slices = find_slices(calls, worker, order, hot_rows)
    numbered = running_total(calls, worker, order, "call_no", slices=slices)
    kept = numbered.where((F.col("call_no") % settings.step == 0) & F.col("ok"))
    ranked = running_total(kept, worker, order, "sample_no", slices=slices)
    return ranked.where(F.col("sample_no") <= settings.cap)


def combine_runs(runs: list[DataFrame]) -> DataFrame:
    """The samples of several runs or workers as one table."""
    return reduce(DataFrame.unionByName, runs)


def approx_latency_ranks(samples: DataFrame, group: list[str], latency: str = "latency",
                         accuracy: int = 10_000) -> DataFrame:
    """The same report in one pass from mergeable sketches; ranks are off by up to n / accuracy."""
    ranks = F.percentile_approx(latency, [p for _, p in LATENCY_RANKS], accuracy)
    return samples.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        *[ranks[i].alias(name) for i, (name, _) in enumerate(LATENCY_RANKS)],
        F.max(latency).alias("max_latency"))


def latency_ranks(samples: DataFrame, group: list[str], latency: str = "latency",
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Latency at rank `floor(n * p)` (from 0) and the maximum, per group; exact.

    Equal latencies are counted before anything is sorted, and a group is sorted in ranges,
    so neither a frequent value nor a large group ends up in one task.
    """
    slices = find_slices(samples, group, [latency], hot_rows)
    values = samples.groupBy(*group, latency).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(values, group, [latency], "_upto", F.col("_n"), slices)
    sizes = broadcast_if_small(samples.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.max(latency).alias("max_latency")))
    position = {name: F.floor(F.col("n") * F.lit(p)).cast("long") for name, p in LATENCY_RANKS}
    named = sizes.withColumnsRenamed({g: f"_size_{g}" for g in group})
    same = [F.col(g).eqNullSafe(F.col(f"_size_{g}")) for g in group]
    return upto.join(named, same).groupBy(*group).agg(
        F.first("n").alias("n"),
        *[F.min(F.when(F.col("_upto") > position[name], F.col(latency))).alias(name)
          for name, _ in LATENCY_RANKS],
        F.first("max_latency").alias("max_latency"))

"""Quotas and capacity over streams, with what was used kept in small tables.

Each micro-batch runs the batch operators, so a hot tenant is spread over tasks as it is in a
batch. The state tables are written anew with every micro-batch; two copies take turns, because
a repeated batch needs the state before it. The rows of a batch are a folder named by it, so a
repeated batch replaces itself. All folders belong to one checkpoint, and a new checkpoint needs
new ones.

By default no window is forgotten, so the state grows by a row per tenant and window. With
`keep_windows` a tenant's windows that lie further back from its own newest one are closed: what
was used there is dropped, and rows that come for them later are written to `<out>-late` with the
reason instead of being charged. A closed window never gets a fresh quota, and a tenant's stamps
close no other tenant's windows. With `forgetting` the state holds only the tenants heard of lately
by the clock; what the others used waits in `<state>/forgotten`, and `<out>-sweeps` tells what each
micro-batch held and forgot. Together with `keep_windows`, each tenant's newest window stays.

With `counters`, each micro-batch leaves what it accepted and rejected in a folder of
`<out>-counters`, which it replaces when it comes again; `live_totals` adds them up at any time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.acks import (batch_ack_columns, batch_totals, event_acks,
                                     outcome_totals)
from tidegate.operators.capacity import batch_cap, batch_room, row_cap
from tidegate.operators.leased import (TOKENS_SCHEMA, USED_SCHEMA, LeaseState, leased_step,
                                       next_state)
from tidegate.operators.quota import quota_admission, quota_ledger
from tidegate.operators.running import broadcast_if_small
from tidegate.settings import Capacity, FlushSettings, QuotaPolicy
from tidegate.streaming.flush import with_trigger
from tidegate.streaming.forgetting import HEARD_SCHEMA, Forgetting, sweep_report

# State tables by name; a step maps (rows, state before) to (rows to write, state after). What both
# of these are made from it hands to `Keep`, so that it is worked out once per micro-batch.
State = dict[str, DataFrame]
Keep = Callable[[DataFrame], DataFrame]
Step = Callable[[DataFrame, State, Keep], tuple[DataFrame, State]]
# Accepted and rejected totals of the rows written and of those that came for closed windows.
Totals = Callable[[DataFrame, DataFrame | None], list[DataFrame]]

TOTALS_SCHEMA = "accepted_total long, rejected_total long"

CLOSED = "window closed"


class Horizon:
    """Which windows of a scope (a tenant, or everything) are closed: those more than `keep`
    before the newest that earlier micro-batches saw there."""

    def __init__(self, scope: str | None, window: str, keep: int | None) -> None:
        if keep is not None and keep < 0:
            raise ValueError(f"keep_windows must not be negative, got {keep}")
        self.scope, self.window, self.keep = scope, window, keep
        self.schemas = {} if keep is None else {"newest": "scope string, newest long"}

    def _scoped(self, rows: DataFrame) -> DataFrame:
        scope = F.lit("") if self.scope is None else F.col(self.scope)
        return rows.withColumn("_scope", scope)

    def split(self, rows: DataFrame, before: State) -> tuple[DataFrame, DataFrame | None]:
        """Rows of open windows, and those of closed ones with the `reason`."""
        if self.keep is None:
            return rows, None
        floors = broadcast_if_small(before["newest"].select(
            "scope", (F.col("newest") - self.keep).alias("_floor")))
        marked = self._scoped(rows).join(floors, F.col("_scope").eqNullSafe(F.col("scope")), "left")
        late = F.coalesce(F.col(self.window) < F.col("_floor"), F.lit(False))
        return (marked.where(~late).select(*rows.columns),
                marked.where(late).select(*rows.columns, F.lit(CLOSED).alias("reason")))

    def after(self, rows: DataFrame, used: DataFrame, before: State) -> tuple[DataFrame, State]:
        """What was used in windows that stay open, and the state of the horizon."""
        if self.keep is None:
            return used, {}
        newest = (self._scoped(rows).groupBy(F.col("_scope").alias("scope"))
                  .agg(F.max(self.window).alias("newest")).unionByName(before["newest"])
                  .groupBy("scope").agg(F.max("newest").alias("newest")))
        open_used = (self._scoped(used)
                     .join(newest, F.col("_scope").eqNullSafe(F.col("scope")))
                     .where(F.col(self.window) >= F.col("newest") - self.keep))
        return open_used.select(*used.columns), {"newest": newest}


def _start(events: DataFrame, step: Step, horizon: Horizon, schemas: dict[str, str], out: str,
           state: str, checkpoint: str, flush: FlushSettings, drain: bool,
           folder: str = "batch_id", forgetting: Forgetting | None = None,
           totals: Totals | None = None) -> StreamingQuery:
    schemas = schemas | horizon.schemas | ({} if forgetting is None else {"heard": HEARD_SCHEMA})

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = {
            name: spark.read.schema(schema).parquet(f"{state}/{name}/{(batch_id - 1) % 2}")
            if batch_id else spark.createDataFrame([], schema)
            for name, schema in schemas.items()}
        kept = []

        def keep(rows: DataFrame) -> DataFrame:
            kept.append(rows.persist())
            return kept[-1]

        batch = keep(batch)
        try:
            rows, late = horizon.split(batch, before)
            if late is not None:
                late.write.mode("overwrite").parquet(f"{out}-late/{folder}={batch_id}")
            heard, swept = {}, {}
            if forgetting is not None:
                before, swept, now = forgetting.sweep(batch, before, f"{state}/forgotten", batch_id)
                heard["heard"] = swept.pop("heard")
            rows, after = step(rows, before, keep)
            rows.write.mode("overwrite").parquet(f"{out}/{folder}={batch_id}")
            if totals is not None:
                written = spark.read.schema(rows.schema).parquet(f"{out}/{folder}={batch_id}")
                (_added(totals(written, late)).coalesce(1).write.mode("overwrite")
                 .parquet(f"{out}-counters/flush={batch_id}"))
            for name, table in (after | heard).items():
                table.write.mode("overwrite").parquet(f"{state}/{name}/{batch_id % 2}")
            if swept:
                held, used = (spark.read.schema(schemas[name])
                              .parquet(f"{state}/{name}/{batch_id % 2}")
                              for name in ("heard", "used"))
                (sweep_report(spark, batch_id, now, held, used, **swept)
                 .write.mode("overwrite").parquet(f"{out}-sweeps/flush={batch_id}"))
        finally:
            for rows in reversed(kept):
                rows.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, flush, drain).start()


def _added(totals: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, totals).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("accepted_total", "rejected_total")])


def live_totals(spark: SparkSession, out: str) -> DataFrame:
    """One row: what the micro-batches written so far accepted and rejected."""
    return _added([spark.read.schema(TOTALS_SCHEMA).parquet(f"{out}-counters")])


def _event_totals(acks: DataFrame, late: DataFrame | None) -> list[DataFrame]:
    return [outcome_totals(acks)] + ([] if late is None else [
        outcome_totals(late.withColumn("accepted", F.lit(False)))])


def _batch_totals(acks: DataFrame, late: DataFrame | None) -> list[DataFrame]:
    return [batch_totals(acks)] + ([] if late is None else [
        batch_totals(late.withColumns({"accepted_count": F.lit(0), "rejected_count": F.col("n")}))])


def start_quota(events: DataFrame, policy: QuotaPolicy, order: list[str], out: str, state: str,
                checkpoint: str, charge: str | None = None, arrival: str = "timestamp",
                processed_at: str | None = None, keep_windows: int | None = None,
                capacity: Capacity | None = None, forgetting: Forgetting | None = None,
                counters: bool = False,
                flush: FlushSettings = FlushSettings(), drain: bool = False) -> StreamingQuery:
    """The quota of `policy`, strict or leased, over a stream of events with quota keys;
    writes acknowledged events. `charge` names the tokens a row takes (default: one). With
    `capacity`, what the quota admits also needs room in the buffers of its window."""
    stamp = None if processed_at is None else F.col(processed_at)
    horizon = Horizon("quota_tenant", "window_idx", keep_windows)
    totals = _event_totals if counters else None
    room_schema = {} if capacity is None else {"room": "window_idx long, used long"}

    def acknowledged(admitted: DataFrame, before: State, keep: Keep) -> tuple[DataFrame, State]:
        if capacity is None:
            return event_acks(admitted, stamp), {}
        admitted = keep(admitted)
        flagged = row_cap(admitted, capacity, "window_idx", order, F.col("admitted"),
                          taken=before["room"])
        taken = (admitted.where("admitted").groupBy("window_idx")
                 .agg(F.count(F.lit(1)).alias("used")).unionByName(before["room"])
                 .groupBy("window_idx").agg(F.sum("used").alias("used"))
                 .withColumn("used", F.least("used", F.lit(capacity.total).cast("long"))))
        return event_acks(flagged, stamp, buffered="buffered"), {"room": taken}

    def strict(batch: DataFrame, before: State, keep: Keep) -> tuple[DataFrame, State]:
        weight = None if charge is None else F.col(charge)
        admitted = quota_admission(batch, policy, order, before["used"], weight)
        used = quota_ledger(batch, policy, weight, before["used"])
        used, newest = horizon.after(batch, used, before)
        rows, room = acknowledged(admitted, before, keep)
        return rows, {"used": used, **newest, **room}

    def leased(batch: DataFrame, before: State, keep: Keep) -> tuple[DataFrame, State]:
        held = LeaseState(before["tokens"], before["used"])
        admitted, outcomes = leased_step(batch, policy, order, charge, arrival, held)
        after = next_state(batch, outcomes, policy, held, charge, arrival)
        used, newest = horizon.after(batch, after.used, before)
        rows, room = acknowledged(admitted, before, keep)
        return rows, {"tokens": after.tokens, "used": used, **newest, **room}

    if policy.lease == 1:
        return _start(events, strict, horizon, {"used": USED_SCHEMA} | room_schema, out, state,
                      checkpoint, flush, drain, forgetting=forgetting, totals=totals)
    return _start(events, leased, horizon,
                  {"tokens": TOKENS_SCHEMA, "used": USED_SCHEMA} | room_schema, out, state,
                  checkpoint, flush, drain, forgetting=forgetting, totals=totals)


def start_row_cap(events: DataFrame, capacity: Capacity, interval: str, order: list[str],
                  out: str, state: str, checkpoint: str, keep_intervals: int | None = None,
                  flush: FlushSettings = FlushSettings(), drain: bool = False) -> StreamingQuery:
    """Bounded intake over a stream: what does not fit its interval is written as not
    `buffered`, never held back. With `keep_intervals` the newest stamp of all closes the
    intervals before it, so stamps should be checked first."""
    horizon = Horizon(None, interval, keep_intervals)

    def step(batch: DataFrame, before: State, keep: Keep) -> tuple[DataFrame, State]:
        flagged = row_cap(batch, capacity, interval, order, taken=before["taken"])
        used = (batch.groupBy(interval).agg(F.count(F.lit(1)).alias("used"))
                .unionByName(before["taken"]).groupBy(interval).agg(F.sum("used").alias("used"))
                .withColumn("used", F.least("used", F.lit(capacity.total).cast("long"))))
        used, newest = horizon.after(batch, used, before)
        return flagged, {"taken": used, **newest}

    return _start(events, step, horizon, {"taken": f"{interval} long, used long"}, out, state,
                  checkpoint, flush, drain)


def start_batch_acks(requests: DataFrame, policy: QuotaPolicy, capacity: Capacity,
                     order: list[str], out: str, state: str, checkpoint: str,
                     processed_at: str | None = None, keep_windows: int | None = None,
                     counters: bool = False, flush: FlushSettings = FlushSettings(),
                     drain: bool = False) -> StreamingQuery:
    """Acknowledgements of a stream of batches with quota keys and the size `n`, under the strict
    quota and the buffers of each window. The state is what each tenant's window used, and how many
    batches and events each window's shards got. `keep_windows` closes windows behind the newest
    of all, so stamps should be checked first. Folders are named `flush`, as rows may have a
    `batch_id` of their own."""
    stamp = None if processed_at is None else F.col(processed_at)
    horizon = Horizon(None, "window_idx", keep_windows)

    def step(batch: DataFrame, before: State, keep: Keep) -> tuple[DataFrame, State]:
        charged = quota_admission(batch, policy, order, before["used"], F.col("n"))
        placed = keep(batch_cap(charged, capacity, "window_idx", order, taking=F.col("admitted"),
                                taken=before["room"]))
        used = quota_ledger(batch, policy, F.col("n"), before["used"])
        room = batch_room(placed, capacity, "window_idx", taken=before["room"])
        used, newest = horizon.after(batch, used, before)
        room, _ = horizon.after(batch, room, before)
        return (batch_ack_columns(placed, batch.columns, stamp),
                {"used": used, "room": room, **newest})

    return _start(requests, step, horizon, {
        "used": USED_SCHEMA, "room": "window_idx long, shard long, batches long, used long"},
        out, state, checkpoint, flush, drain, folder="flush",
        totals=_batch_totals if counters else None)

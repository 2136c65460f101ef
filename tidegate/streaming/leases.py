"""Quotas over streams with the tokens of each tenant in keyed state.

Low latency: rows are answered by the state of their tenant, without a state table being read
and written. No window is forgotten unless `keep_windows` closes those further back from the
tenant's own newest one; rows that come for a closed window are denied and marked `late`, so that
none gets a fresh quota. A tenant's rows of one micro-batch come chunk by chunk, and only those that its
windows can still admit are kept until the end; `admission.start_quota` spreads a hot tenant
over tasks as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegate.functions.keys import NANOS_PER_SECOND
from tidegate.session import ROCKSDB_PROVIDER
from tidegate.settings import QuotaPolicy

MIN_SORT = 50_000

# Settings that the session of a query with keyed state needs. With a time to live, Spark would
# otherwise run empty micro-batches for ever, and a draining query would not end.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def serve(n: np.ndarray, tokens: int, used: int, limit: int, lease: int) -> tuple[int, int, int]:
    """Positive charges of one window in order: how many are admitted, then tokens and quota
    used afterwards."""
    total = np.cumsum(n)
    level = tokens
    while True:
        at = int(np.searchsorted(total, level, "right"))
        if at == len(n):
            return at, int(level - total[-1]), used
        granted = min(limit - used, max(lease, int(n[at])))
        used += granted
        if granted < n[at]:
            return at, 0, used
        level = int(total[at] - n[at]) + granted


def _answer(rows: pd.DataFrame, admitted, late: bool | None) -> pd.DataFrame:
    rows = rows.drop(columns="_n").assign(admitted=admitted)
    return rows if late is None else rows.assign(late=late)


class LeaseState(StatefulProcessor):
    """Tokens and last access of a tenant, and the quota used in its latest windows."""

    def __init__(self, policy: QuotaPolicy, order: list[str], arrival: str, charge: str | None,
                 state_ttl_sec: int | None, keep_windows: int | None) -> None:
        self.keep = keep_windows
        self.on_time = None if keep_windows is None else False
        self.policy, self.order, self.arrival, self.charge = policy, order, arrival, charge
        self.ttl_ms = None if state_ttl_sec is None else state_ttl_sec * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState(
            "bucket", T.StructType([T.StructField("tokens", T.LongType()),
                                    T.StructField("last_access", T.LongType())]), self.ttl_ms)
        # What was used outlives the bucket: a tenant that comes back gets no second quota.
        self.newest = handle.getValueState(
            "newest", T.StructType([T.StructField("window_idx", T.LongType())]))
        self.used = handle.getMapState(
            "used", T.StructType([T.StructField("window_idx", T.LongType())]),
            T.StructType([T.StructField("used", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        kept, pending, waiting = None, [], 0
        floor = None
        if self.keep is not None and self.newest.exists():
            floor = self.newest.get()[0] - self.keep
        for chunk in rows:
            chunk = chunk.assign(_n=1 if self.charge is None else chunk[self.charge])
            if floor is not None and (chunk["window_idx"] < floor).any():
                closed = chunk["window_idx"] < floor
                yield _answer(chunk[closed], False, True)
                chunk = chunk[~closed]
            paying = chunk["_n"] > 0
            if not paying.all():
                yield _answer(chunk[~paying], True, self.on_time)
                chunk = chunk[paying]
            pending.append(chunk)
            waiting += len(chunk)
            # Sorting waits until there is as much new as kept, so that its cost stays linear.
            if waiting > max(MIN_SORT, 0 if kept is None else len(kept)):
                kept, late = self._admissible([kept, *pending])
                pending, waiting = [], 0
                yield _answer(late, False, self.on_time)
        if kept is None and not pending:
            return
        kept, late = self._admissible([kept, *pending])
        yield _answer(late, False, self.on_time)
        if len(kept):
            yield _answer(kept, self._charge(
                kept["_n"].to_numpy(np.int64), kept["window_idx"].to_numpy(np.int64),
                kept[self.arrival].to_numpy(np.int64) // NANOS_PER_SECOND), self.on_time)

    def _admissible(self, parts: list[pd.DataFrame | None]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Rows in order, and apart from them those that begin beyond what their window can
        admit at most. The latter are denied; by then their tenant holds no tokens."""
        rows = pd.concat([p for p in parts if p is not None]).sort_values(
            self.order, ignore_index=True)
        ahead = rows.groupby("window_idx")["_n"].cumsum() - rows["_n"]
        most = self.policy.limit + min(self.policy.lease, self.policy.limit) - 1
        late = ahead > most
        return rows[~late], rows[late]

    def _charge(self, n: np.ndarray, window: np.ndarray, second: np.ndarray) -> np.ndarray:
        policy = self.policy
        tokens, last = self.bucket.get() if self.bucket.exists() else (0, None)
        newest = self.newest.get()[0] if self.newest.exists() else None
        used = {k[0]: v[0] for k, v in self.used.iterator()}
        admitted = np.zeros(len(n), dtype=bool)
        idle = np.zeros(len(n), dtype=bool)
        if policy.idle_ttl_sec is not None:
            before = np.concatenate([[second[0] if last is None else last], second[:-1]])
            idle = second - before > policy.idle_ttl_sec
        # Stretches of one window without an idle break.
        starts = np.flatnonzero(np.concatenate([[True], np.diff(window) != 0]) | idle)
        for start, end in zip(starts, [*starts[1:], len(n)]):
            idx = int(window[start])
            taken, tokens, used[idx] = serve(n[start:end], 0 if idle[start] else int(tokens),
                                             int(used.get(idx, 0)), policy.limit, policy.lease)
            admitted[start:start + taken] = True
        newest = int(window.max() if newest is None else max(newest, window.max()))
        self.bucket.update((int(tokens), int(second[-1])))
        self.newest.update((newest,))
        for idx, value in used.items():
            if self.keep is None or idx >= newest - self.keep:
                self.used.updateValue((idx,), (value,))
            elif self.used.containsKey((idx,)):
                self.used.removeKey((idx,))
        return admitted

    def close(self) -> None:
        pass


def leased_quota(events: DataFrame, policy: QuotaPolicy, order: list[str],
                 arrival: str = "timestamp", charge: str | None = None,
                 state_ttl_sec: int | None = None,
                 keep_windows: int | None = None) -> DataFrame:
    """Add `admitted` to a stream of events with quota keys, and with `keep_windows` also
    `late`. Lease 1 is the strict policy.

    `state_ttl_sec` drops the tokens of tenants not heard of for that long by the clock, never what
    they used; the policy's idle limit works on arrival times instead. The session needs the
    settings in `KEYED_STATE`.
    """
    added = ["admitted"] if keep_windows is None else ["admitted", "late"]
    schema = T.StructType([*events.schema.fields,
                           *[T.StructField(name, T.BooleanType()) for name in added]])
    return events.groupBy("quota_tenant").transformWithStateInPandas(
        LeaseState(policy, order, arrival, charge, state_ttl_sec, keep_windows),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None" if state_ttl_sec is None else "ProcessingTime")

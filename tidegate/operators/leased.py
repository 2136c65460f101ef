"""Leased quotas: tokens are taken `lease` at a time and unused ones serve later windows.

What a window hands to the next one of its tenant is a single number, the tokens left, and it
is below `min(lease, limit)`. A window is thus a small table "tokens brought in -> tokens
handed on". Tables are composed over spans of windows, spans over longer spans, and the start
value of every span is read back down. No task sees more than `SPAN` windows, or spans, of a
tenant, however long its history and however many events it sent.

Within a window the first denial is the last word: the lease that failed has used up the
limit. The admitted rows are therefore a prefix, described by one total per window, and the
rows are flagged by `admit_within`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.functions.keys import NANOS_PER_SECOND
from tidegate.operators.quota import QUOTA_KEYS, admit_within
from tidegate.operators.running import HOT_ROWS, Slices, find_slices, running_total
from tidegate.session import freeze
from tidegate.settings import QuotaPolicy

SPAN = 1024

TOKENS_SCHEMA = "quota_tenant string, tokens long, last_second long"
USED_SCHEMA = "quota_tenant string, window_idx long, used long"
OUTCOME_SCHEMA = ("quota_tenant string, window_idx long, session long, allowed long, "
                  "tokens long, used long")


@dataclass(frozen=True)
class LeaseState:
    """What earlier runs left: `tokens` per tenant with its last access, and quota `used` per
    tenant and window (see `TOKENS_SCHEMA`, `USED_SCHEMA`)."""

    tokens: DataFrame
    used: DataFrame


# --- composing windows into spans -------------------------------------------------------------

def _sorted(table: pa.Table, *by: str) -> pa.Table:
    return table.sort_by([(name, "ascending") for name in by])


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _lists(table: pa.Table, name: str) -> list[np.ndarray]:
    return [row.values.to_numpy() for row in table.column(name)]


def _one_link(table: pa.Table, group: str, link: np.ndarray) -> pa.Table:
    return pa.table({"quota_tenant": table.column("quota_tenant")[:1],
                     group: table.column(group)[:1],
                     "link": pa.array([link], pa.list_(pa.int32()))})


def _compose(links: DataFrame, child: str, parent: str) -> DataFrame:
    """One table per `(quota_tenant, parent)` from the tables of its children."""

    def fold(rows: pa.Table) -> pa.Table:
        composed = None
        for link in _lists(_sorted(rows, child), "link"):
            composed = link if composed is None else link[composed]
        return _one_link(rows, parent, composed)

    return (links.withColumn(parent, F.expr(f"{child} div {SPAN}"))
            .groupBy("quota_tenant", parent)
            .applyInArrow(fold, f"quota_tenant string, {parent} long, link array<int>"))


def _descend(links: DataFrame, child: str, group: list[str]) -> DataFrame:
    """Tokens brought into each child, from `brought` of the group it lies in."""

    def walk(rows: pa.Table) -> pa.Table:
        rows = _sorted(rows, child)
        tokens, brought = rows.column("brought")[0].as_py(), []
        for link in _lists(rows, "link"):
            brought.append(tokens)
            tokens = int(link[tokens])
        return rows.select(["quota_tenant", child]).append_column(
            "brought", pa.array(brought, pa.int64()))

    return links.groupBy(*group).applyInArrow(
        walk, f"quota_tenant string, {child} long, brought long")


def _held(state: LeaseState | None, rows: DataFrame) -> DataFrame:
    """Add `brought`, the tokens that earlier runs left to the tenant."""
    if state is None:
        return rows.withColumn("brought", F.lit(0).cast("long"))
    held = state.tokens.select("quota_tenant", F.col("tokens").alias("brought"))
    return rows.join(held, "quota_tenant", "left").fillna(0, ["brought"])


def _brought_into_spans(span_links: DataFrame, state: LeaseState | None) -> DataFrame:
    """Tokens each tenant brings into each of its spans of `SPAN` windows."""
    long_links = _held(state, _compose(span_links, "span", "long_span"))
    starts = _descend(long_links, "long_span", ["quota_tenant"])
    inside = (span_links.withColumn("long_span", F.expr(f"span div {SPAN}"))
              .join(starts, ["quota_tenant", "long_span"]))
    return _descend(inside, "span", ["quota_tenant", "long_span"])


def _through_spans(cells: DataFrame, table, read, state: LeaseState | None) -> DataFrame:
    """Outcome of every cell: `table` folds the cells of a span into its link, `read` follows
    them once the tokens brought into the span are known.

    A tenant within one span starts from what it holds and needs no links.
    """
    # Read several times, and far smaller than the events behind it.
    spans = freeze(cells.withColumn("span", F.expr(f"window_idx div {SPAN}")))
    long_lived = (spans.groupBy("quota_tenant")
                  .agg(F.min("span").alias("_first"), F.max("span").alias("_last"))
                  .where("_first < _last").select("quota_tenant"))

    def link(rows: pa.Table) -> pa.Table:
        return _one_link(rows, "span", table(rows))

    links = freeze(
        spans.join(long_lived, "quota_tenant", "left_semi").groupBy("quota_tenant", "span")
        .applyInArrow(link, "quota_tenant string, span long, link array<int>"))
    starts = _brought_into_spans(links, state).withColumnRenamed("brought", "_start")
    return (_held(state, spans).join(starts, ["quota_tenant", "span"], "left")
            .withColumn("brought", F.coalesce("_start", "brought")).drop("_start")
            .groupBy("quota_tenant", "span").applyInArrow(read, OUTCOME_SCHEMA))


def _outcome(rows: pa.Table, sessions, outcomes: list[tuple[int, int, int]]) -> pa.Table:
    allowed, tokens, used = (pa.array(c, pa.int64()) for c in zip(*outcomes))
    return pa.table({"quota_tenant": rows.column("quota_tenant"),
                     "window_idx": rows.column("window_idx"), "session": sessions,
                     "allowed": allowed, "tokens": tokens, "used": used})


def _with_used(cells: DataFrame, state: LeaseState | None) -> DataFrame:
    """Add `before`, the quota that earlier runs used in the cell's window."""
    if state is None:
        return cells.withColumn("before", F.lit(0).cast("long"))
    before = state.used.select(*QUOTA_KEYS, F.col("used").alias("before"))
    return cells.join(before, QUOTA_KEYS, "left").fillna(0, ["before"])


# --- idle tenants -----------------------------------------------------------------------------

def _second(arrival: str) -> Column:
    return F.expr(f"{arrival} div {NANOS_PER_SECOND}")


def _bucket(policy: QuotaPolicy, arrival: str) -> Column:
    return F.expr(f"({arrival} div {NANOS_PER_SECOND}) div {policy.idle_ttl_sec}")


def idle_sessions(events: DataFrame, policy: QuotaPolicy, arrival: str,
                  state: LeaseState | None = None) -> DataFrame:
    """Counts per tenant, window and idle bucket, with the `session` each lies in (named by
    the bucket that opened it); `fresh` marks the cell in which the session opens.

    A bucket is as long as the idle limit: two events of one bucket are never further apart
    than it, so only neighbouring cells have to be compared. The comparison runs within
    blocks of `SPAN` buckets; a block learns of the time before it from one row per block.
    """
    ttl = policy.idle_ttl_sec
    cells = (
        events.groupBy(*QUOTA_KEYS, _bucket(policy, arrival).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(_second(arrival)).alias("_first"),
             F.max(_second(arrival)).alias("_last"))
        .withColumn("_block", F.expr(f"bucket div {SPAN}")))
    in_block = Window.partitionBy("quota_tenant", "_block").orderBy("bucket", "window_idx")
    gap = F.col("_first") - F.lag("_last").over(in_block)
    cells = cells.withColumn("_opened", F.when(gap > ttl, F.col("bucket")))

    blocks = cells.groupBy("quota_tenant", "_block").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.min("bucket").alias("_start"), F.max("_opened").alias("_opened"))
    by_block = Window.partitionBy("quota_tenant").orderBy("_block")
    seen = F.lag("_last").over(by_block)
    if state is not None:
        known = state.tokens.select("quota_tenant", F.col("last_second").alias("_known"))
        blocks = blocks.join(known, "quota_tenant", "left")
        seen = F.coalesce(seen, F.col("_known"))
    blocks = (
        blocks
        .withColumn("_broke", F.when(F.coalesce(F.col("_first") - seen > ttl, F.lit(True)),
                                     F.col("_start")))
        # Without a break the first session of all goes on from the state's.
        .withColumn("_opened", F.coalesce("_opened", "_broke"))
        .withColumn("_inherited", F.coalesce("_broke", F.last("_opened", ignorenulls=True).over(
            by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
        .select("quota_tenant", "_block", "_broke", "_inherited"))

    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_of_block = F.row_number().over(in_block) == 1
    return cells.join(blocks, ["quota_tenant", "_block"]).select(
        *QUOTA_KEYS, "bucket", "n",
        F.coalesce(F.last("_opened", ignorenulls=True).over(so_far), "_inherited")
        .alias("session"),
        (F.col("_opened").isNotNull() | (first_of_block & F.col("_broke").isNotNull()))
        .alias("fresh"))


# --- unit charges -----------------------------------------------------------------------------

def _unit_step(n: int, tokens, used, limit: int, lease: int):
    """`n` unit requests against tokens held and quota used; works on numbers and arrays.

    Returns the requests admitted, the tokens left and the quota used afterwards.
    """
    covered = np.minimum(n, tokens)
    asked = n - covered
    served = np.minimum(asked, limit - used)
    leased = np.minimum(-(-served // lease) * lease, limit - used)
    left = np.where(asked > 0, leased - served, tokens - covered)
    return covered + served, left, used + leased


def unit_outcomes(segments: DataFrame, policy: QuotaPolicy,
                  state: LeaseState | None = None) -> DataFrame:
    """Requests `allowed`, and tokens and quota used afterwards, of each tenant, window and
    session, from their counts `n`; `fresh` segments start without tokens."""
    limit, lease, size = policy.limit, policy.lease, min(policy.lease, policy.limit)

    def steps(rows: pa.Table):
        rows = _sorted(rows, "window_idx", "session")
        return rows, zip(*(rows.column(c).to_pylist()
                           for c in ("window_idx", "n", "fresh", "before")))

    def table(rows: pa.Table) -> np.ndarray:
        tokens, used, window = np.arange(size), 0, None
        for idx, n, fresh, before in steps(rows)[1]:
            if idx != window:
                used, window = np.full(size, before), idx
            _, tokens, used = _unit_step(n, np.zeros_like(tokens) if fresh else tokens, used,
                                         limit, lease)
        return tokens

    def read(rows: pa.Table) -> pa.Table:
        rows, cells = steps(rows)
        tokens, used, window, out = rows.column("brought")[0].as_py(), 0, None, []
        for idx, n, fresh, before in cells:
            if idx != window:
                used, window = before, idx
            allowed, tokens, used = map(int, _unit_step(n, 0 if fresh else tokens, used, limit,
                                                        lease))
            out.append((allowed, tokens, used))
        return _outcome(rows, rows.column("session"), out)

    return _through_spans(_with_used(segments, state), table, read, state)


# --- weighted charges -------------------------------------------------------------------------

def _lease_runs(n: np.ndarray, fresh: np.ndarray, used: int, limit: int, lease: int, size: int):
    """What a window does, by the request at which the tokens brought in run out.

    Returns the running charge at which that request moves on (one entry per request that
    tokens brought in may cover), then for each such request the tokens left, the charge
    admitted and the quota used, and the window's total if the tokens may cover all of it
    (else -1).
    """
    total = np.cumsum(n)
    count = len(n)
    # The first reset after a request, or the end of the window.
    resets = np.append(np.flatnonzero(fresh), count)

    def runs_out(level, at):
        return np.minimum(np.searchsorted(total, level, "right"),
                          resets[np.searchsorted(resets, at, "right")])

    reach = min(int(np.searchsorted(total, size - 1, "right")), int(resets[0]))
    at = np.arange(min(reach + 1, count))
    spent = np.full(len(at), used, dtype=np.int64)
    left, admitted = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    open_runs = np.arange(len(at))
    while len(open_runs):
        here = at[open_runs]
        granted = np.minimum(limit - spent[open_runs], np.maximum(lease, n[here]))
        spent[open_runs] += granted
        before = total[here] - n[here]
        denied = granted < n[here]
        admitted[open_runs[denied]] = before[denied]
        open_runs, here, level = open_runs[~denied], here[~denied], (before + granted)[~denied]
        following = runs_out(level, here)
        ended = following == count
        left[open_runs[ended]] = level[ended] - total[-1]
        admitted[open_runs[ended]] = total[-1]
        at[open_runs] = following
        open_runs = open_runs[~ended]
    covers_all = reach == count
    return total[:reach], left, admitted, spent, int(total[-1]) if covers_all else -1


# The table of a window as a row: the levels, then what follows at each of them.
WINDOW_SCHEMA = ("quota_tenant string, window_idx long, levels array<long>, left array<long>, "
                 "admitted array<long>, spent array<long>, total long, before long")


def _window_table(limit: int, lease: int, size: int):
    def table(rows: pa.Table) -> pa.Table:
        rows = _sorted(rows, "_used")
        bucket = _numbers(rows, "bucket")
        # Rows come in order, so a bucket's first row is where the bucket changes.
        opens = np.concatenate([[True], bucket[1:] != bucket[:-1]]) & np.asarray(
            rows.column("fresh").to_pylist(), bool)
        before = rows.column("before")[0].as_py()
        levels, left, admitted, spent, total = _lease_runs(
            _numbers(rows, "_n"), opens, before, limit, lease, size)
        lists = {"levels": levels, "left": left, "admitted": admitted, "spent": spent}
        return pa.table({
            "quota_tenant": rows.column("quota_tenant")[:1],
            "window_idx": rows.column("window_idx")[:1],
            **{name: pa.array([v], pa.list_(pa.int64())) for name, v in lists.items()},
            "total": pa.array([total], pa.int64()), "before": pa.array([before], pa.int64())})

    return table


def _through_window(tokens, levels, left, admitted, spent, total: int, before: int):
    """Charge admitted, and tokens and quota used afterwards, for the tokens brought in (a
    number or an array)."""
    at = np.searchsorted(levels, tokens, "right")
    inside = at < len(left)
    known = np.minimum(at, len(left) - 1)
    return (np.where(inside, admitted[known], total), np.where(inside, left[known], tokens - total),
            np.where(inside, spent[known], before))


def charge_outcomes(requests: DataFrame, policy: QuotaPolicy, order: list[str], charge: str,
                    arrival: str, slices: Slices, state: LeaseState | None = None) -> DataFrame:
    """Charge `allowed`, and tokens and quota used afterwards, of each tenant and window."""
    limit, lease, size = policy.limit, policy.lease, min(policy.lease, policy.limit)
    paying = requests.where(F.col(charge) > 0).select(
        *dict.fromkeys([*QUOTA_KEYS, *order, arrival]), F.col(charge).cast("long").alias("_n"))
    total = running_total(paying, QUOTA_KEYS, order, "_used", F.col("_n"), slices)
    # Beyond the upper bound every request is denied, so a window needs no more than these.
    near = total.where(F.col("_used") - F.col("_n") <= _most(policy))
    if policy.idle_ttl_sec is None:
        near = near.withColumns({"bucket": F.lit(0).cast("long"), "fresh": F.lit(False)})
    else:
        opening = idle_sessions(paying, policy, arrival, state).where("fresh").select(
            *QUOTA_KEYS, "bucket", "fresh")
        near = (near.withColumn("bucket", _bucket(policy, arrival))
                .join(opening, [*QUOTA_KEYS, "bucket"], "left").fillna(False, ["fresh"]))
    windows = (
        _with_used(near.select(*QUOTA_KEYS, "_used", "_n", "bucket", "fresh"), state)
        .groupBy(*QUOTA_KEYS)
        .applyInArrow(_window_table(limit, lease, size), WINDOW_SCHEMA))

    def windows_of(rows: pa.Table):
        return zip(*(_lists(rows, c) for c in ("levels", "left", "admitted", "spent")),
                   rows.column("total").to_pylist(), rows.column("before").to_pylist())

    def table(rows: pa.Table) -> np.ndarray:
        tokens = np.arange(size)
        for window in windows_of(_sorted(rows, "window_idx")):
            _, tokens, _ = _through_window(tokens, *window)
        return tokens

    def read(rows: pa.Table) -> pa.Table:
        rows = _sorted(rows, "window_idx")
        tokens, out = rows.column("brought")[0].as_py(), []
        for window in windows_of(rows):
            allowed, tokens, used = map(int, _through_window(tokens, *window))
            out.append((allowed, tokens, used))
        return _outcome(rows, pa.array([0] * len(rows), pa.int64()), out)

    return _through_spans(windows, table, read, state)


# --- admission --------------------------------------------------------------------------------

def _most(policy: QuotaPolicy) -> int:
    """Upper bound of what one window can admit: the limit and the tokens brought in."""
    return policy.limit + min(policy.lease, policy.limit) - 1


def _flag(rows: DataFrame, allowances: DataFrame, keys: list[str], policy: QuotaPolicy,
          order: list[str], charge: Column | None, slices: Slices | None,
          hot_rows: int) -> DataFrame:
    """What is not allowed counts as already taken from the upper bound."""
    reserved = allowances.select(
        *keys, (F.lit(_most(policy)).cast("long") - F.col("allowed")).alias("amount"))
    return admit_within(rows, keys, order, _most(policy), charge, reserved, slices, hot_rows)


def leased_step(rows: DataFrame, policy: QuotaPolicy, order: list[str],
                charge: str | None = None, arrival: str = "timestamp",
                state: LeaseState | None = None,
                hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows with quota keys flagged `admitted`, and the outcome per tenant, window and session
    (`OUTCOME_SCHEMA`), which `next_state` needs."""
    if charge is not None:
        slices = find_slices(rows, QUOTA_KEYS, order, hot_rows)
        outcomes = charge_outcomes(rows, policy, order, charge, arrival, slices, state)
        outcomes = outcomes if state is None else freeze(outcomes)
        return _flag(rows, outcomes, QUOTA_KEYS, policy, order, F.col(charge), slices,
                     hot_rows), outcomes
    if policy.idle_ttl_sec is None:
        segments = rows.groupBy(*QUOTA_KEYS).agg(F.count(F.lit(1)).alias("n")).withColumns(
            {"session": F.lit(0).cast("long"), "fresh": F.lit(False)})
        outcomes = unit_outcomes(segments, policy, state)
        outcomes = outcomes if state is None else freeze(outcomes)
        return _flag(rows, outcomes, QUOTA_KEYS, policy, order, None, None, hot_rows), outcomes

    cells = freeze(idle_sessions(rows, policy, arrival, state))
    segment = [*QUOTA_KEYS, "session"]
    segments = cells.groupBy(*segment).agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh"))
    outcomes = unit_outcomes(segments, policy, state)
    outcomes = outcomes if state is None else freeze(outcomes)
    # The first buckets of a segment are served first. A bucket lies in one session, so rows
    # can be flagged per bucket.
    earlier = Window.partitionBy(*segment).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    left = F.col("allowed") - F.coalesce(F.sum("n").over(earlier), F.lit(0))
    allowed = (cells.join(outcomes.select(*segment, "allowed"), segment)
               .withColumn("allowed", F.greatest(F.lit(0), F.least(left, F.col("n")))))
    marked = rows.withColumn("bucket", _bucket(policy, arrival))
    return _flag(marked, allowed, [*QUOTA_KEYS, "bucket"], policy, order, None, None,
                 hot_rows).drop("bucket"), outcomes


def leased_admission(rows: DataFrame, policy: QuotaPolicy, order: list[str],
                     charge: str | None = None, arrival: str = "timestamp",
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Leased quota over rows with quota keys; adds `admitted`.

    A row charges one token, or with `charge` that many, whole or not at all. With an idle
    limit in the policy, a tenant idle for longer than that starts with nothing.
    """
    return leased_step(rows, policy, order, charge, arrival, hot_rows=hot_rows)[0]


def next_state(rows: DataFrame, outcomes: DataFrame, policy: QuotaPolicy, state: LeaseState,
               charge: str | None = None, arrival: str = "timestamp") -> LeaseState:
    """The state after `rows`. Only tenants without tokens are forgotten: whether a tenant was
    idle is told from its own last access when it comes back."""
    paying = rows if charge is None else rows.where(F.col(charge) > 0)
    seen = paying.groupBy("quota_tenant").agg(F.max(_second(arrival)).alias("last_second"))
    held = outcomes.groupBy("quota_tenant").agg(
        F.max_by("tokens", F.struct("window_idx", "session")).alias("tokens"))
    now = held.join(seen, "quota_tenant")
    earlier = state.tokens.join(now, "quota_tenant", "left_anti")
    tokens = now.select("quota_tenant", "tokens", "last_second").unionByName(earlier)
    used = (outcomes.select(*QUOTA_KEYS, "used").unionByName(state.used)
            .groupBy(*QUOTA_KEYS).agg(F.max("used").alias("used")))
    return LeaseState(
        tokens.where("tokens > 0").select("quota_tenant", "tokens", "last_second"), used)

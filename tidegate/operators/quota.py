"""Fixed-window tenant quotas: strict admission, ledgers and incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.keys import quota_tenant, window_index
from tidegate.operators.running import HOT_ROWS, Slices, find_slices, running_total
from tidegate.settings import QuotaPolicy

QUOTA_KEYS = ["quota_tenant", "window_idx"]


def with_quota_keys(events: DataFrame, policy: QuotaPolicy, arrival: str = "timestamp",
                    tenant: str = "tenant_id") -> DataFrame:
    """Add the tenant that is charged and the number of the window charged. An absent tenant is
    "" and an absent arrival 0, in these and in their own columns."""
    stamp = F.coalesce(F.col(arrival), F.lit(0).cast("long"))
    return events.withColumns({
        tenant: F.coalesce(F.col(tenant), F.lit("")), arrival: stamp,
        "quota_tenant": quota_tenant(F.col(tenant)),
        "window_idx": window_index(stamp, policy.window_sec)})


def admit_within(rows: DataFrame, keys: list[str], order: list[str], limit: int,
                 charge: Column | None = None, reserved: DataFrame | None = None,
                 slices: Slices | None = None, hot_rows: int = HOT_ROWS,
                 out: str = "admitted") -> DataFrame:
    """Flag the rows whose running charge, within the group and in order, is at most `limit`.

    `reserved` holds `(keys, amount)` already taken from the limit. It enters the running
    total as one row per group ahead of the others, so that no row has to be joined to it.
    Rows that charge nothing are always admitted.
    """
    columns = rows.columns
    if charge is not None:
        rows = rows.withColumn("_charge", F.greatest(charge, F.lit(0)).cast("long"))
    if reserved is not None:
        if slices is None:
            slices = find_slices(rows, keys, order, hot_rows)
        if charge is None:
            rows = rows.withColumn("_charge", F.lit(1).cast("long"))
        rows = rows.withColumn("_real", F.lit(True)).unionByName(
            reserved.select(*keys, F.col("amount").cast("long").alias("_charge"),
                            F.lit(False).alias("_real")),
            allowMissingColumns=True)
    charged = charge is not None or reserved is not None
    total = running_total(rows, keys, order, "_used",
                          F.col("_charge") if charged else None, slices, hot_rows)
    if reserved is not None:
        total = total.where("_real")
    fits = F.col("_used") <= limit
    if charge is not None:
        fits = fits | (F.col("_charge") == 0)
    return total.select(*columns, fits.alias(out))


def quota_admission(events: DataFrame, policy: QuotaPolicy, order: list[str],
                    ledger: DataFrame | None = None, charge: Column | None = None,
                    slices: Slices | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Strict quota over rows with quota keys: the first `limit` tokens of each tenant and
    window pass. `charge` weighs a row (a batch); then a row passes whole or not at all, and
    the first one denied ends the window. `ledger` holds what earlier runs used.
    """
    if policy.lease != 1:
        raise ValueError("quota_admission is the strict policy (lease 1); "
                         "use leased_admission for larger leases")
    reserved = None
    if ledger is not None:
        reserved = ledger.select(*QUOTA_KEYS, F.col("used").alias("amount"))
    return admit_within(events, QUOTA_KEYS, order, policy.limit, charge, reserved, slices,
                        hot_rows)


def quota_ledger(events: DataFrame, policy: QuotaPolicy,
                 charge: Column | None = None, ledger: DataFrame | None = None) -> DataFrame:
    """Tokens used per tenant and window. Demand above the limit uses all of it: a denied
    batch takes what was left. With `ledger`, earlier use is added before the limit applies.
    """
    weight = F.lit(1) if charge is None else F.greatest(charge, F.lit(0))
    demand = events.groupBy(*QUOTA_KEYS).agg(F.sum(weight).cast("long").alias("used"))
    if ledger is not None:
        demand = (demand.unionByName(ledger.select(*QUOTA_KEYS, "used"))
                  .groupBy(*QUOTA_KEYS).agg(F.sum("used").alias("used")))
    return (demand.where("used > 0")
            .withColumn("used", F.least("used", F.lit(policy.limit).cast("long"))))

import random

import pytest
from pyspark.sql import functions as F

from model import Limiter
from tidegate import QuotaPolicy
from tidegate.operators.leased import leased_admission
from tidegate.operators.quota import quota_admission, quota_ledger, with_quota_keys

SEC = 10**9
SCHEMA = "tenant_id string, timestamp long, seq long, n long"
ORDER = ["timestamp", "seq"]


def frame(spark, rows, policy):
    """Rows are (tenant, second, charge) in arrival order."""
    df = spark.createDataFrame([(t, s * SEC, i, n) for i, (t, s, n) in enumerate(rows)], SCHEMA)
    return with_quota_keys(df, policy)


def flags(df):
    return [r["admitted"] for r in df.orderBy("seq").collect()]


def expected(rows, policy):
    limiter = Limiter(policy.limit, policy.lease, policy.window_sec, policy.idle_ttl_sec)
    return [limiter.allow(t, s, n) for t, s, n in rows]


def test_unit_quota(spark):
    rows = [("a", 0, 1)] * 11 + [("b", 0, 1)]
    policy = QuotaPolicy(limit=10)
    assert flags(quota_admission(frame(spark, rows, policy), policy, ORDER)) == (
        [True] * 10 + [False, True])
    leased = QuotaPolicy(limit=10, lease=5)
    assert flags(leased_admission(frame(spark, rows, leased), leased, ORDER)) == (
        [True] * 10 + [False, True])


@pytest.mark.parametrize("charges,expect", [
    ([25, 25, 1], [True, True, False]),
    ([25, 30, 1], [True, False, False]),  # a denial uses up the rest
    ([50, 0, -3, 1], [True, True, True, False]),  # free charges always pass
    ([60, 0], [False, True]),
])
def test_weighted(spark, charges, expect):
    rows = [("a", 0, n) for n in charges]
    policy = QuotaPolicy(limit=50)
    assert flags(quota_admission(frame(spark, rows, policy), policy, ORDER,
                                 charge=F.col("n"))) == expect
    leased = QuotaPolicy(limit=50, lease=20)
    assert flags(leased_admission(frame(spark, rows, leased), leased, ORDER, "n")) == expected(
        rows, leased)


def test_weighted_leased_example(spark):
    rows = [("a", 0, n) for n in (25, 25, 1)]
    policy = QuotaPolicy(limit=50, lease=20)
    assert flags(leased_admission(frame(spark, rows, policy), policy, ORDER, "n")) == [True, True, False]


def test_carry_into_next_window(spark):
    rows = [("a", 0, 1)] + [("a", 1, 1)] * 20
    policy = QuotaPolicy(limit=10, lease=4)
    got = flags(leased_admission(frame(spark, rows, policy), policy, ORDER))
    assert sum(got[1:]) == 13
    assert got == expected(rows, policy)


def test_idle_tenant_loses_tokens(spark):
    rows = [("a", 0, 1)] + [("a", 350, 1)] * 20
    policy = QuotaPolicy(limit=10, lease=4, idle_ttl_sec=300)
    got = flags(leased_admission(frame(spark, rows, policy), policy, ORDER))
    assert sum(got[1:]) == 10
    kept = [("a", 50, 1)] + [("a", 350, 1)] * 20  # exactly at the limit is not idle
    assert sum(flags(leased_admission(frame(spark, kept, policy), policy, ORDER))[1:]) == 13


def test_unnamed_tenant_shares_default(spark):
    rows = [("", 0, 1), ("default", 0, 1), ("", 0, 1)]
    policy = QuotaPolicy(limit=2)
    out = quota_admission(frame(spark, rows, policy), policy, ORDER)
    assert flags(out) == [True, True, False]
    assert {r["tenant_id"] for r in out.collect()} == {"", "default"}


def test_strict_operator_refuses_leases(spark):
    with pytest.raises(ValueError):
        quota_admission(spark.range(1), QuotaPolicy(limit=1, lease=2), ORDER)


@pytest.mark.parametrize("hot_rows", [10**6, 5])
def test_incremental_equals_one_run(spark, hot_rows):
    rng = random.Random(5)
    rows = sorted([(f"t{rng.randrange(4)}", rng.randrange(8), rng.randrange(-1, 6))
                   for _ in range(400)], key=lambda r: r[1])
    policy = QuotaPolicy(limit=30, window_sec=2)
    df = frame(spark, rows, policy)
    first, second = df.where("seq < 213"), df.where("seq >= 213")
    ledger = quota_ledger(first, policy, F.col("n"))
    both = quota_admission(first, policy, ORDER, charge=F.col("n"), hot_rows=hot_rows).unionByName(
        quota_admission(second, policy, ORDER, ledger=ledger, charge=F.col("n"),
                        hot_rows=hot_rows))
    assert flags(both) == expected(rows, policy)
    total = quota_ledger(second, policy, F.col("n"), ledger)
    limiter = Limiter(30, window_sec=2)
    for t, s, n in rows:
        limiter.allow(t, s, n)
    assert {(r[0], r[1]): r[2] for r in total.collect()} == {
        k: v for k, v in limiter.used.items()}


def random_rows(rng, unit, spread, size, tenants):
    rows, second = [], 0
    for _ in range(size):
        second += rng.choice([0, 0, 0, 0, 1, 1, 2, spread])
        rows.append((f"t{rng.randrange(tenants)}", second, 1 if unit else rng.randrange(-1, 9)))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_leases_equal_the_sequential_rules(spark, seed, monkeypatch):
    import tidegate.operators.leased as leased

    rng = random.Random(seed)
    monkeypatch.setattr(leased, "SPAN", rng.choice([2, 5, 1024]))
    policy = QuotaPolicy(limit=rng.randrange(1, 12), lease=rng.randrange(1, 9),
                         window_sec=rng.choice([1, 3, 10]),
                         idle_ttl_sec=rng.choice([None, 2, 5, 13]))
    hot_rows = rng.choice([4, 10**6])
    rows = random_rows(rng, True, rng.choice([3, 20, 60]), 900, 6)
    got = flags(leased_admission(frame(spark, rows, policy), policy, ORDER, hot_rows=hot_rows))
    assert got == expected(rows, policy)
    rows = random_rows(rng, False, rng.choice([3, 20, 60]), 900, 6)
    got = flags(leased_admission(frame(spark, rows, policy), policy, ORDER, "n", hot_rows=hot_rows))
    assert got == expected(rows, policy)


@pytest.mark.parametrize("field", ["limit", "lease", "window_sec", "idle_ttl_sec"])
def test_settings_must_be_positive(field):
    with pytest.raises(ValueError):
        QuotaPolicy(**{field: 0})


@pytest.mark.parametrize("policy", [
    QuotaPolicy(limit=5, window_sec=5), QuotaPolicy(limit=5, lease=2, window_sec=5),
    QuotaPolicy(limit=5, lease=2, window_sec=5, idle_ttl_sec=60)])
def test_absent_tenants_share_the_default_quota(spark, policy):
    rows = [([None, "", "default"][i % 3], None if i == 0 else 0, i) for i in range(15)]
    events = with_quota_keys(
        spark.createDataFrame(rows, "tenant_id string, timestamp long, seq long"), policy)
    order = ["timestamp", "seq"]
    admit = quota_admission if policy.lease == 1 else leased_admission
    got = admit(events, policy, order).where("admitted").collect()
    assert sorted(r["seq"] for r in got) == [0, 1, 2, 3, 4]

import random

import pytest
from pyspark.sql import Observation, functions as F

from model import Buffers, Limiter
from tidegate import Capacity, QuotaPolicy, schema
from tidegate.operators import acks
from tidegate.operators.capacity import batch_cap, row_cap
from tidegate.operators.quota import quota_admission, with_quota_keys
from tidegate.sources.events import batch_requests, read_events, unpack_batches

def typed(frame, layout):
    return [(f.name, f.dataType) for f in frame.select(*layout.names).schema] == [
        (f.name, f.dataType) for f in layout]


SMALL = Capacity(shards=3, buffer=12, min_per_shard=1)


@pytest.mark.parametrize("hot_rows", [10**6, 6])
def test_row_cap_equals_buffers(spark, hot_rows):
    rng = random.Random(1)
    rows = sorted((rng.choice([0, 0, 0, 1, 2]), i) for i in range(120))
    df = spark.createDataFrame(rows, "interval long, seq long")
    got = {r["seq"]: r["buffered"]
           for r in row_cap(df, SMALL, "interval", ["seq"], hot_rows=hot_rows).collect()}
    for interval in range(3):
        model = Buffers(SMALL.shards, SMALL.per_shard)
        for _, seq in [r for r in rows if r[0] == interval]:
            assert got[seq] == model.submit()


def test_row_cap_counts_earlier_runs(spark):
    df = spark.createDataFrame([(0, i) for i in range(20)], "interval long, seq long")
    taken = spark.createDataFrame([(0, 5)], "interval long, used long")
    got = row_cap(df, SMALL, "interval", ["seq"], taken=taken)
    assert got.where("buffered").count() == 7


@pytest.mark.parametrize("hot_rows", [10**6, 6])
def test_batch_cap_equals_buffers(spark, hot_rows):
    rng = random.Random(2)
    rows = [(rng.choice([0, 0, 1]), i, rng.randrange(0, 6)) for i in range(80)]
    df = spark.createDataFrame(rows, "interval long, seq long, n int")
    out = batch_cap(df, SMALL, "interval", ["seq"], hot_rows=hot_rows)
    got = {r["seq"]: (r["accepted_count"], r["shard"]) for r in out.collect()}
    for interval in range(2):
        model = Buffers(SMALL.shards, SMALL.per_shard)
        for _, seq, n in [r for r in rows if r[0] == interval]:
            if n == 0:
                assert got[seq] == (0, None)
            else:
                assert got[seq][0] == model.submit_batch(n)
                assert got[seq][1] == model.turn % SMALL.shards


def test_large_buffers_take_everything(spark):
    pool = Capacity(shards=4, buffer=1000)
    assert pool.per_shard == 1024
    singles = spark.range(500).select(F.lit(0).alias("interval"), F.col("id").alias("seq"))
    assert row_cap(singles, pool, "interval", ["seq"]).where("buffered").count() == 500
    batch = spark.createDataFrame([(0, 0, 200)], "interval long, seq long, n int")
    assert batch_cap(batch, pool, "interval", ["seq"]).first()["accepted_count"] == 200


@pytest.mark.parametrize("hot_rows", [10**6, 7])
def test_batch_acks_equal_the_sequential_rules(spark, hot_rows):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "b"]), rng.randrange(3), rng.randrange(0, 7))
            for i in range(150)]
    rows.sort(key=lambda r: (r[2], r[0]))
    df = spark.createDataFrame(
        [(b, t, w, n, k) for k, (b, t, w, n) in enumerate(rows)],
        "batch_id long, quota_tenant string, window_idx long, n int, seq long")
    policy = QuotaPolicy(limit=45)
    out = acks.batch_acks(df, policy, SMALL, ["seq"], processed_at=F.lit(1).cast("long"),
                          hot_rows=hot_rows)
    got = {r["batch_id"]: r for r in out.collect()}
    limiter, pools = Limiter(45), {}
    for batch, tenant, window, n in rows:
        ack = got[batch]
        assert ack["accepted_count"] + ack["rejected_count"] == n
        if n == 0:
            assert (ack["accepted"], ack["message"]) == (True, "empty batch")
        elif not limiter.allow(tenant, window, n):
            assert (ack["accepted"], ack["accepted_count"], ack["message"]) == (
                False, 0, "rate limit exceeded")
        else:
            pool = pools.setdefault(window, Buffers(SMALL.shards, SMALL.per_shard))
            taken = pool.submit_batch(n)
            assert (ack["accepted"], ack["accepted_count"], ack["message"]) == (
                taken == n, taken, "batch processed")
    totals = acks.batch_totals(out).first()
    assert totals["accepted_total"] + totals["rejected_total"] == sum(r[3] for r in rows)
    assert typed(out, schema.BATCH_ACK)


def test_prefix_is_accepted(spark):
    df = spark.createDataFrame([(0, "a", 0, 3, 0), (1, "a", 0, 3, 1)],
                               "batch_id long, quota_tenant string, window_idx long, n int, seq long")
    out = acks.batch_acks(df, QuotaPolicy(limit=100), Capacity(1, 4, 1), ["seq"])
    got = [(r["accepted"], r["accepted_count"], r["message"]) for r in out.orderBy("seq").collect()]
    assert got == [(True, 3, "batch processed"), (False, 1, "batch processed")]


def test_batches_unpack_and_charge(spark):
    event = "struct<event_id:string,tenant_id:string,payload:string,timestamp:bigint>"
    df = spark.createDataFrame(
        [(0, "", [("e1", "x", "p", 5), ("e2", "y", None, None)]), (1, "z", [("e3", "x", "p", 6)]),
         (2, "", []), (3, "", None), (4, "", [("e4", "", "p", 7)])],
        f"batch_id long, tenant_id string, events array<{event}>")
    got = [(r["n"], r["quota_tenant"]) for r in batch_requests(df).orderBy("batch_id").collect()]
    assert got == [(2, "x"), (1, "z"), (0, "default"), (0, "default"), (1, "default")]
    rows = unpack_batches(df).orderBy("batch_id", "position").collect()
    assert [(r["event_id"], r["position"]) for r in rows] == [
        ("e1", 0), ("e2", 1), ("e3", 0), ("e4", 0)]
    assert (rows[1]["payload"], rows[1]["timestamp"]) == ("", 0)
    first = unpack_batches(df.withColumn("taken", F.lit(1)), accepted="taken")
    assert {r["event_id"] for r in first.collect()} == {"e1", "e3", "e4"}


def test_read_events_fills_absent_fields(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"event_id":"e1","timestamp":5}\n{"payload":"p"}\n')
    rows = read_events(spark, str(tmp_path), format="json").orderBy("timestamp").collect()
    assert [tuple(r) for r in rows] == [("", "", "p", 0), ("e1", "", "", 5)]


def test_event_and_stream_acks(spark):
    policy = QuotaPolicy(limit=3)
    df = spark.createDataFrame([("a", 0, i, "s1" if i < 4 else "s2") for i in range(6)],
                               "tenant_id string, timestamp long, seq long, stream_id string")
    admitted = quota_admission(with_quota_keys(df, policy), policy, ["timestamp", "seq"])
    capped = row_cap(admitted, Capacity(1, 2, 1), "window_idx", ["seq"], taking=F.col("admitted"))
    out = acks.event_acks(capped, F.lit(9).cast("long"), buffered="buffered")
    got = [(r["accepted"], r["message"], r["processed_at"]) for r in out.orderBy("seq").collect()]
    assert got == [(True, "event queued successfully", 9)] * 2 + [
        (False, "buffer full; shed load", 9)] + [(False, "rate limit exceeded", 9)] * 3
    assert typed(out, schema.EVENT_ACK) and typed(acks.stream_acks(out), schema.STREAM_ACK)
    good, bad = acks.split_accepted(out)
    assert (good.count(), bad.count()) == (2, 4)
    assert tuple(acks.outcome_totals(out).first()) == (2, 4)
    seen = Observation()
    acks.observe_outcomes(out, seen).collect()
    assert seen.get == {"accepted_total": 2, "rejected_total": 4}
    streams = {r["stream_id"]: r for r in acks.stream_acks(out).collect()}
    assert tuple(streams["s1"])[1:6] == (True, 4, 2, 2, "stream ingestion completed")
    assert tuple(streams["s2"])[1:6] == (False, 2, 0, 2, "stream ingestion completed")
    assert streams["s1"]["processed_at"] > 10**18


@pytest.mark.parametrize("field", ["shards", "buffer", "min_per_shard"])
def test_settings_must_be_positive(field):
    with pytest.raises(ValueError):
        Capacity(**{field: -1})

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidegate.operators import persistence
from tidegate.sources import table

EVENTS = "event_id string, tenant_id string, payload string, timestamp long, seq long"


@pytest.fixture
def target(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex[:8]
    table.create_table(spark, name, str(tmp_path / "events"), buckets=4)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored(spark, name):
    return sorted(tuple(r) for r in table.read_table(spark, name).drop("created_at").collect())


def test_same_batch_twice(spark, target):
    rows = [("e1", "test-tenant", '{"action":"login"}', 1, 0),
            ("e2", "test-tenant", '{"action":"view"}', 2, 1)]
    df = spark.createDataFrame(rows, EVENTS)
    assert table.insert_batch(df, target, 0, ["seq"]) == table.WriteCounts(2, 2)
    first = stored(spark, target)
    assert len(first) == 2
    assert table.insert_batch(df, target, 0, ["seq"]) == table.WriteCounts(2, 2)  # a repeat
    assert stored(spark, target) == first
    assert table.insert_batch(df, target, 1, ["seq"]) == table.WriteCounts(2, 0)  # a redelivery
    assert stored(spark, target) == first


def test_first_write_wins_over_batches(spark, target):
    rng = random.Random(1)
    rows = [(f"e{rng.randrange(60)}" if rng.random() < 0.7 else "", f"t{rng.randrange(3)}",
             str(i), i, i) for i in range(400)]
    keep = {}
    for row in rows:
        keep.setdefault(row[0], row[2])
    df = spark.createDataFrame(rows, EVENTS).repartition(3)
    for i in range(4):
        table.insert_batch(df.where(f"seq div 100 = {i}"), target, i, ["seq"])
    assert {r["event_id"]: r["payload"] for r in table.read_table(spark, target).collect()} == keep
    assert table.read_table(spark, target).count() == len(keep)


def test_create_is_repeatable_and_empty_batch_is_fine(spark, target, tmp_path):
    table.create_table(spark, target, str(tmp_path / "events"), buckets=4)
    empty = spark.createDataFrame([], EVENTS)
    assert table.insert_batch(empty, target, 0, ["seq"]) == table.WriteCounts(0, 0)
    assert table.read_table(spark, target).count() == 0
    assert table.bucket_count(spark, target) == 4


def test_several_files_per_bucket(spark, target):
    rows = [(f"e{i % 70}", "t", str(i), i % 70, i) for i in range(100)]
    df = spark.createDataFrame(rows, EVENTS)
    assert table.insert_batch(df, target, 0, ["seq"], files_per_bucket=3).inserted == 70
    assert table.insert_batch(df, target, 1, ["seq"]).inserted == 0
    later = spark.createDataFrame([("e5", "t", "x", 500, 0), ("e69", "t", "x", 69, 1)], EVENTS)
    # With the timestamps of the first delivery the horizon changes nothing.
    assert table.insert_batch(later.where("seq = 1"), target, 2, ["seq"]).inserted == 0
    assert table.insert_batch(later, target, 3, ["seq"]).inserted == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:  # every row still lies in its bucket
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        stored = table.read_table(spark, target)
        assert stored.join(spark.table(target).select("event_id"), "event_id").count() == 70
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_new_rows_alone_are_shuffled(spark, target):
    rows = [(f"e{i}", "t", "p", i, i) for i in range(50)]
    df = spark.createDataFrame(rows, EVENTS)
    table.insert_batch(df, target, 0, ["seq"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fresh = persistence.not_stored(df, spark.table(target))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_constraints(spark, target):
    rows = [("e" * 64, "t", "p", 1, 0), ("é" * 65, "t", "p", 1, 1), ("e", "t" * 65, "p", 1, 2),
            (None, "t", "p", 1, 3), ("e", "t", None, 1, 4), ("", "", "", 0, 5)]
    df = spark.createDataFrame(rows, EVENTS)
    counts, bad = table.insert_events(df, target, 0, ["seq"])
    assert counts == table.WriteCounts(2, 2)
    assert {r["seq"]: r["reason"] for r in bad.collect()} == {
        1: "event_id longer than 64", 2: "tenant_id longer than 64", 3: "event_id is null",
        4: "payload is null"}


def test_backlog(spark):
    rows = [("e1", "a", "p", 1, 0), ("e2", "a", "p", 1, 1), ("e2", "a", "p", 1, 2),
            ("e3", "b", "p", 1, 3)]
    df = spark.createDataFrame(rows, EVENTS)
    got = persistence.backlog(df, df.where("event_id = 'e1'")).collect()
    assert {r["tenant_id"]: r["waiting"] for r in got} == {"a": 2, "b": 1}
    assert persistence.backlog(df, df).count() == 0
    assert persistence.backlog(df.limit(0), df).count() == 0


def test_first_write_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("event_id"), "id")
    plan = persistence.first_write(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")


def test_upsert_statement():
    sql = table.upsert_statement("events", "staging")
    assert sql.endswith("ON CONFLICT (event_id) DO NOTHING") and "created_at" not in sql


def test_repeats_are_gone_before_the_join(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("event_id"),
                                 F.lit("t").alias("tenant_id"), "id")
    other = spark.range(5).select(F.col("id").cast("string").alias("event_id"))
    for out in (persistence.not_stored(persistence.first_write(df, ["id"]), other),
                persistence.backlog(df, other)):
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(plan) if "Join" in line)
        unique = [i for i, line in enumerate(plan)
                  if "WindowGroupLimit" in line or "keys=[event_id" in line]
        assert unique and min(unique) > join

"""Key filters and merges of the event table."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.sources import keyfilter, table
from tidegate.sources.keyfilter import KeyFilters

EVENTS = "event_id string, tenant_id string, payload string, timestamp long, seq long"
COLUMNS = ["event_id", "tenant_id", "payload", "event_timestamp", "created_at"]


@pytest.fixture
def target(spark, tmp_path):
    name = "k_" + uuid.uuid4().hex[:8]
    table.create_table(spark, name, str(tmp_path / "events"), buckets=4)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], EVENTS)


def some(seed, n, keys):
    rng = random.Random(seed)
    return [(f"e{rng.randrange(keys)}", f"t{rng.randrange(3)}", f"{seed}-{i}", i)
            for i in range(n)]


def first_writes(*batches):
    keep = {}
    for rows in batches:
        for row in rows:
            keep.setdefault(row[0], row[2])
    return keep


def stored(spark, name):
    rows = table.read_table(spark, name).collect()
    assert len({r["event_id"] for r in rows}) == len(rows)
    return {r["event_id"]: r["payload"] for r in rows}


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_filters_never_miss_and_seldom_err(n):
    rng, rule = np.random.default_rng(n), KeyFilters()
    own, other = (rng.integers(-2**63, 2**63, size, np.int64) for size in (n, 20_000))
    built = keyfilter.build_filter(own, rule)
    assert keyfilter.may_hold(built, own, rule).all()
    assert keyfilter.may_hold(built, other, rule).mean() < (0.01 if n else 1e-9)
    assert len(built) <= max(8, n * rule.bits // 8 + 8)


@pytest.mark.parametrize("few", [0, 100_000])
def test_batches_with_and_without_filters(spark, target, few):
    rule, batches = KeyFilters(few_rows=few), [some(s, 120, 200) for s in range(4)]
    for i, rows in enumerate(batches):
        table.insert_batch(frame(spark, rows), target, i, ["seq"], rule=rule)
    assert stored(spark, target) == first_writes(*batches)
    again = table.insert_batch(frame(spark, batches[3]), target, 3, ["seq"], rule=rule)
    assert again.attempted == 120 and stored(spark, target) == first_writes(*batches)


def test_files_to_read_do_not_grow_with_the_table(spark, target):
    repeated = frame(spark, [("e-0-3", "t", "late", 9)])
    new = frame(spark, [("x1", "t", "p", 1), ("x2", "t", "p", 2)])
    found = []
    for batch in range(6):
        rows = [(f"e-{batch}-{i}", "t", "p", i) for i in range(400)]
        table.insert_batch(frame(spark, rows), target, batch, ["seq"])
        found.append([len(table.possible_files(keys.select("event_id"), target, "other", 0))
                      for keys in (new, repeated)])
    assert len(spark.table(target).inputFiles()) == 24
    assert max(n for n, _ in found) <= 1 and all(1 <= n <= 2 for _, n in found)


def test_large_files_have_filters_of_bounded_parts(spark, target):
    rows = spark.range(20_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("t").alias("tenant_id"),
        F.lit("p").alias("payload"), F.col("id").alias("timestamp"), F.col("id").alias("seq"))
    table.insert_batch(rows, target, 0, ["seq"])
    stored_now = spark.table(target)
    parts = keyfilter.file_filters(stored_now, 4, part_keys=500).collect()
    assert sum(r.keys for r in parts) == 20_000 and max(r.keys for r in parts) < 800
    assert len({r.file for r in parts}) == 4 < len(parts)
    assert max(len(r.filter) for r in parts) < 800 * 12 // 8
    files = stored_now.inputFiles()
    filters = spark.createDataFrame(parts, keyfilter.FILTER_SCHEMA)

    def asked(keys, filters=filters):
        frame = spark.createDataFrame([(k,) for k in keys], "event_id string")
        return keyfilter.files_to_check(files, filters, frame, 4)

    buckets = {(r.file, r.bucket) for r in parts}
    for i in range(0, 20_000, 2_500):
        own = spark.createDataFrame([(f"e{i}",)], "event_id string").select(
            keyfilter.bucket_of(F.col("event_id"), 4)).first()[0]
        file = next(f for f, bucket in buckets if bucket == own)
        assert file in {f.rsplit("/", 1)[-1] for f in asked([f"e{i}"])}
    assert sum(len(asked([f"x{i}"])) for i in range(8)) <= 1
    # filters written before there were parts hold for whole files
    old = keyfilter.file_filters(stored_now, 4).withColumns(
        {c: F.lit(None).cast("int") for c in ("part", "parts")})
    assert len(asked(["e1"], old)) >= 1 and len(asked([f"e{i}" for i in range(100)], old)) == 4
    assert sum(len(asked([f"x{i}"], old)) for i in range(8)) <= 1


def test_files_without_filters_are_read(spark, target, monkeypatch):
    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(table, "_filter_files", lost)
        with pytest.raises(RuntimeError):
            table.insert_batch(frame(spark, [("a", "t", "old", 1)]), target, 0, ["seq"])
    rows = frame(spark, [("a", "t", "new", 2), ("b", "t", "p", 3)])
    assert table.insert_batch(rows, target, 1, ["seq"]) == table.WriteCounts(2, 1)
    assert stored(spark, target) == {"a": "old", "b": "p"}
    # the batch that failed after its rows were written comes again, and then has its filters
    counts = table.insert_batch(frame(spark, [("a", "t", "old", 1)]), target, 0, ["seq"])
    assert counts == table.WriteCounts(1, 1) and stored(spark, target) == {"a": "old", "b": "p"}
    assert len(table.possible_files(rows.select("event_id"), target, "w", 0)) == 2
    assert table.possible_files(frame(spark, [("z", "t", "p", 0)]).select("event_id"), target,
                                "w", 0) == []


def test_merges_keep_the_rows_and_find_batches_done(spark, target):
    batches = [some(s, 150, 260) for s in range(5)]
    counts = [table.insert_batch(frame(spark, rows), target, i, ["seq"])
              for i, rows in enumerate(batches[:3])]
    before = table.read_table(spark, target).select(*COLUMNS).collect()
    assert table.compact_table(spark, target) == 1
    assert sorted(table.read_table(spark, target).select(*COLUMNS).collect()) == sorted(before)
    assert {r.writer for r in table.read_table(spark, target).select("writer").collect()} \
        == {table.MERGED}
    for i in (0, 2):  # deliveries of merged batches
        assert table.insert_batch(frame(spark, batches[i]), target, i, ["seq"]) == counts[i]
    assert table.insert_batch(frame(spark, batches[0]), target, 0, ["seq"], "other") \
        == table.WriteCounts(150, 0)
    for i in (3, 4, 4):
        table.insert_batch(frame(spark, batches[i]), target, i, ["seq"])
    assert stored(spark, target) == first_writes(*batches)
    assert table.compact_table(spark, target, rows_per_file=10) == 2
    assert stored(spark, target) == first_writes(*batches)
    old = len(spark.table(target).inputFiles())
    gone = table.vacuum_table(spark, target)
    assert gone >= 5 and len(spark.table(target).inputFiles()) < old
    assert stored(spark, target) == first_writes(*batches)
    assert table.vacuum_table(spark, target) == 0
    more = some(9, 100, 400)
    table.insert_batch(frame(spark, more), target, 5, ["seq"])
    assert stored(spark, target) == first_writes(*batches, more)


def test_merged_files_are_sorted_and_bucketed(spark, target):
    for i in range(3):
        table.insert_batch(frame(spark, some(i, 90, 10_000)), target, i, ["seq"])
    table.compact_table(spark, target)
    table.vacuum_table(spark, target)
    files = spark.table(target).inputFiles()
    assert len(files) == 4
    for file in files:
        rows = [tuple(r) for r in spark.read.parquet(file).select(
            "tenant_id", "event_timestamp").collect()]
        assert rows == sorted(rows)
    keys = table.read_table(spark, target).select("event_id")
    assert keys.join(spark.table(target).hint("merge"), "event_id").count() == keys.count()


@pytest.mark.parametrize("step", ["createDataFrame", "_filter_files"])
def test_a_merge_that_fails_changes_nothing(spark, target, monkeypatch, step):
    batches = [some(s, 80, 150) for s in range(2)]
    for i, rows in enumerate(batches):
        table.insert_batch(frame(spark, rows), target, i, ["seq"])

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(spark if step == "createDataFrame" else table, step, lost)
        with pytest.raises(RuntimeError):
            table.compact_table(spark, target)
    assert stored(spark, target) == first_writes(*batches)
    more = some(7, 80, 150)
    table.insert_batch(frame(spark, more), target, 2, ["seq"])
    assert table.vacuum_table(spark, target) == 0
    assert table.compact_table(spark, target) == 1
    assert stored(spark, target) == first_writes(*batches, more)


def test_large_merged_partitions_are_left(spark, target):
    for i in range(2):
        table.insert_batch(frame(spark, some(i, 100, 10_000)), target, i, ["seq"])
    assert table.compact_table(spark, target, rows_per_file=10) == 1
    table.insert_batch(frame(spark, some(5, 8, 10**6)), target, 2, ["seq"])
    table.insert_batch(frame(spark, some(6, 8, 10**6)), target, 3, ["seq"])
    assert table.compact_table(spark, target, rows_per_file=10) == 2
    found = table.read_table(spark, target).groupBy("batch_id").count().collect()
    assert sorted(r.batch_id for r in found) == [1, 2]
    assert table.snapshot(spark, target).merged == {1, 2}
    assert table.compact_table(spark, target, rows_per_file=10) is None


def test_an_empty_table_has_nothing_to_merge(spark, target):
    assert table.compact_table(spark, target) is None and table.vacuum_table(spark, target) == 0
    table.insert_batch(frame(spark, []), target, 0, ["seq"])
    table.insert_batch(frame(spark, [("a", "t", "p", 1)]), target, 1, ["seq"], writer="it's/1")
    table.insert_batch(frame(spark, [("b", "t", "p", 1)]), target, 2, ["seq"], writer="it's/1")
    assert table.compact_table(spark, target) == 1 and table.vacuum_table(spark, target) == 2
    assert stored(spark, target) == {"a": "p", "b": "p"}
    assert table.read_table(spark, target).where(F.col("writer") != table.MERGED).isEmpty()

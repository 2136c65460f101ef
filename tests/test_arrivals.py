"""Arrival files, landings, replay, and batches over a stream."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidegate import Capacity, QuotaPolicy
from tidegate.functions.wire import EVENT_FIELDS, encode_event
from tidegate.operators import acks
from tidegate.operators.capacity import batch_cap, batch_room
from tidegate.operators.delivery import dead_letter_lines, parse_dead_letters
from tidegate.plans import streams
from tidegate.sources import table
from tidegate.operators.quota import with_quota_keys
from tidegate.streaming import admission, persist
from tidegate.streaming.admission import live_totals, start_batch_acks, start_quota
from tidegate.streaming.flush import run_to_end, size_options
from tidegate.streaming.replay import attempt_of, drain_replay, start_replay

ROWS = "stamp long, seq long"


def batches_of(stream, path):
    """The rows of each micro-batch."""
    found = []

    def write(batch, batch_id):
        found.append([tuple(r) for r in batch.collect()])

    run_to_end(stream.writeStream.foreachBatch(write).option("checkpointLocation", str(path))
               .trigger(availableNow=True).start())
    return found


@pytest.mark.parametrize("rows", [
    [(i // 3, i) for i in range(200)],
    [(5, i) for i in range(200)],  # a single stamp
    [(i, i) for i in range(199)] + [(10**18, 199)],  # a stamp far out
    [(None, 0), (None, 1), (3, 2), (9, 3)], [(1, 1)], []])
def test_arrivals_come_in_order(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows[::-1], ROWS).repartition(3)
    found = batches_of(streams.arrival_stream(frame, ["stamp", "seq"]), tmp_path)
    flat = [r for batch in found for r in batch]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(flat, key=str) == sorted(rows, key=str)
    for one, two in zip(found, found[1:]):
        if one and two:
            assert max(map(ordered.index, one)) < min(map(ordered.index, two))
    if len(rows) == 200:
        assert len(found) == streams.PARTS and max(map(len, found)) < 120


def test_more_rows_make_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 20)
    frame = spark.createDataFrame([(i, i) for i in range(200)], ROWS)
    stream = streams.arrival_stream(frame, ["stamp", "seq"])
    found = batches_of(stream, tmp_path)
    assert len(found) == streams.PARTS and sum(map(len, found)) == 200
    assert all(max(a)[0] < min(b)[0] for a, b in zip(found, found[1:]))


def test_flushes_have_a_file_for_every_core(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FEWEST_ROWS", 20)
    frame = spark.createDataFrame([(i, i) for i in range(400)], ROWS)
    found = []
    run_to_end(streams.arrival_stream(frame, ["stamp", "seq"]).writeStream.foreachBatch(
        lambda batch, _: found.append((batch.select(F.input_file_name()).distinct().count(),
                                       batch.count())))
        .option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start())
    assert [n for n, _ in found] == [4] * streams.PARTS and sum(n for _, n in found) == 400


@pytest.mark.parametrize(("rows", "parts"), [
    ([(i, i) for i in range(100)], 4), ([(7, i) for i in range(10)], 1),
    ([(0, 0), (1000, 1)], 2), ([], 1)])
def test_parts_land_whole(spark, tmp_path, rows, parts):
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    landings, found = streams.Landings(frame, F.col("stamp")), []

    def start():
        def write(batch, batch_id):
            found.append(sorted(r.stamp for r in batch.collect()))
        return (spark.readStream.schema(landings.schema).options(**landings.OPTIONS)
                .parquet(landings.path).writeStream.foreachBatch(write)
                .option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start())

    landings.each(start)
    assert len(found) == parts and sorted(sum(found, [])) == sorted(s for s, _ in rows)
    assert all(max(a) < min(b) for a, b in zip(found, found[1:]))


@pytest.fixture
def empty_tables(spark, tmp_path):
    for name in ("events", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", sorted(streams.QUERIES))
def test_streams_over_empty_tables(spark, empty_tables, name):
    found = streams.QUERIES[name](spark, empty_tables)
    counts = {"stream_flushes": "attempted", "stream_quota_sweeps": "ledger_rows"}
    assert sum(r[counts[name]] if name in counts else 1 for r in found.collect()) == 0


@pytest.fixture
def target(spark, tmp_path):
    name = "a_" + uuid.uuid4().hex[:8]
    table.create_table(spark, name, f"{tmp_path}/table", buckets=2)
    yield name
    spark.sql(f"DROP TABLE {name}")


EVENTS = "event_id string, tenant_id string, payload string, timestamp long"


def letters(spark, rows, errors):
    """Lines of events; a payload of None is a value that cannot be decoded."""
    frame = spark.createDataFrame([(*r, e) for r, e in zip(rows, errors)], EVENTS + ", error string")
    value = encode_event(*[F.col(n) for n, _, _ in EVENT_FIELDS])
    return dead_letter_lines(frame.select(
        F.timestamp_seconds(F.col("timestamp")).alias("failed_at"), F.lit("events").alias("topic"),
        F.col("event_id").alias("key"), "error",
        F.when(F.col("payload").isNull(), F.lit(b"\xff\xff")).otherwise(value).alias("value")))


def test_replay_stores_once_and_gives_up(spark, tmp_path, target):
    rows = [("a", "t", "first", 1), ("a", "t", "second", 2), ("b", "t", None, 3),
            ("c", "t", "p", 4), ("x" * 70, "t", "p", 5), ("d", "t", None, 6)]
    errors = ["timed out", "timed out", "attempt 1: was bad", "attempt 7: x", "", "attempt x: y"]
    letters(spark, rows, errors).write.text(f"{tmp_path}/letters")

    def start():
        return start_replay(spark, f"{tmp_path}/letters", target, ["failed_at", "payload"],
                            f"{tmp_path}/poison", f"{tmp_path}/cp", attempts=3, drain=True)

    drain_replay(start)
    stored = {r.event_id: r.payload for r in table.read_table(spark, target).collect()}
    assert stored == {"a": "first", "c": "p"}
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/poison")
    poison = parse_dead_letters(lines).select(
        "key", "failed_at", attempt_of(F.col("error")).alias("n"), "error").collect()
    assert sorted((r.key, r.n) for r in poison) == [("b", 3), ("d", 3), ("x" * 70, 3)]
    assert {r.failed_at for r in poison} == {f"1970-01-01T00:00:0{i}Z" for i in (3, 5, 6)}
    assert all("event_id longer than 64" in r.error for r in poison if len(r.key) == 70)
    drain_replay(start)  # nothing is left
    assert table.read_table(spark, target).count() == 2


def test_replay_of_a_batch_that_failed(spark, tmp_path, target, monkeypatch):
    letters(spark, [("a", "t", "p", 1), ("b", "t", None, 2)], ["", ""]).write.text(
        f"{tmp_path}/letters")

    def start():
        return start_replay(spark, f"{tmp_path}/letters", target, ["failed_at", "payload"],
                            f"{tmp_path}/poison", f"{tmp_path}/cp", attempts=2, drain=True)

    from tidegate.streaming import replay
    real = replay.insert_batch

    def lost(*args):
        real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(replay, "insert_batch", lost)
        with pytest.raises(StreamingQueryException):
            run_to_end(start())
    drain_replay(start)
    assert [r.event_id for r in table.read_table(spark, target).collect()] == ["a"]
    poison = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/poison")
    assert poison.count() == 1


def test_only_dead_letters_are_held_as_records(spark, tmp_path, monkeypatch):
    name, real, found = f"r_{uuid.uuid4().hex[:8]}", persist.insert_batch, []
    table.create_table(spark, name, f"{tmp_path}/table", buckets=2)

    def seen(events, *args, **options):
        found.append(events.select("topic", "key", "value").distinct().collect())
        return real(events, *args, **options)

    monkeypatch.setattr(persist, "insert_batch", seen)
    records = spark.createDataFrame([("e1", b"e1", 1), ("e2", b"e2", 2)],
                                    "id string, key binary, time long").select(
        F.lit("events").alias("topic"), "key", encode_event(
            F.col("id"), F.lit("t"), F.lit("p"), F.lit(5).cast("long")).alias("value"), "time")
    bad = records.limit(1).withColumns({"key": F.lit(b"bad"), "value": F.lit(b"\xff\xff")})
    records.unionByName(bad).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(records.schema).parquet(f"{tmp_path}/in")
    run_to_end(persist.start_persist(stream, name, ["time"], f"{tmp_path}/dead",
                                     f"{tmp_path}/flushes", f"{tmp_path}/cp", drain=True))
    assert [[tuple(r) for r in rows] for rows in found] == [[(None, None, None)]]
    assert sorted(r.event_id for r in table.read_table(spark, name).collect()) == ["e1", "e2"]
    letters = parse_dead_letters(spark.read.option("recursiveFileLookup", "true")
                                 .text(f"{tmp_path}/dead")).collect()
    assert [(r.topic, r.key, bytes(r.value)) for r in letters] == [
        ("events", "bad", b"\xff\xff")]
    spark.sql(f"DROP TABLE {name}")


def requests(spark, n):
    """Batches of few tenants and windows, some empty, with ties of the stamp."""
    rows = [(i, f"t{i % 3}", i // 4 * 10**9, (i * 7) % 5, i // 60) for i in range(n)]
    return spark.createDataFrame(
        rows, "batch_id long, quota_tenant string, timestamp long, n int, window_idx long")


@pytest.mark.parametrize("hot_rows", [10, 2_000_000])
def test_batch_cap_goes_on_from_what_was_taken(spark, hot_rows):
    frame, capacity, order = requests(spark, 240), Capacity(3, 60, 1), ["timestamp", "batch_id"]
    whole = batch_cap(frame, capacity, "window_idx", order, hot_rows=hot_rows)
    got, taken = [], None
    for part in range(4):
        own = frame.where(F.col("batch_id") % 240 >= part * 50).where(
            F.col("batch_id") < (part + 1) * 50 if part < 3 else F.lit(True))
        placed = batch_cap(own, capacity, "window_idx", order, hot_rows=hot_rows,
                           taken=taken or spark.createDataFrame(
                               [], "window_idx long, shard long, batches long, used long"))
        got += placed.collect()
        taken = spark.createDataFrame(batch_room(placed, capacity, "window_idx", taken=taken)
                                      .collect(), "window_idx long, shard long, batches long, "
                                                  "used long")
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole.collect()))
    assert all(r.used <= capacity.per_shard for r in taken.collect())


@pytest.mark.parametrize("keep", [None, 1])
def test_batch_acks_over_a_stream(spark, tmp_path, keep):
    frame, capacity, order = requests(spark, 240), Capacity(3, 60, 1), ["timestamp", "batch_id"]
    policy, stamp = QuotaPolicy(limit=40, window_sec=60), F.col("timestamp")
    want = acks.batch_acks(frame, policy, capacity, order, processed_at=stamp)
    stream = streams.arrival_stream(frame, order)
    run_to_end(start_batch_acks(stream, policy, capacity, order, f"{tmp_path}/out",
                                f"{tmp_path}/state", f"{tmp_path}/cp", "timestamp",
                                keep_windows=keep, drain=True))
    got = spark.read.parquet(f"{tmp_path}/out").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    room = spark.read.parquet(f"{tmp_path}/state/room/1").select("window_idx").distinct().count()
    assert room == 4 if keep is None else room <= 2


@pytest.mark.parametrize("batches", [False, True])
def test_what_rows_and_state_share_is_worked_out_once(spark, tmp_path, monkeypatch, batches):
    name = "batch_room" if batches else "row_cap"
    real, kept = getattr(admission, name), []

    def seen(rows, *args, **options):
        kept.append(rows.storageLevel.useMemory)
        return real(rows, *args, **options)

    monkeypatch.setattr(admission, name, seen)
    frame, capacity, order = requests(spark, 240), Capacity(3, 60, 1), ["timestamp", "batch_id"]
    policy, held = QuotaPolicy(limit=40, window_sec=60), spark.sparkContext._jsc.getPersistentRDDs
    before, stream = len(held()), streams.arrival_stream(frame, order)
    folders = f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/cp"
    if batches:
        run_to_end(start_batch_acks(stream, policy, capacity, order, *folders, drain=True))
    else:
        run_to_end(start_quota(stream, policy, order, *folders, capacity=capacity, drain=True))
    assert kept == [True] * streams.PARTS and len(held()) <= before


def test_counters_of_a_stream_hold_at_any_time(spark, tmp_path):
    rows = [("a", 100, i) for i in range(5)] + [("a", 900, 5), ("a", 100, 6), ("b", 100, 7)]
    policy = QuotaPolicy(limit=3, window_sec=1)
    out, found = f"{tmp_path}/out", []
    for one in (rows[:5], rows[5:6], rows[6:]):
        frame = spark.createDataFrame([(t, s * 10**9, i) for t, s, i in one],
                                      "tenant_id string, timestamp long, seq long")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        events = with_quota_keys(spark.readStream.schema(frame.schema)
                                 .parquet(f"{tmp_path}/in"), policy)
        for _ in range(2):  # a start without new rows counts nothing twice
            run_to_end(start_quota(events, policy, ["timestamp", "seq"], out,
                                   f"{tmp_path}/state", f"{tmp_path}/cp", keep_windows=10,
                                   counters=True, drain=True))
        found.append(tuple(live_totals(spark, out).first()))
    # The row that comes for a closed window is rejected.
    assert found == [(3, 2), (4, 2), (5, 3)]


def test_a_flush_is_bounded_by_bytes():
    assert size_options("parquet", bytes_per_flush=5) == {"maxBytesPerTrigger": "5"}
    assert size_options("parquet", files_per_flush=3) == {"maxFilesPerTrigger": "3"}

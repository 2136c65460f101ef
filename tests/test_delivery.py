import re
import base64
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegate import TopicSettings
from tidegate.functions.keys import nanos_to_timestamp, timestamp_to_nanos
from tidegate.functions.wire import EVENT_FIELDS, decode_records, encode_event, event_message
from tidegate.operators import delivery
from tidegate.sources import deadletter, topic

EVENTS = "event_id string, tenant_id string, payload string, timestamp long"
FIELDS = [name for name, _, _ in EVENT_FIELDS]


def sample_events():
    rng = random.Random(1)
    rows = [("", "", "", 0), ("a", "", "", 0), ("", "", "p", -1), ("é" * 70, "ü", "日本" * 5000, 1),
            ("x", "t", "y" * 127, 127), ("x", "t", "y" * 128, 128), ("x", "t", "y" * 16384, 2**63 - 1),
            ("x", "t", "y" * 16383, -2**63)]
    for _ in range(200):
        rows.append(("e" * rng.randrange(300), f"t{rng.randrange(5)}", "p" * rng.randrange(3000),
                     rng.randrange(-2**63, 2**63) >> rng.randrange(64)))
    return rows


def test_bytes_equal_the_protobuf_runtime(spark):
    df = spark.createDataFrame(sample_events(), EVENTS)
    out = df.withColumn("value", encode_event(*[F.col(c) for c in FIELDS])).collect()
    event = event_message()
    for r in out:
        message = event(**{c: r[c] for c in FIELDS})
        assert bytes(r["value"]) == message.SerializeToString(deterministic=True)


def test_round_trip(spark):
    df = spark.createDataFrame(sample_events(), EVENTS)
    records = delivery.to_records(df)
    good, bad = delivery.decode_split(records)
    assert bad.count() == 0
    assert sorted(good.select(*FIELDS).collect()) == sorted(df.collect())
    times = records.select("time").distinct().count()
    assert times == 1


def test_absent_fields_encode_as_defaults(spark):
    df = spark.createDataFrame([(None, "t", None, None)], EVENTS)
    value = bytes(delivery.to_records(df).first()["value"])
    assert event_message().FromString(value).tenant_id == "t"
    assert value == b"\x12\x01t"


def test_text_that_is_not_utf8_has_no_record(spark):
    df = spark.createDataFrame([("a", "t", "p", 1)], EVENTS)
    broken = df.withColumn("payload", F.unhex(F.lit("FF")).cast("string"))
    both = df.unionByName(broken)
    assert delivery.to_records(both).count() == 1
    assert delivery.unencodable(both).count() == 1


def test_decoding_accepts_any_field_order_and_unknown_fields(spark):
    swapped = b"\x20\x05" + b"\x0a\x01x" + b"\x4a\x02zz" + b"\x0a\x01y"
    rows = [(b"k1", swapped), (b"k2", b"\xff\xff\xff"), (b"k3", b"\x0a\x01\xff"), (b"k4", None),
            (b"k5", b"\x0a\x05x")]
    df = spark.createDataFrame(rows, "key binary, value binary")
    got = {bytes(r["key"]): r for r in decode_records(df).collect()}
    assert (got[b"k1"]["event_id"], got[b"k1"]["timestamp"]) == ("y", 5)
    for key in (b"k2", b"k3", b"k5"):
        assert got[key]["error"] and got[key]["event_id"] is None
        assert got[key]["value"] is not None
    assert (got[b"k4"]["error"], got[b"k4"]["event_id"]) == (None, "")


def test_dead_letter_line_and_back(spark, tmp_path):
    at = datetime(2024, 5, 6, 7, 8, 9, 120000)
    nasty = "a\tb\nc\\td\r\\"
    rows = [(at, "events", nasty, "err\tor", b"\x00\xff" * 200), (at, None, None, None, None),
            (datetime(2024, 1, 1), "t", "k", "e", b"")]
    df = spark.createDataFrame(
        rows, "failed_at timestamp, topic string, key string, error string, value binary")
    lines = [r["line"] for r in delivery.dead_letter_lines(df).collect()]
    assert all(len(line.split("\t")) == 5 and "\n" not in line for line in lines)
    assert lines[0].split("\t")[0] == "2024-05-06T07:08:09.12Z"
    assert lines[0].split("\t")[4] == base64.b64encode(b"\x00\xff" * 200).decode()
    assert lines[1] == "2024-05-06T07:08:09.12Z\t\t\t\t"
    assert lines[2].startswith("2024-01-01T00:00:00Z\t")
    path = str(tmp_path / "dlq")
    deadletter.append_dead_letters(df.limit(1), path)
    deadletter.append_dead_letters(df.where("topic = 't'"), path)
    back = {r["topic"]: r for r in deadletter.read_dead_letters(spark, path).collect()}
    assert (back["events"]["key"], back["events"]["error"]) == (nasty, "err\tor")
    assert bytes(back["events"]["value"]) == b"\x00\xff" * 200
    assert bytes(back["t"]["value"]) == b""


def test_time_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.range(1).select(
            F.timestamp_micros(F.lit(1_700_000_000_000_001)).alias("failed_at"),
            F.lit("t").alias("topic"), F.lit("k").alias("key"), F.lit("e").alias("error"),
            F.lit(b"v").alias("value"))
        line = delivery.dead_letter_lines(df).first()["line"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert line.split("\t")[0] == "2023-11-14T22:13:20.000001Z"


def test_replay_separates_what_cannot_be_decoded(spark, tmp_path):
    df = spark.createDataFrame([("e1", "t", "p", 1), ("e2", "t", "p", 2)], EVENTS)
    failed = delivery.to_records(df).select(
        F.col("time").alias("failed_at"), "topic", F.col("key").cast("string").alias("key"),
        F.lit("down").alias("error"),
        F.when(F.col("key") == F.lit(b"e2"), F.lit(b"\xff")).otherwise(F.col("value")).alias("value"))
    deadletter.append_dead_letters(failed, str(tmp_path / "dlq"))
    events, bad = deadletter.replay_dead_letters(spark, str(tmp_path / "dlq"))
    assert [r["event_id"] for r in events.collect()] == ["e1"]
    row = bad.first()
    assert (row["key"], row["delivery_error"]) == ("e2", "down") and row["error"]


def test_topic_files(spark, tmp_path):
    df = spark.createDataFrame([("e1", "t", "p", 1), ("e2", "t", "p", 2)], EVENTS)
    records = delivery.to_records(df, F.when(F.col("event_id") == "e1", "").otherwise("other"),
                                  default_topic="main")
    path = str(tmp_path / "topic")
    topic.publish(records, format="parquet", path=path)
    assert [bytes(r["key"]) for r in topic.read_topic(
        spark, "main", format="parquet", path=path).collect()] == [b"e1"]
    stamped = records.withColumn("topic", F.lit(None).cast("string"))
    topic.publish(stamped, format="parquet", path=path, settings=TopicSettings("main"))
    assert topic.read_topic(spark, "main", format="parquet", path=path).count() == 3


def test_failure_counters(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, False)], "batch_id long, kept boolean")
    assert tuple(delivery.failure_counters(df).first()) == (2, 3, 3)
    assert tuple(delivery.failure_counters(df, dead_lettered=F.col("kept")).first()) == (2, 3, 2)


def test_nanos(spark):
    row = spark.range(1).select(
        timestamp_to_nanos(nanos_to_timestamp(F.lit(1_700_000_000_123_456_789))).alias("ns")).first()
    assert row["ns"] == 1_700_000_000_123_456_000


def test_topic_settings_must_be_positive():
    with pytest.raises(ValueError):
        TopicSettings(publish_batch=0)


def test_encoders_stay_small_enough_to_be_compiled(spark):
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    frame = spark.range(10).select(
        F.col("id").cast("string").alias("s"), (F.col("id") * 10**17).alias("n"))
    coded = frame.select(encode_event(F.col("s"), F.repeat("s", F.lit(300)), F.col("s"),
                                      F.col("n")).alias("value"))
    plan = coded._jdf.queryExecution().executedPlan()
    code = getattr(debug, "MODULE$").codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 6000

"""The scan of many records at once against the protobuf runtime."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate.functions import wire
from tidegate.functions.wire import EVENT_FIELDS, decode_records, event_message, scan_records

NAMES = [name for name, _, _ in EVENT_FIELDS]


def by_runtime(value):
    try:
        event = event_message().FromString(value or b"")
    except Exception:
        return None
    return tuple(getattr(event, name) for name in NAMES)


def varint(n):
    n %= 1 << 64
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def record(rng):
    """Mostly a record in the encoder's form, else something close to one."""
    fields = []
    for _, number, kind in EVENT_FIELDS:
        if rng.random() < 0.2:
            continue
        if kind == "string":
            text = "".join(rng.choice("aé日 ") for _ in range(rng.choice([0, 1, 5, 200]))).encode()
            if rng.random() < 0.05:
                text += b"\xff"
            fields.append(bytes([number << 3 | 2]) + varint(len(text)) + text)
        else:
            n = rng.choice([0, 1, 127, 128, 10**18, -1, -2**63, 2**63 - 1])
            fields.append(bytes([number << 3]) + varint(n))
    if rng.random() < 0.1:
        rng.shuffle(fields)
    if rng.random() < 0.1:
        fields.append(rng.choice([b"\x28\x05", b"\x32\x01x", b"\x0a\x01a", b"\x20\x81\x00", b"\x00",
                                  b"\x20" + b"\xff" * 9 + b"\x03", b"\x0a\xff\xff\xff\xff\xff\x01"]))
    out = b"".join(fields)
    if rng.random() < 0.1:
        out = out[:rng.randrange(len(out) + 1)]
    return None if rng.random() < 0.02 else out


@pytest.mark.parametrize("seed", range(4))
def test_scan_agrees_with_the_runtime(seed):
    rng = random.Random(seed)
    values = [record(rng) for _ in range(600)]
    for column in (pa.array(values, pa.binary()), pa.array([b"pad", *values], pa.binary())[1:]):
        fields, good = scan_records(column)
        columns = [fields[n].to_pylist() for n in NAMES]
        assert good.mean() > 0.5
        for i, value in enumerate(values):
            want = by_runtime(value)
            if good[i]:
                got = tuple(c[i].decode() if isinstance(c[i], bytes) else c[i] for c in columns)
                assert got == want


@pytest.mark.parametrize("values", [[], [None], [b""], [b"\xff"] * 3])
def test_scan_of_few_records(values):
    fields, good = scan_records(pa.array(values, pa.binary()))
    assert [bool(g) for g in good] == [not v for v in values]
    assert all(len(fields[n]) == len(values) for n in NAMES)


def test_decode_of_all_forms(spark):
    rng = random.Random(9)
    rows = [(i, record(rng)) for i in range(500)]
    frame = spark.createDataFrame(rows, "id long, value binary").repartition(3)
    for row in decode_records(frame).collect():
        want = by_runtime(row.value and bytes(row.value))
        assert (row.error is None) == (want is not None)
        assert tuple(row[n] for n in NAMES) == (want or (None,) * 4)


def test_no_runtime_for_records_in_the_encoders_form(spark, monkeypatch):
    frame = spark.range(50).select(wire.encode_event(
        F.col("id").cast("string"), F.lit("té"), F.lit(""), F.col("id") - 25).alias("value"))
    fields, good = scan_records(pa.array([bytes(r.value) for r in frame.collect()], pa.binary()))
    assert good.all() and fields["timestamp"].to_pylist() == list(range(-25, 25))

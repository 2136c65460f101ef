"""Events as protobuf bytes.

Encoding is built from Spark expressions, so it runs inside the JVM. Decoding goes through Arrow
batches: records in the encoder's form are read all at once, and the protobuf runtime decides on
the others, which may have any field order and unknown fields.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Field numbers and types of the event message.
EVENT_FIELDS = (
    ("event_id", 1, "string"),
    ("tenant_id", 2, "string"),
    ("payload", 3, "string"),
    ("timestamp", 4, "int64"),
)
_WIRE_VARINT, _WIRE_BYTES = 0, 2


def _varint(value: Column, width: int, goes_on: bool = False) -> Column:
    """The low `width` (at most 8) base-128 digits of a number as bytes, low digit first,
    up to its last digit. With `goes_on`, the number may have more digits than that.

    The digits are laid out as the first bytes of one long, each with its "more follows" bit, so
    that a single `hex` writes them. The bytes are cut to the digits needed and the last one's bit
    taken back, unless more digits follow. Kept short: the generated code of an encoder should
    stay below the size up to which the JVM compiles a method.
    """
    spread = sum(128 << 8 * (7 - i) for i in range(width))
    spread = F.lit(spread - (1 << 64) * (spread >= 1 << 63))
    for i in range(width):
        digit = F.shiftrightunsigned(value, 7 * i).bitwiseAND(F.lit(127))
        spread = spread.bitwiseOR(F.shiftleft(digit, 8 * (7 - i)))
    # The number of digits, from the number of bits.
    count = F.call_function("div", F.length(F.bin(value)) + 6, F.lit(7)).cast("int")
    last = F.call_function("shiftleft", F.lit(128).cast("long"), F.lit(64) - 8 * count)
    if goes_on:
        last = F.when(count > width, F.lit(0).cast("long")).otherwise(last)
        count = F.least(count, F.lit(width))
    return F.substring(F.unhex(F.lpad(F.hex(spread.bitwiseXOR(last)), 16, "0")), F.lit(1), count)


def _long_varint(value: Column) -> Column:
    """All digits of any 64-bit number: eight, then the ninth and tenth."""
    rest = F.shiftrightunsigned(value, 56)
    return F.concat(_varint(value, 8, goes_on=True),
                    F.when(rest == 0, F.lit(b"")).otherwise(_varint(rest, 2)))


def _length(length: Column) -> Column:
    """A length: mostly one digit, which is an ASCII character. Longer ones are rare, and their
    form, which isn't compiled with the rest, keeps the generated code of an encoder small."""
    digits = F.call_function("div", F.length(F.bin(length)) + 6, F.lit(7)).cast("int")

    def digit(i: Column) -> Column:
        value = F.call_function("shiftrightunsigned", length, 7 * i).bitwiseAND(F.lit(127))
        more = F.when(i < digits - 1, F.lit(128)).otherwise(F.lit(0))
        return F.lpad(F.hex(value + more), 2, "0")

    many = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), digits - 1), digit), ""))
    return F.when(length < 128, F.char(length).cast("binary")).otherwise(many)


def _tag(number: int, wire_type: int) -> Column:
    return F.lit(bytes([number << 3 | wire_type]))


def encodable(event_id: Column, tenant_id: Column, payload: Column) -> Column:
    """Whether every string of an event is valid UTF-8."""
    return reduce(lambda a, b: a & b, [
        F.is_valid_utf8(F.coalesce(c, F.lit(""))) for c in (event_id, tenant_id, payload)])


def encode_event(event_id: Column, tenant_id: Column, payload: Column, timestamp: Column) -> Column:
    """Protobuf bytes of an event whose strings are valid UTF-8."""
    columns = {"event_id": event_id, "tenant_id": tenant_id,
               "payload": payload, "timestamp": timestamp}
    empty = F.lit(b"")
    pieces = []
    for name, number, kind in EVENT_FIELDS:
        col = columns[name]
        if kind == "string":
            col = F.coalesce(col, F.lit(""))
            pieces.append(F.when(col == "", empty).otherwise(F.concat(
                _tag(number, _WIRE_BYTES), _length(F.octet_length(col).cast("long")),
                col.cast("binary"))))
        else:
            col = F.coalesce(col, F.lit(0).cast("long"))
            pieces.append(F.when(col == 0, empty).otherwise(
                F.concat(_tag(number, _WIRE_VARINT), _long_varint(col))))
    return F.concat(*pieces)


def event_message():
    """The event message class, made from its field table. Costs little; call it per task."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as exc:  # pragma: no cover - depends on the installation
        raise ImportError("decoding event records needs the protobuf Python package") from exc
    scalar = descriptor_pb2.FieldDescriptorProto
    kinds = {"string": scalar.TYPE_STRING, "int64": scalar.TYPE_INT64}
    file = descriptor_pb2.FileDescriptorProto(
        name="tidegate/event.proto", package="tidegate", syntax="proto3")
    message = file.message_type.add(name="Event")
    for name, number, kind in EVENT_FIELDS:
        message.field.add(name=name, number=number, type=kinds[kind],
                          label=scalar.LABEL_OPTIONAL)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("tidegate.Event"))


def _varints(data: np.ndarray, at: np.ndarray, end: np.ndarray, wanted: np.ndarray, most: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers that begin at `at` where `wanted`, the places after them, and which of them end
    in time, within `most` bytes and 64 bits."""
    value, fine, going = np.zeros(len(at), np.uint64), wanted.copy(), wanted.copy()
    for k in range(most):
        if not going.any():
            break
        inside = going & (at < end)
        fine &= inside | ~going
        byte = data[np.where(inside, at, 0)]
        if k == 9:
            fine &= ~inside | (byte <= 1)
        digit = (byte & 127).astype(np.uint64) << np.uint64(7 * k)
        value |= np.where(inside, digit, np.uint64(0))
        at, going = at + inside, inside & (byte >= 128)
    return value, at, fine & ~going


def _spans(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The bytes from `start`, `size` of them, of each row."""
    ends = np.concatenate(([0], np.cumsum(size)))
    picked = data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)),
                                       pa.py_buffer(picked)])


def _not_text(column: pa.Array) -> np.ndarray:
    """Which rows are not UTF-8."""
    bad = np.zeros(len(column), bool)
    try:
        column.cast(pa.large_string())
    except pa.ArrowInvalid:
        for i, value in enumerate(column.to_pylist()):
            try:
                value.decode()
            except UnicodeDecodeError:
                bad[i] = True
    return bad


def scan_records(values: pa.Array) -> tuple[dict[str, pa.Array], np.ndarray]:
    """The event fields of all records at once, and which records they hold for: those that have
    each field at most once and in order, as the encoder writes them, and nothing else."""
    values = values.cast(pa.large_binary()).fill_null(b"")
    if not len(values):
        return {name: pa.array([], pa.large_binary() if kind == "string" else pa.int64())
                for name, _, kind in EVENT_FIELDS}, np.zeros(0, bool)
    _, offset_buffer, data_buffer = values.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    data = data if len(data) else np.zeros(1, np.uint8)
    at, end, good, fields = offsets[:-1].copy(), offsets[1:], np.ones(len(values), bool), {}
    for name, number, kind in EVENT_FIELDS:
        tag = number << 3 | (_WIRE_BYTES if kind == "string" else _WIRE_VARINT)
        there = good & (at < end) & (data[np.minimum(at, len(data) - 1)] == tag)
        value, after, fine = _varints(data, at + 1, end, there, 5 if kind == "string" else 10)
        size = np.zeros(len(at), np.int64)
        if kind == "string":
            fine &= value <= np.maximum(end - after, 0).astype(np.uint64)
            size = np.where(fine, value, np.uint64(0)).astype(np.int64)
            fields[name] = _spans(data, np.where(fine, after, 0), size)
        else:
            fields[name] = pa.array(np.where(fine, value, np.uint64(0)).view(np.int64))
        good &= fine | ~there
        at = np.where(there & fine, after + size, at)
    good &= at == end
    for name, _, kind in EVENT_FIELDS:
        if kind == "string":
            good &= ~_not_text(fields[name])
    return fields, good


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parse = None
    for batch in batches:
        fields, good = scan_records(batch.column("value"))
        # The runtime has the say on records of any other form, one by one.
        others = np.flatnonzero(~good)
        events, errors = [], []
        if len(others) and parse is None:
            message = event_message()
            parse, blank = message.FromString, message()
        for value in batch.column("value").take(pa.array(others)).to_pylist():
            try:
                events.append(parse(value or b""))
                errors.append(None)
            except Exception as exc:  # any undecodable value goes to quarantine
                events.append(blank)
                errors.append(f"{type(exc).__name__}: {exc}")
        mask, arrays = pa.array(~good), list(batch.columns)
        for name, _, kind in EVENT_FIELDS:
            arrow_type = pa.string() if kind == "string" else pa.int64()
            told = pa.array([None if error is not None else getattr(event, name)
                             for event, error in zip(events, errors)], arrow_type)
            kept = pc.if_else(mask, pa.scalar(None, fields[name].type), fields[name])
            arrays.append(pc.replace_with_mask(kept.cast(arrow_type), mask, told))
        wrong = pa.array([None] * len(good), pa.string())
        arrays.append(pc.replace_with_mask(wrong, mask, pa.array(errors, pa.string())))
        names = batch.schema.names + [name for name, _, _ in EVENT_FIELDS] + ["error"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def decode_records(records: DataFrame) -> DataFrame:
    """Append the event fields and `error` to rows that carry an encoded event in `value`.

    `error` is null for a good row; a bad row keeps its columns and has null event fields.
    The record's own time column must not be called `timestamp`.
    """
    clash = {name for name, _, _ in EVENT_FIELDS} & set(records.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} collide with the decoded fields")
    fields = list(records.schema.fields)
    for name, _, kind in EVENT_FIELDS:
        fields.append(T.StructField(name, T.StringType() if kind == "string" else T.LongType()))
    fields.append(T.StructField("error", T.StringType()))
    return records.mapInArrow(_decode_batches, T.StructType(fields))

"""Bloom filters of stored keys: which files of the event table may hold a new key.

A batch of the table writes filters for each of its files: one, or several of about `PART_KEYS` keys
each where a file has more; a key's hash tells its part. A small batch is then checked against
the files that may hold one of its keys, so what it reads does not grow with the table. A file
without a filter (written before, or left by a run that failed in between) counts as one that may
hold every key, and a filter without a part (written before there were any) as one of a whole file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

FILTER_SCHEMA = "file string, bucket int, part int, parts int, keys long, filter binary"
#: How many keys a filter holds, about, and how many hashes a task has in hand.
PART_KEYS = 1 << 19


@dataclass(frozen=True)
class KeyFilters:
    """Bits and hash functions per key (12 and 8: about one key in 300 is taken for stored
    though it is not), and the rows of a batch up to which filters are asked rather than all keys
    read. The keys' hashes of such a batch are broadcast, 8 bytes each."""

    bits: int = 12
    hashes: int = 8
    few_rows: int = 100_000

    def __post_init__(self) -> None:
        if self.bits <= 0 or self.hashes <= 0 or self.few_rows < 0:
            raise ValueError("bits and hashes must be positive, few_rows not negative")


def _places(hashes: np.ndarray, bits: int, rule: KeyFilters) -> np.ndarray:
    """The bits of each hash, by double hashing."""
    both = hashes.view(np.uint64)
    start, step = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32) | np.uint64(1)
    turns = np.arange(rule.hashes, dtype=np.uint64)
    return (start[:, None] + turns * step[:, None]) % np.uint64(bits)


def build_filter(hashes: np.ndarray, rule: KeyFilters = KeyFilters()) -> bytes:
    """The filter of some 64-bit hashes."""
    bits = -(-max(1, len(hashes) * rule.bits) // 64) * 64
    marked = np.zeros(bits, bool)
    for first in range(0, len(hashes), 1 << 16):
        marked[_places(hashes[first:first + (1 << 16)], bits, rule).ravel()] = True
    return np.packbits(marked, bitorder="little").tobytes()


def may_hold(filter: bytes, hashes: np.ndarray, rule: KeyFilters = KeyFilters()) -> np.ndarray:
    """Which of the hashes may be among those the filter was built from."""
    packed = np.frombuffer(filter, np.uint8)
    places = _places(hashes, 8 * len(packed), rule)
    found = packed[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1
    return found.all(axis=1)


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket in which the table keeps a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, by bits that have been mixed: filters use the plain ones."""
    mixed = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (mixed * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _packed(batches: Iterator[pa.RecordBatch], sizes: dict[str, int],
            part_keys: int) -> Iterator[pa.RecordBatch]:
    """Hashes by file and part, as bytes, taken together for `part_keys` rows at a time."""

    def rows(held: dict[str, list]) -> Iterator[tuple]:
        for file, (bucket, pieces) in held.items():
            hashes, parts = np.concatenate(pieces), max(1, -(-sizes[file] // part_keys))
            own = _parts_of(hashes, parts)
            hashes = hashes[np.argsort(own, kind="stable")]
            ends = np.cumsum(np.bincount(own, minlength=parts))
            for part in np.unique(own):
                first = ends[part - 1] if part else 0
                yield file, bucket, part, parts, hashes[first:ends[part]].tobytes()

    def out(held: dict[str, list]) -> pa.RecordBatch:
        kinds = pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()
        columns = zip(*rows(held), strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            ["file", "bucket", "part", "parts", "hashes"])

    held, count = {}, 0
    for batch in batches:
        files = batch.column(0).dictionary_encode()
        codes, hashes = files.indices.to_numpy(), batch.column(2).to_numpy()
        for code, file in enumerate(files.dictionary.to_pylist()):
            at = np.flatnonzero(codes == code)
            held.setdefault(file, (batch.column(1)[int(at[0])].as_py(), []))[1].append(hashes[at])
        count += len(hashes)
        if count >= part_keys:
            yield out(held)
            held, count = {}, 0
    if held:
        yield out(held)


def file_filters(stored: DataFrame, buckets: int, rule: KeyFilters = KeyFilters(),
                 part_keys: int = PART_KEYS) -> DataFrame:
    """(file, bucket, part, parts, keys, filter) for each file of stored rows, by its name, which no
    other file of the table has. A file is counted first, which reads its footer only, and cut into
    parts of about `part_keys` keys by their hashes, so that no task holds the keys of a whole one.
    Only hashes are shuffled, packed by part."""
    file = F.col("_metadata.file_name").alias("file")
    sizes = {row.file: row["count"]  # a row per file of the batch
             for row in stored.groupBy(file).count().collect()}
    keys = stored.select(file, bucket_of(F.col("event_id"), buckets).alias("bucket"),
                         F.xxhash64("event_id").alias("hash"))
    packed = keys.mapInArrow(lambda batches: _packed(batches, sizes, part_keys),
                             "file string, bucket int, part int, parts int, hashes binary")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.int64)
        return pa.table({
            "file": [key[0].as_py()], **{
                name: pa.array([value.as_py()], pa.int32())
                for name, value in zip(("bucket", "part", "parts"), key[1:], strict=True)},
            "keys": [len(hashes)],
            "filter": pa.array([build_filter(hashes, rule)], pa.binary())})

    return packed.groupBy("file", "bucket", "part", "parts").applyInArrow(run, FILTER_SCHEMA)


def _hit(hashes: np.ndarray | None, part: int | None, parts: int | None, filter: pa.Scalar,
         rule: KeyFilters) -> bool:
    """Whether a filter may hold one of a bucket's hashes."""
    if hashes is not None and parts is not None:
        hashes = hashes[_parts_of(hashes, parts) == part]
    return (hashes is not None and len(hashes) > 0
            and bool(may_hold(filter.as_py(), hashes, rule).any()))


def files_to_check(files: list[str], filters: DataFrame, keys: DataFrame, buckets: int,
                   rule: KeyFilters = KeyFilters()) -> list[str]:
    """Those of `files` that may hold one of the few `keys` (event_id)."""
    table = keys.select(bucket_of(F.col("event_id"), buckets).alias("bucket"),
                        F.xxhash64("event_id").alias("hash")).toArrow()
    bucket, hashes = (table.column(c).to_numpy() for c in ("bucket", "hash"))
    by_bucket = {int(b): hashes[bucket == b] for b in np.unique(bucket)}
    context = keys.sparkSession.sparkContext
    shared = context.broadcast(by_bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [_hit(shared.value.get(bucket.as_py()), part.as_py(), parts.as_py(), filter, rule)
                   for bucket, part, parts, filter in zip(*batch.columns[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hit, pa.bool_())],
                                             ["file", "hit"])

    asked = (filters.select("file", "bucket", "part", "parts", "filter")
             .mapInArrow(run, "file string, hit boolean")
             .groupBy("file").agg(F.bool_or("hit").alias("hit")).collect())  # a row per file
    shared.destroy()
    hits = {row.file: row.hit for row in asked}
    return [file for file in files if hits.get(file.rsplit("/", 1)[-1], True)]

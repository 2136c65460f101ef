"""The event table: created if absent, written batch by batch, never holding a key twice.

Each batch of a writer is its own partition and replaces itself when it is written again, and
a row is written only if nothing before it holds its key. Writing a batch twice therefore
leaves the table as it was. The files are bucketed by `event_id`, so the check against the
stored keys moves the new rows only. A small batch asks the Bloom filters of the stored files
first and reads the keys of those that may hold one of its own (`sources.keyfilter`).

`compact_table` merges the batches written so far into larger sorted files. What it merged is
listed in a snapshot, a single small file and the moment at which the merged rows take the place of
the batches; a run that fails before changes nothing. A batch that comes again after it was merged
is found done. `vacuum_table` deletes the files that no snapshot needs, once nobody reads them.

Several writers may fill a table, and it may be compacted, one at a time. Read it with
`read_table`, which knows the snapshots.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.operators.persistence import (constraint_split, first_write, not_stored,
                                            stored_rows)
from tidegate.session import delete_path
from tidegate.sources.keyfilter import (FILTER_SCHEMA, KeyFilters, bucket_of, file_filters,
                                        files_to_check)

#: The writer of merged partitions; their `batch_id` is the number of the merge.
MERGED = "~merged"
SNAPSHOT_SCHEMA = "generation long, writer string, upto long"
BATCHES_SCHEMA = "writer string, batch_id long, rows long"


def create_table(spark: SparkSession, name: str, location: str | None = None,
                 buckets: int = 16) -> None:
    """Create the event table unless it exists. Sorting by tenant and time within a bucket
    lets readers skip by those columns. Choose `buckets` for the size of the whole table: its
    keys are checked bucket by bucket."""
    at = "" if location is None else f"LOCATION '{location}'"
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
            event_id STRING, tenant_id STRING, payload STRING, event_timestamp BIGINT,
            created_at TIMESTAMP, writer STRING, batch_id BIGINT)
        USING parquet OPTIONS (partitionOverwriteMode 'dynamic')
        PARTITIONED BY (writer, batch_id)
        CLUSTERED BY (event_id) SORTED BY (tenant_id, event_timestamp) INTO {buckets} BUCKETS
        {at}""")


@dataclass(frozen=True)
class WriteCounts:
    """`attempted` counts every row handed over, duplicates included; `inserted` those kept."""

    attempted: int
    inserted: int


@dataclass(frozen=True)
class Snapshot:
    """The newest merge: up to which batch of each writer it and earlier ones took in, and which
    merged partitions hold them."""

    generation: int = 0
    upto: dict[str, int] = field(default_factory=dict)
    merged: frozenset[int] = frozenset()

    def lives(self, writer: str, batch_id: int) -> bool:
        return batch_id in self.merged if writer == MERGED else batch_id > self.upto.get(writer, -1)

    def condition(self) -> Column:
        """The same of rows, by partition columns only."""
        merged = (F.col("writer") == MERGED) & F.col("batch_id").isin(sorted(self.merged))
        waiting = F.col("writer") != MERGED
        for writer, upto in self.upto.items():
            waiting &= (F.col("writer") != writer) | (F.col("batch_id") > upto)
        return merged | waiting


def _described(spark: SparkSession, name: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what)
    return rows.first()["data_type"]


def bucket_count(spark: SparkSession, name: str) -> int:
    return int(_described(spark, name, "Num Buckets"))


def _beside(spark: SparkSession, name: str) -> str:
    """Where the table keeps filters and snapshots; readers of its folder pass over this."""
    return f"{_described(spark, name, 'Location').rstrip('/')}/_beside"


def _read_beside(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def snapshot(spark: SparkSession, name: str) -> Snapshot:
    rows = _read_beside(spark, f"{_beside(spark, name)}/snapshots", SNAPSHOT_SCHEMA).collect()
    newest = max((row.generation for row in rows), default=0)
    rows = [row for row in rows if row.generation == newest]
    return Snapshot(newest, {r.writer: r.upto for r in rows if r.writer != MERGED},
                    frozenset(r.upto for r in rows if r.writer == MERGED))


def _written(spark: SparkSession, name: str) -> DataFrame:
    """All rows that are written, merged or not."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The event table as it is now, whichever session wrote to it last."""
    return _written(spark, name).where(snapshot(spark, name).condition())


def _files(spark: SparkSession, name: str) -> dict[str, tuple[str, int]]:
    """Writer and batch of every file of the table. Spark lists paths as URIs."""
    found = {}
    for path in map(unquote, _written(spark, name).inputFiles()):
        writer, batch_id = re.search(r"/writer=([^/]*)/batch_id=(-?\d+)/[^/]*$", path).groups()
        found[path] = unquote(writer), int(batch_id)
    return found


def _partition(writer: str, batch_id: int) -> str:
    return f"writer={quote(writer, safe='~')}/batch_id={batch_id}"


def _filter_files(spark: SparkSession, name: str, writer: str, batch_id: int,
                  rule: KeyFilters) -> int:
    """Write the filters of a batch's files; returns the number of its rows."""
    path = f"{_beside(spark, name)}/filters/{_partition(writer, batch_id)}"
    own = _written(spark, name).where((F.col("writer") == writer)
                                      & (F.col("batch_id") == batch_id))
    file_filters(own, bucket_count(spark, name), rule).write.mode("overwrite").parquet(path)
    return spark.read.schema(FILTER_SCHEMA).parquet(path).agg(F.sum("keys")).first()[0] or 0


def possible_files(keys: DataFrame, name: str, writer: str, batch_id: int,
                   rule: KeyFilters = KeyFilters()) -> list[str]:
    """The files, of other batches than this and later ones of its writer, that may hold one of
    the few `keys` (event_id)."""
    spark, now = keys.sparkSession, snapshot(keys.sparkSession, name)
    files = [file for file, (by, number) in _files(spark, name).items()
             if now.lives(by, number) and not (by == writer and number >= batch_id)]
    filters = _read_beside(spark, f"{_beside(spark, name)}/filters", FILTER_SCHEMA)
    return files_to_check(files, filters, keys, bucket_count(spark, name), rule)


def insert_batch(events: DataFrame, name: str, batch_id: int, order: list[str],
                 writer: str = "batch", files_per_bucket: int = 1,
                 rule: KeyFilters = KeyFilters()) -> WriteCounts:
    """Write one batch of events that meet the table's constraints. `batch_id` grows with each
    batch of a `writer`. Raises when the job fails; what was there before is then still there.

    A large batch is written by `files_per_bucket` tasks for each bucket. A key is looked for
    among all stored rows, as a repeat may carry any timestamp: by filters for a batch of at most
    `rule.few_rows` rows, else among all keys.

    `events` is read twice, once to count it; cache it if it is costly. Counts taken while
    writing would be too high after a task has run again.
    """
    spark = events.sparkSession
    if batch_id <= snapshot(spark, name).upto.get(writer, -1):
        merged = _read_beside(spark, f"{_beside(spark, name)}/batches", BATCHES_SCHEMA)
        own = merged.where((F.col("writer") == writer) & (F.col("batch_id") == batch_id))
        return WriteCounts(events.count(), own.agg(F.sum("rows")).first()[0] or 0)
    attempted = events.count()
    first, few = first_write(events, order), attempted <= rule.few_rows
    if few:
        first = first.persist()
    try:
        if few:
            keys = first.select("event_id")
            files = possible_files(keys, name, writer, batch_id, rule)
            known = spark.createDataFrame([], "event_id string")
            if files:
                known = spark.read.schema("event_id string").parquet(*files).join(
                    F.broadcast(keys), "event_id", "left_semi")
        else:
            same_or_later = (F.col("writer") == writer) & (F.col("batch_id") >= batch_id)
            known = read_table(spark, name).where(~same_or_later)
        rows = (stored_rows(not_stored(first, known))
                .withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")})
                .repartition(bucket_count(spark, name) * files_per_bucket, "event_id"))
        rows.write.mode("overwrite").insertInto(name)
    finally:
        if few:
            first.unpersist()
    return WriteCounts(attempted, _filter_files(spark, name, writer, batch_id, rule))


def insert_events(events: DataFrame, name: str, batch_id: int, order: list[str],
                  writer: str = "batch") -> tuple[WriteCounts, DataFrame]:
    """Like `insert_batch`, for rows that may break the constraints; also returns the rows
    that do, with their reason."""
    good, bad = constraint_split(events)
    return insert_batch(good, name, batch_id, order, writer), bad


def compact_table(spark: SparkSession, name: str, rows_per_file: int = 4_000_000,
                  rule: KeyFilters = KeyFilters()) -> int | None:
    """Merge all batches, and merged partitions whose files have fewer than half of
    `rows_per_file`, into one partition of files of about that many rows; returns its number, or
    None if there is less than two partitions to merge. A row is therefore rewritten about as often
    as the table doubles, and not with every merge."""
    before, buckets = snapshot(spark, name), bucket_count(spark, name)
    sizes = [tuple(r) for r in read_table(spark, name).groupBy("writer", "batch_id")
             .agg(F.count(F.lit(1))).collect()]  # a row per batch since the last merge
    whole = sum(rows for *_, rows in sizes)
    small = min(whole, buckets * rows_per_file) / 2
    taken = [p for p in sizes if p[0] != MERGED or p[2] < small]
    if len(taken) < 2:
        return None
    number, upto = before.generation + 1, dict(before.upto)
    for writer, batch_id, _ in taken:
        if writer != MERGED:
            upto[writer] = max(batch_id, upto.get(writer, -1))
    again = {batch_id for writer, batch_id, _ in taken if writer == MERGED}
    own = (F.col("writer") == MERGED) & F.col("batch_id").isin(sorted(again))
    for writer in {writer for writer, *_ in taken if writer != MERGED}:
        own |= (F.col("writer") == writer) & (F.col("batch_id") <= upto[writer])
    rows = read_table(spark, name).where(own).drop("writer", "batch_id")
    files = buckets * max(1, -(-sum(n for *_, n in taken) // (buckets * rows_per_file)))
    # By number: Spark leaves out a repartition that the buckets it reads satisfy, and then reads
    # them without their order.
    (rows.withColumns({"writer": F.lit(MERGED), "batch_id": F.lit(number).cast("long")})
     .repartitionById(files, bucket_of(F.col("event_id"), files))
     .write.mode("overwrite").insertInto(name))
    _filter_files(spark, name, MERGED, number, rule)

    beside = _beside(spark, name)
    batches = [p for p in taken if p[0] != MERGED]
    (spark.createDataFrame(batches, BATCHES_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{beside}/batches/generation={number}"))
    state = [(number, writer, last) for writer, last in upto.items()] + [
        (number, MERGED, n) for n in (before.merged - again) | {number}]
    (spark.createDataFrame(state, SNAPSHOT_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{beside}/snapshots/merge={number}"))
    return number


def vacuum_table(spark: SparkSession, name: str) -> int:
    """Delete the partitions that the newest snapshot replaced, with their filters, and the older
    snapshots; returns how many partitions that were. Readers of older states lose their files."""
    now, beside = snapshot(spark, name), _beside(spark, name)
    gone = {(path.rsplit("/", 1)[0], *p) for path, p in _files(spark, name).items()
            if not now.lives(*p) and (p[0] != MERGED or p[1] <= now.generation)}
    for folder, writer, batch_id in sorted(gone):
        literal = writer.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION "
                  f"(writer = '{literal}', batch_id = {batch_id})")
        delete_path(spark, folder)
        delete_path(spark, f"{beside}/filters/{_partition(writer, batch_id)}")
    for number in range(1, now.generation):
        delete_path(spark, f"{beside}/snapshots/merge={number}")
    spark.catalog.refreshTable(name)
    return len(gone)


def stage_jdbc(events: DataFrame, url: str, staging: str, order: list[str], **options) -> None:
    """Write first writes to a staging table of a database. Spark's writer cannot skip
    conflicts, so `upsert_statement` moves the rows on from there."""
    rows = stored_rows(first_write(events, order)).drop("created_at")
    (rows.write.format("jdbc").mode("overwrite")
     .options(url=url, dbtable=staging, **options).save())


def upsert_statement(target: str, staging: str) -> str:
    columns = "event_id, tenant_id, payload, event_timestamp"
    return (f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {staging} "
            "ON CONFLICT (event_id) DO NOTHING")

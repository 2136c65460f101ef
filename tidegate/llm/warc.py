"""WARC archives written from and read back into a table of payload chunks.

A payload travels as rows (record, chunk number, bytes) of at most `chunk_bytes`, so no Python
task holds a whole one: the writer streams chunk rows into a file, the reader streams a file into
chunk rows, each with the SHA-256 of the payload up to its end (`digest`) and, on the last row,
the whole payload's. Of records with equal payloads of at least `revisit_bytes` bytes, the one
with the smallest id is the response; the others are revisits without a block that refer to it.

Files are gzip files with a member per record, written below a folder that all machines share, under names of the writing task's own
attempt; the manifest lists those of the attempts that ended well, and only they are read.
Defined cases: a null payload is empty; a null id has no number in its record id and comes back
as null (it is never the response that others refer to unless all ids are null: then all rows
are responses); rows that repeat the smallest id are all responses; control characters in a url
are percent-encoded in the header; an empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.running import broadcast_if_small

CHUNK_BYTES = 1 << 18
FILE_BYTES = 1 << 28
REVISIT_BYTES = 100
_NEWLINE = b"\r\n"
MANIFEST = "file string, records long, bytes long"
CHUNKS = ("record_id long, file string, at long, chunk_no int, data binary, end long, "
          "digest string, last boolean, record_type string, refers_to long, uri string, "
          "declared_bytes long, declared_digest string")


def with_record_types(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                      uri_col: str = "url", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(id, uri, payload, bytes, digest, record_type, refers_to) of each row.

    Which digests several rows share is found on (id, bytes, digest) alone and sent to the payloads
    where they are, if the list is small; only a list beyond the bound for broadcasts is joined by a
    shuffle of the rows."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("bytes"),
                       F.sha2("payload", 256).alias("digest"))
    shared = (rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "first"))
    shared = broadcast_if_small(shared)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "id", "uri", "payload", "bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def chunk_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk, a record's chunks in order; revisits have one empty chunk."""
    size = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("bytes"))
    last = F.greatest(F.ceil(size / chunk_bytes) - 1, F.lit(0)).cast("int")
    data = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(
        F.substring(F.col("payload"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return (records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
            .select("id", "uri", "chunk_no", data.alias("data"), "bytes", "digest",
                    "record_type", "refers_to"))


def _header(row: dict, date: str) -> bytes:
    def name(key: int | None) -> str:
        return f"<urn:page:{'' if key is None else key}>"

    length = 0 if row["record_type"] == "revisit" else row["bytes"]
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}",
             f"WARC-Record-ID: {name(row['id'])}", f"WARC-Date: {date}"]
    if row["uri"] is not None:
        uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["uri"])
        lines.append(f"WARC-Target-URI: {uri}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Refers-To: {name(row['refers_to'])}", "WARC-Profile: "
                  "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha256:{row['digest']}",
              f"X-Payload-Length: {row['bytes']}",
              "Content-Type: text/html", f"Content-Length: {length}", "", ""]
    return _NEWLINE.join(line.encode() for line in lines)


def write_archives(chunks: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the chunk rows as WARC files below `folder`; the manifest, stored there too.

    A file is closed after the record that takes it to `file_bytes`, compressed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, member, done, path, records = None, None, [], "", 0

        def end_record() -> None:
            out.write(member.compress(_NEWLINE * 2) + member.flush())

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if out is not None:
                        end_record()
                        if out.tell() >= file_bytes:
                            done.append((path, records, out.tell()))
                            out.close()
                            out, records = None, 0
                    if out is None:
                        path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(path, compression=None)
                    member = zlib.compressobj(wbits=31)
                    out.write(member.compress(_header(row, date)))
                    records += 1
                out.write(member.compress(row["data"]))
        if out is not None:
            end_record()
            done.append((path, records, out.tell()))
            out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in
             enumerate((pa.string(), pa.int64(), pa.int64()))], ["file", "records", "bytes"])

    manifest = f"{folder}/manifest"
    chunks.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return chunks.sparkSession.read.schema(MANIFEST).parquet(manifest)


def _line(source) -> bytes:
    """One header line, with its end."""
    line = bytearray()
    while not line.endswith(_NEWLINE):
        byte = source.read(1)
        if not byte:
            return bytes(line)
        line += byte
    return bytes(line)


def _parse(source) -> dict[str, str] | None:
    """The next record's header fields, or None at the end of the file."""
    version = _line(source)
    if not version:
        return None
    if version != b"WARC/1.1" + _NEWLINE:
        raise ValueError(f"no WARC record starts with {version[:40]!r}")
    found = {}
    while (line := _line(source)) != _NEWLINE:
        name, colon, value = line.decode().rstrip("\r\n").partition(": ")
        if not colon:
            raise ValueError(f"no header line: {line[:80]!r}")
        found[name] = value
    return found


def _number(name: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(digits[1]) if digits else None


def _chunks_of(source, file: str, chunk_bytes: int) -> Iterator[tuple]:
    at = 0
    while (head := _parse(source)) is not None:
        total, end, number, digest = int(head["Content-Length"]), 0, 0, hashlib.sha256()
        while True:
            data = source.read(min(chunk_bytes, total - end))
            end += len(data)
            digest.update(data)
            if not data and end < total:
                raise ValueError(f"{file} ends within a record")
            yield (_number(head["WARC-Record-ID"]), file, at, number, data, end,
                   digest.hexdigest(), end == total, head["WARC-Type"],
                   _number(head.get("WARC-Refers-To")), head.get("WARC-Target-URI"),
                   int(head["X-Payload-Length"]),
                   head["WARC-Payload-Digest"].removeprefix("sha256:"))
            number += 1
            if end == total:
                break
        if source.read(4) != _NEWLINE * 2:
            raise ValueError(f"{file}: a record doesn't end with two empty lines")
        at += 1


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str,
                  chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk rows of all files in the manifest; `data` is null unless wanted."""
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()),
            ("chunk_no", pa.int32()), ("data", pa.binary()), ("end", pa.int64()),
            ("digest", pa.string()), ("last", pa.bool_()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("uri", pa.string()), ("declared_bytes", pa.int64()),
            ("declared_digest", pa.string())])
        store, _ = fs.FileSystem.from_uri(folder)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for files_batch in batches:
            for file in files_batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(file, compression="gzip",
                                             buffer_size=1 << 16) as source:
                    for row in _chunks_of(source, file, chunk_bytes):
                        held += len(row[4]) + 200
                        rows.append(row if with_data else row[:4] + (None,) + row[5:])
                        if held >= 1 << 22:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return manifest.select("file").repartition(files).mapInArrow(run, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record. A response whose computed digest or length differs from its header
    is not `intact`; a revisit's digest and length are those of the payload it stands for."""
    revisit = F.col("record_type") == "revisit"
    return chunks.where("last").select(
        "record_id", F.when(revisit, F.col("declared_bytes")).otherwise(F.col("end"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest"))
        .alias("payload_digest"),
        "record_type", "refers_to",
        (revisit | ((F.col("digest") == F.col("declared_digest"))
                    & (F.col("end") == F.col("declared_bytes")))).alias("intact"))

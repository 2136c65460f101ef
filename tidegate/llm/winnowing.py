"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; of each window of neighbouring hashes the smallest
is chosen, the rightmost of equal ones, and kept with its position. Two texts that share a
passage of at least `window + k - 1` code points share a chosen hash, and the positions say
where. Defined cases: a null text is empty; an empty text has no hashes; a text shorter than k
has the one hash of the whole text at position 0; one with fewer than `window` k-grams has one
window. Equal texts have equal fingerprints; extra columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.text import mix, rolling_sums

_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


@dataclass(frozen=True)
class Winnow:
    """k-gram length and hashes per window, in code points."""

    k: int = 8
    window: int = 16

    def __post_init__(self) -> None:
        if self.k <= 0 or self.window <= 0:
            raise ValueError("k and window must be positive")


def choose(text: str, rule: Winnow) -> np.ndarray:
    """The fingerprint: hash in the upper and position in the lower 32 bits, by position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64)
    k = min(rule.k, len(points))
    sums, up = rolling_sums(mix(points.astype(np.uint64) + np.uint64(1)))
    grams = mix((sums[k:] - sums[:-k]) * up[k - 1:len(points)] + np.uint64(k))
    position = np.arange(len(grams), dtype=np.uint64)
    low = (grams & ~_LOW) | (_LOW - position)  # so that the rightmost of equal hashes is smallest
    size, span = min(rule.window, len(low)), 1
    total = len(low) - size + 1
    while span * 2 <= size:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:total], low[size - span:size - span + total])
    low = low[np.concatenate(([True], low[1:] != low[:-1]))]
    return (low & ~_LOW) | (_LOW - (low & _LOW))


def to_text(chosen: np.ndarray) -> str:
    """16 hex digits for each chosen hash: 8 of the hash, 8 of the position."""
    return chosen.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of the chosen hashes (Jaccard, positions left out); 1 for two empty ones."""
    a, b = np.unique(a >> _HALF), np.unique(b >> _HALF)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def matches(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Positions (in a, in b) of shared chosen hashes."""
    places: dict[int, list[int]] = {}
    for x in b.tolist():
        places.setdefault(x >> 32, []).append(x & 0xFFFFFFFF)
    return [(x & 0xFFFFFFFF, y) for x in a.tolist() for y in places.get(x >> 32, [])]


def fingerprint(text: Column, rule: Winnow = Winnow()) -> Column:
    """Fingerprint of each text as a string of `to_text`."""
    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([to_text(choose(t.as_py() or "", rule)) for t in texts], pa.string())
    return of(text)


def _bucket(bounds: list[int]):
    """Number of the id range; null ids are in the first."""
    edges = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def of(ids: pa.Array) -> pa.Array:
        low = np.iinfo(np.int64).min
        return pa.array(np.searchsorted(edges, ids.fill_null(low).to_numpy(zero_copy_only=False),
                                        "right").astype(np.int32))
    return of


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, id, text, guest), in each partition ordered so that every row that is no
    guest is followed by its successor in id order; the last document's is the first one.

    Ids are cut into ranges at quantiles. The first row of a range is sent to the range before
    it as a guest too, so whole texts are shuffled once and no task sees all rows. Null ids come
    first, rows of one id are ordered by text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    steps = [i / parts for i in range(1, parts)]
    bounds = docs.select(F.percentile_approx("id", steps, max(10_000, 10 * parts))).first()[0] \
        if steps else None
    docs = docs.select(_bucket(sorted(set(bounds or [])))("id").alias("bucket"), "id", "text")
    heads = (docs.groupBy("bucket").agg(F.max(F.col("id").isNull()).alias("null"),
                                        F.min("id").alias("id")).orderBy("bucket").collect())
    heads = [(h.bucket, None if h.null else h.id) for h in heads]  # a row for each range
    sent = [(heads[i - 1][0], head) for i, (_, head) in enumerate(heads)]
    sent = spark.createDataFrame(sent, "home int, head long")
    guests = (docs.join(F.broadcast(sent), F.col("id").eqNullSafe(F.col("head")))
              .groupBy("home", "head").agg(F.min("text").alias("text"))
              .select(F.col("home").alias("bucket"), F.col("head").alias("id"), "text",
                      F.lit(True).alias("guest")))
    rows = docs.withColumn("guest", F.lit(False)).unionByName(guests)
    return (rows.repartitionById(parts, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", F.asc_nulls_first("id"), "text"))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _compare(rule: Winnow):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = None
        for batch in batches:
            for bucket, key, text, guest in zip(*(c.to_pylist() for c in batch.columns)):
                own = choose(text, rule)
                if held is not None and not held[3] and held[0] == bucket:
                    yield held, (text, own)
                held = (bucket, key, text, guest, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64())]
                           + [(c, pa.string()) for c in
                              ("edited_sha256", "fingerprint", "edited_fingerprint")]
                           + [(c, pa.float64()) for c in ("near_edited", "near_next")])
        rows: list[tuple] = []
        for (_, key, text, _, own), (after, other) in pairs(batches):
            half = len(text) // 2
            changed = text[:len(text) - half] + after[:half]
            edited = choose(changed, rule)
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            rows.append((key, len(text), digest, to_text(own), to_text(edited),
                         likeness(own, edited), likeness(own, other)))
            if len(rows) == 512:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        rule: Winnow = Winnow()) -> DataFrame:
    """Each text beside its edited form, whose last floor(n / 2) code points are replaced by the
    first ones of the next document: fingerprints of both, and how alike the own one is to that
    of the edited text and of the next document. A single document is its own successor; an
    empty table gives no rows; repeated rows each give one."""
    return with_next(docs, id_col, text_col).mapInArrow(_compare(rule), EDITED)

"""SimHash near-dedup: links of fingerprints by a Gray-order hierarchical index.

A document's shingles are its runs of `size` words (ASCII case folded, words end at white space),
repeats included, joined by single spaces; fewer words make one shingle of the whole sequence. A
fingerprint bit is set if it is set in over half of the shingles' XXH64 values. Fingerprints link
when at most `most` bits differ.

* Equal fingerprints are one code, however many documents have them.
* The index keeps codes in the order of their Gray rank, where neighbours share most bits. `fan`
  neighbours form a node that holds the bits that all codes below it share, as a mask and a
  pattern; what a node holds its children don't repeat. A search carries the differences summed so
  far from node to node and leaves a whole group once they exceed `most`.
* On the cluster, bits are cut into `most` + 1 bands. Two codes that link agree in a band, so each
  code goes to one upper node per band, which the first bits of the band name; their number follows
  from the number of codes. Each upper node is searched in a task of its own.
* An upper node of more than `tile` codes is cut into ranges of the Gray rank. The ranges are nodes
  as well: two of them meet only where their shared bits differ in at most `most` places.

A search returns links that join what links join, at most one per code, so groups in which all
link with all stay small. Documents and codes never go to the driver.

Defined cases: a null text is empty; a text without words has the fingerprint 0, which links like
any other; rows with a null id take part, and a component's id is the smallest id that isn't null
(null if there is none); rows that repeat an id are rows of their own; an empty table gives an
empty one; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.memory import release
from tidegate.llm.storing import stored
from tidegate.llm.text import WHITE, folding, slices

_FOLD = folding(WHITE)
#: Pairs of code and node that a search holds at a time, and links until they are reduced.
_HELD = 1 << 21


@dataclass(frozen=True)
class Near:
    """Words per shingle, seed of the hash, most differing bits, children per node, codes that an
    upper node should have, and those from which on it is cut."""

    size: int = 3
    seed: int = 42
    most: int = 3
    fan: int = 8
    group: int = 2048
    tile: int = 1 << 16

    def __post_init__(self) -> None:
        if self.size <= 0 or not 0 <= self.most < 64 or self.fan < 2:
            raise ValueError("size must be positive, most from 0 to 63, fan at least 2")
        if self.group <= 0 or self.tile <= 0:
            raise ValueError("group and tile must be positive")


def fingerprint(value: bytes | None, rule: Near = Near()) -> int:
    """The fingerprint of a UTF-8 text; a long one is taken in slices."""
    ones, total, held = np.zeros(64, np.int64), 0, []

    def add(shingles) -> None:
        nonlocal ones, total
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, rule.seed) for s in shingles), np.uint64)
        if len(hashes):
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones, total = ones + bits.sum(axis=0, dtype=np.int64), total + len(hashes)

    for part in slices((value or b"").translate(_FOLD)):
        held += part.split()
        add(map(b" ".join, zip(*(held[k:] for k in range(rule.size)))))
        held = held[len(held) - rule.size + 1:] if len(held) >= rule.size else held
    if not total and held:
        add([b" ".join(held)])
    return sum(1 << k for k in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rule: Near = Near()) -> DataFrame:
    """(id, code) of each row; a code is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            texts = batch.column(1).cast(pa.large_binary())
            codes = np.array([fingerprint(t.as_py(), rule) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes.view(np.int64))], ["id", "code"])
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, code long"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray order of all codes."""
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


def gray_rank_column(code: Column) -> Column:
    """The same as a long that sorts alike."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code.bitwiseXOR(F.lit(-1 << 63))


class GrayIndex:
    """Distinct codes in Gray order below nodes that hold what all their codes share."""

    def __init__(self, codes: np.ndarray, rule: Near = Near()) -> None:
        self.rule, self.codes = rule, codes[np.argsort(gray_rank(codes))]
        every = every_or = self.codes
        masks, patterns = [np.full(len(codes), ~np.uint64(0))], [self.codes]
        while len(every) > rule.fan:
            starts = np.arange(0, len(every), rule.fan)
            every = np.bitwise_and.reduceat(every, starts)
            every_or = np.bitwise_or.reduceat(every_or, starts)
            masks.append(~(every ^ every_or))
            patterns.append(every)
        #: from the leaves up: pattern, bits that the node above doesn't hold, last code below
        self.levels = []
        for k, (mask, pattern) in enumerate(zip(masks, patterns)):
            above = np.arange(len(mask)) // rule.fan
            own = mask & ~masks[k + 1][above] if k + 1 < len(masks) else mask
            last = np.minimum((np.arange(len(mask)) + 1) * rule.fan ** k, len(codes)) - 1
            self.levels.append((pattern, own, last))

    def partners(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (a, b), a < b, of the linked codes of which the first is in first..end - 1."""
        fan = np.arange(self.rule.fan)
        roots = len(self.levels[-1][0])
        at = np.repeat(np.arange(first, end), roots)
        node = np.tile(np.arange(roots), end - first)
        apart = np.zeros(len(at), np.uint8)
        for k in range(len(self.levels) - 1, -1, -1):
            pattern, own, last = self.levels[k]
            apart = apart + np.bitwise_count((self.codes[at] ^ pattern[node]) & own[node])
            stay = (apart <= self.rule.most) & (last[node] > at)
            at, node, apart = at[stay], node[stay], apart[stay]
            if k:
                below = (node[:, None] * self.rule.fan + fan).ravel()
                there = below < len(self.levels[k - 1][0])
                at = np.repeat(at, self.rule.fan)[there]
                apart, node = np.repeat(apart, self.rule.fan)[there], below[there]
        return at, node

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All linked places, a bounded number of codes at a time."""
        step = max(1, _HELD // max(1, len(self.codes)))
        for first in range(0, len(self.codes), step):
            yield self.partners(first, min(first + step, len(self.codes)))


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`label` (the smallest place known of each place's component) after more links."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        label = label.copy()
        for ends in (a, b, x, y):
            np.minimum.at(label, ends, low)
        label = label[label]


def spanning_links(codes: np.ndarray, rule: Near = Near()) -> tuple[np.ndarray, np.ndarray]:
    """Links of distinct codes, at most one per code, that join what all links join."""
    index = GrayIndex(codes, rule)
    label, waiting, held = np.arange(len(codes)), [], 0
    for a, b in index.links():
        waiting.append((a, b))
        held += len(a)
        if held > _HELD:
            label = _joined(label, *(np.concatenate(x) for x in zip(*waiting)))
            waiting, held = [], 0
    if waiting:
        label = _joined(label, *(np.concatenate(x) for x in zip(*waiting)))
    while (label[label] != label).any():
        label = label[label]
    found = np.flatnonzero(label != np.arange(len(codes)))
    return index.codes[found], index.codes[label[found]]


def _upper_nodes(codes: DataFrame, rule: Near) -> DataFrame:
    """(node, code): each code at its upper node of each band."""
    bands = rule.most + 1
    width = 64 // bands
    bits = min(width, max(0, (-(-codes.count() // rule.group) - 1).bit_length()))
    if not bits:
        return codes.select(F.lit(0).cast("long").alias("node"), "code")
    nodes = [F.shiftrightunsigned("code", 64 - width * band - bits)
             .bitwiseAND(F.lit((1 << bits) - 1)) * bands + band for band in range(bands)]
    return codes.select(F.explode(F.array(*nodes)).alias("node"), "code")


def _ranges(large: DataFrame, most: int, rule: Near) -> DataFrame:
    """(node, part, code): large upper nodes as pairs of ranges of the Gray rank that may hold
    linked codes; `most` is the largest node's number of codes."""
    parts = 2 * -(-most // rule.tile)
    cuts = [k / parts for k in range(1, parts)]
    ranked = large.withColumn("rank", gray_rank_column(F.col("code")))
    edges = stored(ranked.groupBy("node").agg(
        F.percentile_approx("rank", cuts, 100 * parts).alias("edges")))
    placed = stored(ranked.join(edges, "node").select(
        "node", "code", F.size(F.filter("edges", lambda e: e < F.col("rank"))).alias("own")))
    shared = stored(placed.groupBy("node", "own").agg(
        F.bit_and("code").alias("pattern"), F.bit_or("code").alias("any")))
    left, right = (shared.select("node", *[F.col(c).alias(f"{c}_{side}")
                                           for c in ("own", "pattern", "any")])
                   for side in "ab")
    held = [F.bitwise_not(F.col(f"pattern_{s}").bitwiseXOR(F.col(f"any_{s}"))) for s in "ab"]
    apart = F.bit_count(F.col("pattern_a").bitwiseXOR(F.col("pattern_b"))
                        .bitwiseAND(held[0]).bitwiseAND(held[1]))
    met = left.join(right, "node").where((F.col("own_a") <= F.col("own_b"))
                                         & (apart <= rule.most))
    pair = F.col("own_a") * parts + F.col("own_b")
    ends = stored(met.select("node", pair.cast("long").alias("part"), F.explode(
        F.array_distinct(F.array("own_a", "own_b"))).alias("own")))
    return placed.join(ends, ["node", "own"]).select("node", "part", "code")


def near_links(codes: DataFrame, rule: Near = Near()) -> DataFrame:
    """Links (a, b) of the distinct codes (code) that join what all links join."""
    entries = stored(_upper_nodes(codes, rule))
    sizes = entries.groupBy("node").agg(F.count(F.lit(1)).alias("codes"))
    large = stored(sizes.where(F.col("codes") > rule.tile))
    most = large.agg(F.max("codes")).first()[0]
    whole = F.lit(-1).cast("long").alias("part")
    if most is None:
        placed = entries.select("node", whole, "code")
    else:
        placed = entries.join(large, "node", "left_anti").select("node", whole, "code").unionByName(
            _ranges(entries.join(large, "node", "left_semi"), most, rule))

    def run(table: pa.Table) -> pa.Table:
        release()
        codes = np.unique(table.column("code").to_numpy().view(np.uint64))
        a, b = spanning_links(codes, rule)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return placed.groupBy("node", "part").applyInArrow(run, "a long, b long")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rule: Near = Near()) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: 16 hex digits, and the smallest id that
    links reach, the row's own included."""
    own = stored(fingerprints(docs, id_col, text_col, rule))
    classes = stored(own.groupBy("code").agg(F.min("id").alias("first")))
    # XXH64 of a long is one to one, and spreads the codes as `components` needs it
    links = stored(near_links(classes.select("code"), rule)
                   .select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")))
    rooted = classes.withColumn("node", F.xxhash64("code")).join(
        components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(smallest, "root").select("code", "component_id")
    return own.join(found, "code", "left").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"),
        "component_id")

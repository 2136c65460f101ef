"""Ranked lexical search of many items at once, with shared parts of their scores formed once.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
lower-cased. A document's score for an item is the sum, over the item's terms with repeats, of the
term's weight (from the number of documents that hold it) times its saturated frequency in the
document, in integers.

* Items come in blocks of about `block_bytes` of text. Each block's terms are the vocabulary of one
  pass over the texts, which keeps every document's length and its frequencies of these terms.
* Sets of terms that several items share are mined from the block: the pair of parts that most
  items have becomes a part of its own, until no pair is in two items. The parts are a graph
  without cycles, each the sum of two others; an item is the sum of what remains in it.
* For a slice of documents the value of each part is formed once, in the order of the graph, and
  items add up their parts. A task keeps the best `k` documents of each item, and these lists are
  ranked once more over all tasks.

Defined cases: a null text has no terms, and a document without terms does not count; a null id
ranks after all others of an equal score; rows that repeat an id are rows of their own, and items
of equal id and text are one item; items or documents without terms give no rows, and neither does
an empty table; long texts are read in slices; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.memory import release
from tidegate.llm.storing import stored
from tidegate.llm.text import folding, slices
from tidegate.session import scratch_path

_FOLD = folding(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Values of parts that are held at a time.
_HELD = 1 << 21
#: How far apart, in the order of frequency, two parts of an item may be to become one.
_REACH = 8


@dataclass(frozen=True)
class Rank:
    """Documents per item, and bytes of items' texts that are searched in one pass."""

    k: int = 10
    block_bytes: int = 1 << 22

    def __post_init__(self) -> None:
        if self.k <= 0 or self.block_bytes <= 0:
            raise ValueError("k and block_bytes must be positive")


def terms(value: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a slice at a time."""
    for part in slices((value or b"").translate(_FOLD)):
        yield part.split()


@dataclass
class Shared:
    """Parts of the items' sums. Part i below `len(base)` is `base[i]`, a term and how often it
    counts; part `len(base)` + j is the sum of the two parts of `sums[j]`, which come before it.
    `items` lists the parts of each item."""

    base: list[tuple[int, int]]
    sums: list[tuple[int, int]] = field(default_factory=list)
    items: list[list[int]] = field(default_factory=list)

    def additions(self) -> int:
        """Additions per document."""
        return len(self.sums) + sum(max(0, len(x) - 1) for x in self.items)

    def levels(self) -> list[np.ndarray]:
        """Numbers of the sums in groups, each of which needs earlier groups only."""
        depth = [0] * len(self.base)
        for a, b in self.sums:
            depth.append(1 + max(depth[a], depth[b]))
        groups = defaultdict(list)
        for j, d in enumerate(depth[len(self.base):]):
            groups[d].append(j)
        return [np.array(groups[d]) for d in sorted(groups)]


def share(items: list[Counter]) -> Shared:
    """The sharing graph of items, each a counter of term numbers."""
    number: dict[tuple[int, int], int] = {}
    own = [{number.setdefault(pair, len(number)) for pair in sorted(item.items())}
           for item in items]
    out = Shared(list(number))
    holders: dict[int, set[int]] = defaultdict(set)
    for i, parts in enumerate(own):
        for part in parts:
            holders[part].add(i)
    while True:
        pairs: Counter[tuple[int, int]] = Counter()
        for parts in own:
            often = sorted((p for p in parts if len(holders[p]) > 1),
                           key=lambda p: (-len(holders[p]), p))
            for i, p in enumerate(often):
                pairs.update((p, q) for q in often[i + 1:i + 1 + _REACH])
        grown = False
        for (p, q), n in pairs.most_common():
            if n < 2:
                break
            both = holders[p] & holders[q]
            if len(both) < 2:
                continue
            part, grown = len(out.base) + len(out.sums), True
            out.sums.append((p, q))
            holders[p] -= both
            holders[q] -= both
            holders[part] = both
            for i in both:
                own[i] -= {p, q}
                own[i].add(part)
        if not grown:
            break
    out.items = [sorted(parts) for parts in own]
    return out


def _frequencies(docs: DataFrame, vocabulary) -> DataFrame:
    """(id, n, terms, times) of each document that has terms: their number, and which of the
    vocabulary it holds how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            release()
            rows = []
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                n, found = 0, Counter()
                for part in terms(text.as_py()):
                    n += len(part)
                    found.update(map(known.get, part))
                found.pop(None, None)
                if n:
                    rows.append((key.as_py(), n, list(found), list(found.values())))
            ids, n, held, times = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(held, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["id", "n", "terms", "times"])
    return docs.mapInArrow(run, "id long, n long, terms array<int>, times array<long>")


class _Best:
    """The best `k` documents of each item among those shown."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def show(self, item: int, scores: np.ndarray, ids: list[int | None]) -> None:
        found = np.flatnonzero(scores >= self.least[item])
        if not len(found):
            return
        if len(found) > self.k:  # ties of the last score stay, and are ranked by id
            cut = np.partition(scores[found], len(found) - self.k)[len(found) - self.k]
            found = found[scores[found] >= cut]
        more = [(-s, ids[i] is None, ids[i] or 0)
                for s, i in zip(scores[found].tolist(), found.tolist())]
        self.rows[item] = sorted(self.rows[item] + more)[:self.k]
        if len(self.rows[item]) == self.k:
            self.least[item] = -self.rows[item][-1][0]


def _best_of_tasks(counts: DataFrame, plan, rule: Rank) -> DataFrame:
    """(item, score, id): each task's best documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, weights, documents, length = plan.value
        term = np.array([t for t, _ in shared.base], np.int64)
        factor = np.array([f for _, f in shared.base], np.int64)
        sums = np.array(shared.sums, np.int64).reshape(-1, 2)
        levels, first = shared.levels(), len(shared.base)
        step = max(1, _HELD // max(1, first + len(sums) + len(weights)))
        best = _Best(len(shared.items), rule.k)
        for batch in batches:
            release()
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n = part.column(1).to_numpy()
                near = 25 + 75 * n * documents // length
                held = part.column(2)
                row = np.repeat(np.arange(len(n)), held.value_lengths().to_numpy())
                which, tf = held.flatten().to_numpy(), part.column(3).flatten().to_numpy()
                known = np.zeros((len(weights), len(n)), np.int64)
                known[which, row] = weights[which] * (
                    1_000_000_000 * tf // (1000 * tf + 8 * near[row]))
                values = np.empty((first + len(sums), len(n)), np.int64)
                values[:first] = known[term] * factor[:, None]
                for group in levels:
                    values[first + group] = values[sums[group, 0]] + values[sums[group, 1]]
                ids = part.column(0).to_pylist()
                for item, parts in enumerate(shared.items):
                    if parts:
                        best.show(item, values[parts].sum(axis=0), ids)
        rows = [(i, -s, None if empty else key)
                for i, own in enumerate(best.rows) for s, empty, key in own]
        columns = zip(*rows) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
            ["item", "score", "id"])
    return counts.mapInArrow(run, "item int, score long, id long")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _block(docs: DataFrame, items: list, rule: Rank) -> DataFrame:
    """(item_id, rank, doc_id, score) of a block of items (item_id, text)."""
    spark, number = docs.sparkSession, {}
    wanted = []
    for row in items:
        found: Counter[int] = Counter()
        for part in terms(row.text.encode()):
            found.update(number.setdefault(t, len(number)) for t in part)
        wanted.append(found)
    vocabulary = spark.sparkContext.broadcast(number)
    counts = stored(_frequencies(docs, vocabulary))
    vocabulary.destroy()
    total = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    holding = {r.term: r.n for r in counts.select(F.explode("terms").alias("term"))
               .groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # of this block
    weights = np.array([weight(total.documents, holding[t]) if t in holding else 0
                        for t in range(len(number))], np.int64)
    shared = share([Counter({t: n for t, n in item.items() if weights[t] > 0})
                    for item in wanted])
    plan = spark.sparkContext.broadcast((shared, weights, total.documents, total.length or 1))
    found = stored(_best_of_tasks(counts.where(F.size("terms") > 0), plan, rule))
    plan.destroy()
    names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(items)],
                                  "item int, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.k)
            .join(F.broadcast(names), "item")
            .select("item_id", "rank", F.col("id").alias("doc_id"), "score"))


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  rule: Rank = Rank()) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = stored(items.select(F.col(item_col).cast("long").alias("item_id"),
                                F.col(item_text_col).alias("text"))
                   .where("text is not null").distinct())
    whole = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-whole // rule.block_bytes))
    folder = scratch_path(spark, "ranking")
    kind = "item_id long, rank int, doc_id long, score long"
    spark.createDataFrame([], kind).write.parquet(folder)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        if own:
            _block(docs, own, rule).write.mode("append").parquet(folder)
    return spark.read.schema(kind).parquet(folder)

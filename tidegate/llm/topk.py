"""Exact top-k inner-product search with a three-phase uniform threshold.

Each vector is cut into `slices` parts, and a query has a score list for each part: the partial
inner products. Candidates, ordered by length within their partition, and queries are packed into
blocks, and a query block meets each candidate block at most once per pass.

1. Gather: every block scores exactly, for each query, the rows that head its partial lists, and
   no others. The k-th best of all that is sent is a cutoff that the k-th best score cannot be
   below.
2. Collect: the cutoff goes back with the queries. Blocks whose longest row cannot reach the
   cutoff of any query of a block do not meet it. In the others the lists are read one after the
   other; a row stays while the lists read, and the product of the lengths of the parts unread,
   may add up to the cutoff. Of the rows for which all lists were read, those stay that have at
   least cutoff / slices on one of them, as any row that reaches the cutoff must.
3. Resolve: as soon as few rows are left in a block, only these are scored on the lists unread;
   what reaches the cutoff, at most k rows of a block and query, is ranked.

Defined cases: rows whose id or vector is null, or whose vector has a null or non-finite
component, take no part; shorter vectors count as padded with zeros; an empty vector scores 0;
rows that share the query's id are not its candidates, other repeated ids are candidates in their
own right; a repeated query id gets one ranking over the scores of all its rows; equal scores are
ranked by id; extra columns are ignored. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = ("block long, ids binary, dims int, cells binary, cuts binary, reach double, "
          "need double")
_FOUND = "query_id long, score long, vec_id long"
_NO_CUT = np.iinfo(np.int64).min
_FEW = 1 / 8  # share of a block below which rows are scored one by one
_SLACK = 1e-5  # of the product of two lengths; more than rounding can lose


@dataclass(frozen=True)
class Search:
    """Rows kept per query, parts of a vector, rows of a candidate and of a query block."""

    k: int = 20
    slices: int = 4
    block_rows: int = 4096
    query_rows: int = 256

    def __post_init__(self) -> None:
        if min(self.k, self.slices, self.block_rows, self.query_rows) <= 0:
            raise ValueError("all parameters must be positive")


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """(id, cells): floor(scale * x) of each component; rows that take no part are left out."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(
        vector, lambda x: F.floor(x * F.lit(float(scale)))).alias("cells"))


def _needed(cuts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The length that a candidate must have to reach the cutoff of each query."""
    with np.errstate(divide="ignore"):
        need = cuts * (1 - 2 * _SLACK) / length
    return np.where((cuts == _NO_CUT) | (cuts <= 0), -np.inf, need)


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of at most `most` rows, made within the partitions as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                sizes = part.column(1).value_lengths().to_numpy(zero_copy_only=False)
                cells = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
                cells[np.arange(cells.shape[1]) < sizes[:, None]] = part.column(1).flatten()
                cuts = part.column(2).to_numpy(zero_copy_only=False)
                length = np.linalg.norm(cells.astype(float), axis=1)
                small = cells.astype(np.int16)
                cells = small if (small == cells).all() else cells
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([number], pa.int64()),
                    "ids": pa.array([ids.tobytes()]), "dims": pa.array([cells.shape[1]], "int32"),
                    "cells": pa.array([cells.tobytes()]),
                    "cuts": pa.array([cuts.tobytes()]),
                    "reach": pa.array([length.max(initial=0)]),
                    "need": pa.array([_needed(cuts, length).min(initial=np.inf)])})
                number += 1
    return rows.mapInArrow(run, _BLOCK)


def _pairs(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Query blocks beside the candidate blocks that may reach a cutoff of theirs. Candidate blocks
    are dealt into as many groups as there are shuffle partitions, and the small query blocks are
    sent to each group."""
    groups = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
                          "need", F.struct("ids", "dims", "cells", "cuts").alias("q"))
    right = candidates.select(
        F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("of"), "reach",
        F.struct("ids", "dims", "cells").alias("c"))
    meets = (F.col("group") == F.col("of")) & (F.col("need") <= F.col("reach"))
    return left.join(right, meets).select(
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "qc" for c in ("ids", "dims", "cells")],
        "q.cuts")


def _matrix(ids: np.ndarray, dims: int, cells: bytes) -> np.ndarray:
    wide = len(cells) == 8 * len(ids) * dims
    return np.frombuffer(cells, np.int64 if wide else np.int16).reshape(len(ids), dims)


class _Tile:
    """One query block against one candidate block."""

    def __init__(self, row: dict, slices: int) -> None:
        self.queries = np.frombuffer(row["q_ids"], np.int64)
        self.ids = np.frombuffer(row["c_ids"], np.int64)
        q = _matrix(self.queries, row["q_dims"], row["q_cells"])
        c = _matrix(self.ids, row["c_dims"], row["c_cells"])
        dims = min(q.shape[1], c.shape[1])
        q, c = q[:, :dims], c[:, :dims]
        most = float(np.abs(q, dtype=float).max(initial=0)) * np.abs(c, dtype=float).max(initial=0)
        most *= max(dims, 1)  # sums below these bounds are exact
        kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
        self.q, self.c = q.astype(kind), c.astype(kind)
        self.edges = np.linspace(0, dims, slices + 1).astype(int)
        self.cuts = np.frombuffer(row["cuts"], np.int64)

    def partial(self, i: int) -> np.ndarray:
        """List i of every query."""
        a, b = self.edges[i:i + 2]
        return self.q[:, a:b] @ self.c[:, a:b].T

    def exact(self, query: np.ndarray, at: np.ndarray, first: int = 0) -> np.ndarray:
        """Scores of pairs on the lists from `first` on."""
        a = self.edges[first]
        step = max(1, (1 << 21) // max(1, self.q.shape[1] - a))
        parts = [np.einsum("ij,ij->i", self.q[query[i:i + step], a:], self.c[at[i:i + step], a:])
                 for i in range(0, len(at), step)]
        return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)

    def lengths(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of queries and candidates on the lists from `first` on."""
        a = self.edges[first]
        return tuple(np.linalg.norm(m[:, a:].astype(float), axis=1) for m in (self.q, self.c))


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _scan(search: Search, pick):
    """The pairs (query, candidate, score) that `pick` finds in a tile, without a query's own row:
    the k best of each query, ties to smaller ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tile = _Tile(batch.slice(i, 1).to_pylist()[0], search.slices)
                query, at, score = pick(tile)
                ids = tile.ids[at]
                order = np.lexsort((ids, -score, query))
                order = order[tile.queries[query[order]] != ids[order]]
                place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
                order = order[place < search.k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[order]) for x in (tile.queries[query], score, ids)],
                    ["query_id", "score", "vec_id"])
    return run


def _heads(search: Search):
    """Phase 1: the rows at the head of each partial list."""
    def pick(tile: _Tile) -> Pairs:
        k, rows = search.k + 1, len(tile.queries)  # one place may be the query's own
        if len(tile.ids) <= k:
            heads = np.tile(np.arange(len(tile.ids)), (rows, 1))
        else:
            heads = np.concatenate([np.argpartition(-tile.partial(i), k - 1, axis=1)[:, :k]
                                    for i in range(search.slices)], 1)
        query = np.repeat(np.arange(rows), heads.shape[1])
        pairs = np.unique(query * len(tile.ids) + heads.ravel())
        query, at = np.divmod(pairs, max(1, len(tile.ids)))
        return query, at, tile.exact(query, at)
    return pick


def _collected(search: Search):
    """Phases 2 and 3: rows that the lists read leave within reach of the cutoff, then those that
    reach it."""
    def pick(tile: _Tile) -> Pairs:
        q, c = tile.lengths(0)
        asking = np.flatnonzero(_needed(tile.cuts, q) <= c.max(initial=0))
        tile.q, cuts = tile.q[asking], tile.cuts[asking]
        least = np.where(cuts == _NO_CUT, -np.inf, cuts.astype(float))[:, None]
        height = least / search.slices - np.abs(least) * 1e-12
        slack = _SLACK * q[asking, None]
        known = np.zeros((len(asking), len(c)), tile.q.dtype)
        seen = np.zeros(known.shape, bool)
        for i in range(search.slices):
            part = tile.partial(i)
            known += part
            seen |= part >= height
            ahead_q, ahead_c = tile.lengths(i + 1)
            room = ((ahead_q[:, None] * ahead_c + slack * c)
                    .astype(np.float64 if known.dtype == np.int64 else known.dtype))
            near = known + room >= least.astype(room.dtype)
            if i + 1 < search.slices and np.count_nonzero(near) < _FEW * near.size:
                break
        else:
            near &= seen
        query, at = np.nonzero(near)
        score = known[query, at].astype(np.int64) + tile.exact(query, at, i + 1)
        reached = score >= cuts[query]
        return asking[query[reached]], at[reached], score[reached]
    return pick


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, search: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of `vectors` (id, cells) that `is_query`
    marks; all candidates where there are fewer than k."""
    length = F.aggregate("cells", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    plain = vectors.withColumn("cut", F.lit(_NO_CUT)).sortWithinPartitions(length)
    candidates = _packed(plain, search.block_rows)
    asked = vectors.where(is_query)
    lists = _pairs(candidates, _packed(asked.withColumn("cut", F.lit(_NO_CUT)),
                                       search.query_rows)
                   ).mapInArrow(_scan(search, _heads(search)), _FOUND)
    cutoffs = (_ranked(lists, search.k).where(F.col("rank") == search.k)
               .select(F.col("query_id").alias("id"), F.col("score").alias("cut")))
    again = asked.join(cutoffs, "id", "left").select(
        "id", "cells", F.coalesce("cut", F.lit(_NO_CUT)).alias("cut"))
    found = _pairs(candidates, _packed(again, search.query_rows)
                   ).mapInArrow(_scan(search, _collected(search)), _FOUND)
    return _ranked(found, search.k).select("query_id", F.col("rank").cast("int"), "vec_id",
                                           "score")

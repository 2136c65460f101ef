"""Hashed text features and the linear models fitted to them.

Feature vectors are sparse rows (offsets, indices, values). A null or empty text has only the
constant that every row has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.memory import release
from tidegate.llm.text import TERMS, blocks, mix, span_hash, words

#: A row's features: offsets (one more than rows), indices, values.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def _slots(hashes: np.ndarray, family: int, bits: int) -> np.ndarray:
    salt = np.uint64(family * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return mix(hashes + salt) >> np.uint64(64 - bits)


def _counted(text: np.ndarray, slot: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Text number, slot and count of each slot that a text has."""
    keys, n = np.unique(text.astype(np.uint64) << np.uint64(bits) | slot, return_counts=True)
    return (keys >> np.uint64(bits)).astype(np.int64), \
        (keys & np.uint64((1 << bits) - 1)).astype(np.int64), n


def _rows(parts: list[tuple[np.ndarray, ...]], count: int) -> Rows:
    text, slot, value = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(text, kind="stable")
    offsets = np.zeros(count + 1, np.int64)
    np.cumsum(np.bincount(text, minlength=count), out=offsets[1:])
    return offsets, slot[order].astype(np.int32), value[order].astype(np.float32)


def style_features(data: np.ndarray, offsets: np.ndarray, bits: int) -> Rows:
    """Square roots of the shares of byte triples, of words, and of words that are and aren't
    the word before them: how a text is written rather than what it says."""
    count, parts = len(offsets) - 1, [_constant(len(offsets) - 1)]
    if len(data) > 2:
        wide = data.astype(np.uint64)
        triple = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
        text = np.repeat(np.arange(count), np.diff(offsets))
        inside = text[:-2] == text[2:]
        parts.append(_shares(text[:-2][inside], _slots(triple[inside], 1, bits), bits, count))
    hashes, _, _, starts, _ = words(data, offsets)
    if len(hashes):
        text = np.repeat(np.arange(count), np.diff(starts))
        parts.append(_shares(text, _slots(hashes, 2, bits), bits, count))
        after = text[1:] == text[:-1]
        same = (hashes[1:] == hashes[:-1])[after].astype(np.uint64)
        parts.append(_shares(text[1:][after], _slots(same, 3, bits), bits, count))
    return _rows(parts, count)


def _shares(text: np.ndarray, slot: np.ndarray, bits: int, count: int) -> tuple[np.ndarray, ...]:
    text, slot, n = _counted(text, slot, bits)
    total = np.bincount(text, n, count)
    return text, slot, np.sqrt(n / total[text])


def _constant(count: int) -> tuple[np.ndarray, ...]:
    return np.arange(count), np.zeros(count, np.int64), np.ones(count)


def term_features(data: np.ndarray, offsets: np.ndarray, bits: int) -> Rows:
    """Presence of each term (letters and digits, ASCII case folded) and of the beginnings of
    longer ones, 4 to 7 bytes."""
    count = len(offsets) - 1
    hashes, first, last, starts, rolled = words(data, offsets, TERMS)
    text = np.repeat(np.arange(count), np.diff(starts))
    found = [(text, _slots(hashes, 4, bits))]
    for size in range(4, 8):
        longer = last - first + 1 > size
        begin = span_hash(rolled, first[longer], first[longer] + size - 1)
        found.append((text[longer], _slots(begin, 5, bits)))
    text, slot, _ = _counted(*(np.concatenate([f[i] for f in found]) for i in (0, 1)), bits)
    return _rows([_constant(count), (text, slot, np.ones(len(text)))], count)


def feature_rows(texts: pa.Array, features: Callable, bits: int
                 ) -> Iterator[tuple[int, Rows]]:
    for first, data, offsets in blocks(texts):
        yield first, features(data, offsets, bits)


#: Features that a product holds as doubles at a time.
_HELD = 1 << 20


def _stretches(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `_HELD` features; one long row is a run."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + _HELD, "right")) - 1
        yield first, (end := min(max(end, first + 1), rows))
        first = end


def times(rows: Rows, weights: np.ndarray) -> np.ndarray:
    """Each row's product with the weights."""
    offsets, index, value = rows
    out = np.zeros(len(offsets) - 1)
    for a, b in _stretches(offsets):
        own, inside = offsets[a:b + 1] - offsets[a], slice(offsets[a], offsets[b])
        product = weights[index[inside]] * value[inside]
        if (own[1:] > own[:-1]).all():
            out[a:b] = np.add.reduceat(product, own[:-1])
        else:
            out[a:b] = np.bincount(np.repeat(np.arange(b - a), np.diff(own)), product, b - a)
    return out


def back(rows: Rows, residual: np.ndarray, size: int) -> np.ndarray:
    """The transposed product."""
    offsets, index, value = rows
    out = np.zeros(size)
    for a, b in _stretches(offsets):
        inside = slice(offsets[a], offsets[b])
        spread = np.repeat(residual[a:b], np.diff(offsets[a:b + 1]))
        out += np.bincount(index[inside], value[inside] * spread, size)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def minimize(target: Callable, start: np.ndarray, rounds: int, keep: int = 8) -> np.ndarray:
    """L-BFGS with step halving; `target` gives value and gradient."""
    x, (value, slope) = start, target(start)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, mult = -slope, []
        for s, y in reversed(past):
            a = (s @ step) / (s @ y)
            step = step - a * y
            mult.append(a)
        if past:
            s, y = past[-1]
            step = step * ((s @ y) / (y @ y))
        for (s, y), a in zip(past, reversed(mult)):
            step = step + s * (a - (y @ step) / (s @ y))
        size = 1.0 if past else 1.0 / max(1.0, float(np.abs(slope).sum()))
        drop = float(slope @ step)
        while size > 1e-9:
            new, (new_value, new_slope) = x + size * step, target(x + size * step)
            if new_value <= value + 1e-4 * size * drop:
                break
            size /= 2
        else:
            break
        s, y = new - x, new_slope - slope
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, slope = new, new_value, new_slope
        if s @ y > 1e-12:
            past = [*past[1 - keep:], (s, y)]
        if done:
            break
    return x


@dataclass
class Ordinal:
    """P(grade > k) = sigmoid(score - thresholds[k]) with one weight vector for all grades."""

    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades

    def tails(self, rows: Rows) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return sigmoid(times(rows, self.weights)[:, None] - self.thresholds)


def _compact(rows: Rows, size: int) -> tuple[Rows, np.ndarray]:
    """The rows over the slots that at least two of them have, and those slots."""
    offsets, index, value = rows
    shared = np.bincount(index, minlength=size) > 1
    number, kept = (np.cumsum(shared) - 1).astype(np.int32), shared[index]
    ends = np.concatenate(([0], np.cumsum(kept)))[offsets]
    return (ends, number[index[kept]], value[kept]), np.flatnonzero(shared)


def fit_ordinal(rows: Rows, grade: np.ndarray, grades: int, size: int, ridge: float = 1.0,
                rounds: int = 60, extra: np.ndarray | None = None) -> Ordinal:
    """Cumulative-link fit: the first threshold and the logarithms of the gaps are free, so the
    thresholds stay in order. A grade without rows keeps a narrow gap. `extra` are dense columns,
    whose weights follow the hashed ones."""
    dense = np.zeros((len(grade), 0)) if extra is None else extra
    hashed, (rows, used) = size, _compact(rows, size)
    own, size, cuts = len(grade), len(used), grades - 1
    wide = size + dense.shape[1]

    def thresholds(free: np.ndarray) -> np.ndarray:
        return free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))

    def target(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, free = x[:wide], x[wide:]
        score = times(rows, w[:size]) + dense @ w[size:]
        edge = np.concatenate(([-np.inf], thresholds(free), [np.inf]))
        high, low = sigmoid(edge[grade + 1] - score), sigmoid(edge[grade] - score)
        p = np.maximum(high - low, 1e-12)
        dh, dl = high * (1 - high) / p, low * (1 - low) / p
        at = np.bincount(grade, dh, grades)[:-1] - np.bincount(grade, dl, grades)[1:]
        gap = np.exp(free[1:])
        tail = np.cumsum(at[::-1])[::-1]
        slope_free = -np.concatenate(([tail[0]], tail[1:] * gap)) + 1e-3 * (free - start[wide:])
        slope_w = np.concatenate((back(rows, dh - dl, size), dense.T @ (dh - dl))) + ridge * w
        value = -np.log(p).sum() + 0.5 * ridge * (w @ w) \
            + 0.5e-3 * float(((free - start[wide:]) ** 2).sum())
        return float(value), slope_w + 0.0 if not cuts else np.concatenate((slope_w, slope_free))

    share = np.cumsum(np.bincount(grade, minlength=grades) + 0.5)[:-1] / (own + 0.5 * grades)
    logit = np.log(share / (1 - share))
    start = np.concatenate((np.zeros(wide), logit[:1], np.log(np.maximum(np.diff(logit), 1e-2))))
    x = minimize(target, start, rounds) if own else start
    weights = np.zeros(hashed + dense.shape[1])
    weights[used], weights[hashed:] = x[:size], x[size:wide]
    return Ordinal(weights, thresholds(x[wide:]))


ROW = "struct<index: array<int>, value: array<float>>"


def feature_column(text: Column, features: Callable, bits: int) -> Column:
    """Each text's features as a struct of lists."""
    @F.arrow_udf(ROW)
    def of(texts: pa.Array) -> pa.Array:
        release()
        rows = join_rows([r for _, r in feature_rows(texts, features, bits)])
        ends = pa.array(rows[0].astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(ends, pa.array(v)) for v in rows[1:]], ["index", "value"])
    return of(text)


def join_rows(parts: list[Rows]) -> Rows:
    offsets, base = [np.zeros(1, np.int64)], 0
    for part in parts:
        offsets.append(part[0][1:] + base)
        base += int(part[0][-1])
    return (np.concatenate(offsets),
            np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int32)]),
            np.concatenate([p[2] for p in parts] or [np.zeros(0, np.float32)]))


def rows_of(column: pa.ChunkedArray) -> Rows:
    """The features in a column made by `feature_column`."""
    parts = []
    for chunk in column.chunks:
        index, value = chunk.field("index"), chunk.field("value")
        sizes = index.value_lengths().to_numpy(zero_copy_only=False)
        parts.append((np.concatenate(([0], np.cumsum(sizes))).astype(np.int64),
                      np.asarray(index.flatten(), np.int32),
                      np.asarray(value.flatten(), np.float32)))
    return join_rows(parts)


def take_rows(rows: Rows, chosen: np.ndarray) -> Rows:
    """The rows where `chosen` holds."""
    offsets, index, value = rows
    sizes = np.diff(offsets)
    inside = np.repeat(chosen, sizes)
    return np.concatenate(([0], np.cumsum(sizes[chosen]))), index[inside], value[inside]


def share_of(key: Column, seed: int) -> Column:
    """A number from 0 up to 1, drawn by the key's hash."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int, seed: int
                    ) -> DataFrame:
    """(id, text, target) of about `most` labelled documents for each value of `target`, drawn by
    the hash of their id; all, where there are fewer. Rows with a null id or target and ids that
    have several labels are left out. `docs` has id and text, `labels` has id and target."""
    known = (labels.where(F.col("id").isNotNull() & F.col(target).isNotNull())
             .groupBy("id").agg(F.min(target).alias(target), F.max(target).alias("_high"))
             .where(F.col(target) == F.col("_high")).drop("_high"))
    sizes = {r[target]: r["count"] for r in known.groupBy(target).count().collect()}
    rate = F.lit(0.0)
    for value, n in sizes.items():
        rate = F.when(F.col(target) == value, min(1.0, most / n)).otherwise(rate)
    chosen = known.where(share_of(F.col("id"), seed) < rate)
    return docs.join(F.broadcast(chosen), "id")

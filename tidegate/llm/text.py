"""Vector tokenizing shared by the text operators: words of many texts as 64-bit hashes.

Works on UTF-8 bytes in blocks of about a quarter of a megabyte, so memory is bounded by the longest text.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the whole output."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def separator_table(separators: bytes) -> np.ndarray:
    """For each byte value, whether it can be part of a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words end at white space only, or at every ASCII byte that is no letter or digit.
WORDS = separator_table(WHITE)
TERMS = separator_table(bytes(b for b in range(128) if not chr(b).isalnum()))

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A"):ord("Z") + 1] += 32
_values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[str, np.ndarray] = {}


def folding(separators: bytes) -> bytes:
    """Table for `bytes.translate`: A-Z as a-z, and a space for each separator."""
    return bytes(0x20 if b in separators else int(_lower[b]) for b in range(256))


def slices(value: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """`value` in parts of about `size` bytes, cut at spaces only."""
    at = 0
    while at < len(value):
        end = value.find(b" ", at + size)
        end = len(value) if end < 0 else end
        yield value[at:end]
        at = end


def _power(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64."""
    out = np.full(count, np.uint64(base & _MASK))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling base and of its inverse; kept up to one block's length."""
    if count > BLOCK_BYTES + 1:
        return _power(_BASE, count), _power(pow(_BASE, -1, 1 << 64), count)
    if not _powers:
        _powers["up"] = _power(_BASE, BLOCK_BYTES + 1)
        _powers["down"] = _power(pow(_BASE, -1, 1 << 64), BLOCK_BYTES + 1)
    return _powers["up"][:count], _powers["down"][:count]


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about BLOCK_BYTES; one long row is a run."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def rolling_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums s and powers p: the rolling hash of [a, b) is (s[b] - s[a]) * p[b - 1]."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down[:len(values)], out=sums[1:])
    return sums, up


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORDS, lower: bool = True
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Hash, first and last byte of each word, and each text's first word number.

    The hash depends on the word's bytes and length only. The last value, prefix sums and
    powers, serves `prefixes`.
    """
    if lower:
        data = _lower[data]
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(start), np.flatnonzero(stop)
    rolled = rolling_sums(_values[data])
    return span_hash(rolled, first, last), first, last, np.searchsorted(first, offsets), rolled


def span_hash(rolled: tuple, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the bytes first..last, both included."""
    sums, up = rolled
    length = (last - first + 1).astype(np.uint64)
    return mix((sums[last + 1] - sums[first]) * up[last] + length * np.uint64(_BASE))


def shingles(hashes: np.ndarray, starts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Each text's distinct hashes (63 bits) of `size` neighbouring words, ascending.

    A text of fewer words has one, of the whole sequence; a text without words none.
    """
    base = [np.uint64(pow(_BASE, size - k, 1 << 64)) for k in range(size)]
    full = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k in range(size):
        full += hashes[k:k + len(full)] * base[k]
    full = mix(full) >> np.uint64(1)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= size:
            found = np.sort(full[a:b - size + 1])
            fresh = found[1:] != found[:-1]
            yield found if fresh.all() else found[np.concatenate(([True], fresh))]
        elif b > a:
            part = sum(int(h) * pow(_BASE, size - k, 1 << 64) for k, h in enumerate(hashes[a:b]))
            part = np.array([(part + (b - a) * 0xD1B54A32D192ED03) & _MASK], np.uint64)
            yield mix(part) >> np.uint64(1)
        else:
            yield full[:0]

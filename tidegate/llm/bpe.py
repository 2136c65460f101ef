"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each leaf holds the merge rank of a symbol and its right neighbour; inner nodes hold the minimum.
The root tells the lowest rank and, going left on ties, its leftmost place; a merge updates three
leaves and their ancestors. Short pre-tokens are merged many at a time: their trees are the rows
of one array. Long ones get a tree each, so a pre-token of n bytes takes O(n log n).

The file is in the JSON form of the public tokenizers library. The driver reads it and broadcasts
its tables, whose size is that of the vocabulary. Defined cases: a null text is empty and has no
ids; added tokens written out in a text become their id, as in that library; bytes that are no
UTF-8 after decoding become U+FFFD; null ids decode to an empty text. Texts are never cut. Ids and
texts are columns of the caller's frame: repeated rows get the same each, an empty table gives no
rows, other columns of any name are left alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.memory import release

NONE = np.iinfo(np.int32).max
#: Pre-tokens of more bytes get a tree of their own.
BATCH_BYTES = 512
#: A worker remembers between one and two times so many encoded chunks.
REMEMBERED = 100_000
BLOCK_CHARS = 1 << 21

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and numbers of the regex library's tables which the tokenizers library takes
#: as unassigned, as first and last code points.
_UNASSIGNED = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF
10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F
12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2
18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
_UNKNOWN = "[" + "".join("-".join(chr(int(end, 16)) for end in ends.split("-"))
                         for ends in _UNASSIGNED.split()) + "]"
_ODD = re.compile(_UNKNOWN)


def _pattern(letter: str, number: str, other: str) -> regex.Pattern:
    """The byte-level pre-tokenizer's pattern (fixed values)."""
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+"
        .replace(r"[^\s", "[^" + _SPACE).replace(r"\S", f"[^{_SPACE}]")
        .replace(r"\s", f"[{_SPACE}]"))


PRETOKENS = _pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
_ODD_PRETOKENS = _pattern(rf"(?:(?!{_UNKNOWN})\p{{L}})", rf"(?:(?!{_UNKNOWN})\p{{N}})",
                          rf"(?:[^\s\p{{L}}\p{{N}}]|{_UNKNOWN})")


def pretokens(text: str) -> list[str]:
    odd = not text.isascii() and _ODD.search(text)
    return (_ODD_PRETOKENS if odd else PRETOKENS).findall(text)


#: A space between two characters that aren't white: no pre-token reaches over its left end.
_GAP = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Memory:
    """Ids of chunks met before. The older half is forgotten when the newer one is full."""

    def __init__(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}

    def missing(self, chunks: set[str]) -> set[str]:
        """Those not known; all others are in `new` afterwards."""
        out = chunks - self.new.keys()
        again = out & self.old.keys()
        self.new.update((c, self.old[c]) for c in again)
        return out - again

    def __getstate__(self) -> dict:
        return {"new": {}, "old": {}}


@dataclass
class Vocabulary:
    first: np.ndarray  # id of each single byte
    pairs: np.ndarray  # left id << 32 | right id, ascending
    ranks: np.ndarray  # rank of each of `pairs`
    merged: np.ndarray  # id that a merge of each rank gives
    data: np.ndarray  # bytes of all ids, one after another
    ends: np.ndarray  # offsets of each id's bytes in `data`
    added: dict[str, int]
    heads: Memory = field(default_factory=lambda: Memory(), repr=False)  # ids of chunks
    rest: Memory = field(default_factory=lambda: Memory(), repr=False)  # with a space before them
    _by_pair: dict[int, int] = field(default_factory=dict, repr=False)

    def rank_by_pair(self) -> dict[int, int]:
        """Rank of each of `pairs`; made by the worker that first needs it."""
        if not self._by_pair:
            self._by_pair.update(zip(self.pairs.tolist(), self.ranks.tolist()))
        return self._by_pair

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it doesn't merge or a side is -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = (self.pairs[place] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[place], NONE).astype(np.int32)


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, letters = spec["model"], byte_letters()
    vocab = model["vocab"]
    missing = [c for c in letters if c not in vocab]
    if missing or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path} is no byte-level vocabulary; bytes without id: {len(missing)}")
    first = np.zeros(256, np.int32)
    for c, b in letters.items():
        first[b] = vocab[c]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges] or [-1], np.int64)
    merged = np.array([vocab[a + b] for a, b in merges] or [0], np.int32)
    order = np.argsort(keys, kind="stable")
    added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    pieces = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in added}
    pieces |= {i: t.encode() for t, i in added.items()}
    pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
    ends = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    return Vocabulary(first, keys[order], order.astype(np.int32), merged,
                      np.frombuffer(b"".join(pieces), np.uint8), ends, added)


def merge_one(symbols: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Ids of one pre-token, with a tree of its own."""
    n = len(symbols)
    size = 1 << (n - 1).bit_length()
    tree = np.full(2 * size, NONE, np.int32)
    tree[size:size + n - 1] = vocab.rank_of(symbols[:-1], symbols[1:])
    level = size
    while level > 1:
        level >>= 1
        tree[level:2 * level] = np.minimum(tree[2 * level:4 * level:2],
                                           tree[2 * level + 1:4 * level:2])
    tree, ids = tree.tolist(), symbols.tolist()
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    rank_of = vocab.rank_by_pair()

    def put(leaf: int, value: int) -> None:
        leaf += size
        tree[leaf] = value
        while leaf > 1:
            leaf >>= 1
            low = min(tree[2 * leaf], tree[2 * leaf + 1])
            if tree[leaf] == low:
                break
            tree[leaf] = low

    while tree[1] != NONE:
        rank, i = tree[1], 1
        while i < size:
            i = 2 * i if tree[2 * i] == rank else 2 * i + 1
        i -= size
        j, b = after[i], before[i]
        k = after[j]
        ids[i], ids[j] = int(vocab.merged[rank]), -1
        after[i] = k
        if k >= 0:
            before[k] = i
        put(j, NONE)
        put(i, rank_of.get(ids[i] << 32 | ids[k], NONE) if k >= 0 else NONE)
        if b >= 0:
            put(b, rank_of.get(ids[b] << 32 | ids[i], NONE))
    return np.array([x for x in ids if x >= 0], np.int32)


def merge_many(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Ids (int32, as bytes) of pre-tokens of at most BATCH_BYTES bytes each, with the trees of
    equally large ones as rows of one array."""
    out: list[bytes] = [b""] * len(words)
    sizes: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        sizes.setdefault(1 << (len(word) - 1).bit_length(), []).append(at)
    for size, places in sizes.items():
        step = max(1, 500_000 // size)
        for a in range(0, len(places), step):
            some = places[a:a + step]
            for at, ids in zip(some, _merge_rows([words[p] for p in some], size, vocab)):
                out[at] = ids
    return out


def _merge_rows(words: list[bytes], size: int, vocab: Vocabulary) -> list[bytes]:
    count = len(words)
    lengths = np.array([len(w) for w in words])
    inside = np.arange(size) < lengths[:, None]
    ids = np.full((count, size + 1), -1, np.int32)  # the last column stands for "no neighbour"
    ids[:, :-1][inside] = vocab.first[np.frombuffer(b"".join(words), np.uint8)]
    after = np.tile(np.arange(1, size + 2), (count, 1))
    after[np.arange(count), lengths - 1] = size
    before = np.tile(np.arange(-1, size), (count, 1))
    before[:, 0] = size
    tree = np.full((count, 2 * size), NONE, np.int32)
    tree[:, size:] = vocab.rank_of(ids[:, :size], ids[:, 1:size + 1])
    level = size
    while level > 1:
        level >>= 1
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2],
                                              tree[:, 2 * level + 1:4 * level:2])
    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        rank = tree[rows, 1]
        node = np.ones(len(rows), np.int64)
        while node[0] < size:
            node *= 2
            node += tree[rows, node] != rank
        i = node - size
        j, b = after[rows, i], before[rows, i]
        k = after[rows, j]
        ids[rows, i], ids[rows, j] = vocab.merged[rank], -1
        after[rows, i] = k
        before[rows, k] = i
        here = ids[rows, i]
        both = vocab.rank_of(np.concatenate((here, ids[rows, b])),
                             np.concatenate((ids[rows, k], here)))
        tree[rows, j + size] = NONE
        tree[rows, i + size] = both[:len(rows)]
        real = b < size
        tree[rows[real], b[real] + size] = both[len(rows):][real]
        r = np.concatenate((rows, rows, rows[real]))
        node = np.concatenate((i, j, b[real])) + size
        for _ in range(size.bit_length() - 1):
            node >>= 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
        rows = rows[tree[rows, 1] != NONE]
    alive = ids >= 0
    flat, ends = ids[alive].tobytes(), (4 * np.cumsum(alive.sum(axis=1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _encode_pretokens(pretokens: list[str], vocab: Vocabulary) -> list[bytes]:
    raw = [t.encode() for t in pretokens]
    out = dict(zip((w for w in raw if len(w) <= BATCH_BYTES),
                   merge_many([w for w in raw if len(w) <= BATCH_BYTES], vocab)))
    for w in raw:
        if len(w) > BATCH_BYTES:
            out[w] = merge_one(vocab.first[np.frombuffer(w, np.uint8)], vocab).tobytes()
    return [out[w] for w in raw]


def _learn(heads: set[str], rest: set[str], vocab: Vocabulary) -> None:
    """Have the memories hold the chunks' ids: letters alone are one pre-token, others are cut."""
    vocab.heads.forget()
    vocab.rest.forget()
    rest = vocab.rest.missing(rest)
    cut = [(vocab.rest, c, pretokens(" " + c)) for c in rest if not c.isalpha()]
    cut += [(vocab.heads, c, pretokens(c)) for c in vocab.heads.missing(heads)]
    parts = {t for _, _, found in cut for t in found}
    spaced = vocab.rest.missing({t[1:] for t in parts if t[0] == " " and len(t) > 1})
    spaced |= {c for c in rest if c.isalpha()}
    plain = vocab.heads.missing({t for t in parts if t[0] != " " or len(t) == 1})
    known, first = vocab.rest.new, vocab.heads.new
    known.update(zip(spaced, _encode_pretokens([" " + c for c in spaced], vocab)))
    first.update(zip(plain, _encode_pretokens(list(plain), vocab)))
    for memory, chunk, found in cut:
        memory.new[chunk] = b"".join([known[t[1:]] if t[0] == " " and len(t) > 1 else first[t]
                                      for t in found])


def _split(text: str) -> list[str]:
    """Chunks whose pre-tokens don't depend on each other; a space stands before all but one."""
    if _WIDE.search(text) or text[:1] == " " or text[-1:] == " ":
        return _GAP.split(text)
    return text.split(" ")


def encode_plain(texts: list[str], vocab: Vocabulary) -> list[bytes]:
    """Ids (int32, as bytes) of texts without added tokens."""
    split = [_split(t) if t else [] for t in texts]
    rest: set[str] = set()
    for s in split:
        rest.update(s[1:])
    _learn({s[0] for s in split if s}, rest, vocab)
    heads, known = vocab.heads.new, vocab.rest.new
    return [heads[s[0]] + b"".join([known[c] for c in s[1:]]) if s else b"" for s in split]


def encode_texts(texts: list[str], vocab: Vocabulary) -> list[bytes]:
    """Ids (int32, as bytes) of each text."""
    marks = re.compile("(" + "|".join(map(re.escape, sorted(vocab.added, key=len, reverse=True)))
                       + ")") if vocab.added else None
    out: list[bytes] = []
    block: list[str] = []
    plan: list[list[int]] = []  # of each text: places in the block, or -1 - id of an added token

    def flush() -> None:
        ids = encode_plain(block, vocab)
        for items in plan:
            out.append(b"".join(ids[x] if x >= 0 else np.int32(-1 - x).tobytes() for x in items))
        block.clear()
        plan.clear()

    held = 0
    for text in texts:
        items = []
        for part in marks.split(text) if marks and marks.search(text) else (text,):
            if part in vocab.added:
                items.append(-1 - vocab.added[part])
            elif part:
                items.append(len(block))
                block.append(part)
        plan.append(items)
        held += len(text)
        if held > BLOCK_CHARS:
            flush()
            held = 0
    flush()
    return out


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    """The ids' bytes; an id out of range raises IndexError."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(vocab.ends) - 1):
        raise IndexError("an id that the vocabulary doesn't have")
    start, length = vocab.ends[ids], vocab.ends[ids + 1] - vocab.ends[ids]
    total = np.concatenate(([0], np.cumsum(length)))
    return vocab.data[np.arange(total[-1]) + np.repeat(start - total[:-1], length)].tobytes()


def _lists(found: list[bytes]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                    pa.array(np.frombuffer(b"".join(found), np.int32)))


def _texts(lists: pa.Array, vocab: Vocabulary) -> pa.Array:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.array([decode_ids(flat[a:b], vocab).decode("utf-8", "replace")
                     for a, b in zip(ends[:-1], ends[1:])], pa.string())


#: Texts of a batch that are held as Python strings at a time.
SLICE = 500


def _encoded(texts: pa.Array, vocab: Vocabulary) -> Iterator[pa.Array]:
    release()
    for a in range(0, len(texts), SLICE):
        part = texts.slice(a, SLICE).to_pylist()
        yield _lists(encode_texts([t or "" for t in part], vocab))


class Bpe:
    """Columns for encoding and decoding with the vocabulary at `path`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.shared = spark.sparkContext.broadcast(load(path))

    def encode(self, text: Column) -> Column:
        shared = self.shared

        @F.arrow_udf("array<int>")
        def of(texts: pa.Array) -> pa.Array:
            parts = list(_encoded(texts, shared.value))
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
        return of(text)

    def decode(self, ids: Column) -> Column:
        shared = self.shared

        @F.arrow_udf("string")
        def of(lists: pa.Array) -> pa.Array:
            return _texts(lists, shared.value)
        return of(ids)

    def round_trip(self, text: Column) -> Column:
        """Struct (ids, decoded) with what the ids decode to. Two chained functions would have
        Spark encode twice."""
        shared = self.shared

        @F.arrow_udf("struct<ids: array<int>, decoded: string>")
        def of(texts: pa.Array) -> pa.Array:
            parts = [pa.StructArray.from_arrays([ids, _texts(ids, shared.value)],
                                                ["ids", "decoded"])
                     for ids in _encoded(texts, shared.value)]
            return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
                [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]))
        return of(text)

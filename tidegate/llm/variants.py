"""Spelling variant grouping by composing finite-state machines.

Two words are near if they differ by exactly one inserted, deleted or replaced letter (code
point). The vocabulary acceptor, composed with a one-edit transducer and the acceptor again,
accepts just the near pairs.

* Of a near pair whose longer word has M letters, M - 1 letters agree, counted from both ends. So
  the words share a beginning of about half of them, or else an end: the composition is cut into
  partitions, each of which starts in the state that this half leads to. A word goes to two
  partitions for each M, its own length and one more.
* A partition of more than `tile` words is cut again, by half of the letters that its words don't
  share yet, until there is a single letter left that may differ. A partition entered by its end
  only takes pairs that differ before the letter at which its sibling begins, so each pair is found
  in exactly one partition.
* In a partition the words' remaining letters make a minimised acceptor; words of M and of M - 1
  letters have a root each and share their states. States that lead to no near pair are left out.
  Only partial counts and the best partner of each word leave a task.

Defined cases: null texts have no words; a null id is the empty string in the hash of `thinned_words`;
rows that repeat an id count as rows of their own; an empty table gives an empty one; very long
texts are read in slices; ties go to the smaller word in code-point order; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.memory import release
from tidegate.llm.storing import stored
from tidegate.llm.text import folding, slices

_FOLD = folding(bytes(b for b in range(128) if not chr(b).isalpha()))
_RUN = re.compile("[a-zÀ-ÿ]+")
#: Different words that a task counts before it hands on its counts.
_FLUSH = 1 << 17
_KEY = ["longer", "begin", "end", "below", "head", "tail"]


@dataclass(frozen=True)
class Variants:
    """Least letters and occurrences of a word, how many times as frequent its form must be, the
    words from which on a partition is cut, and about how many words a task takes at a time."""

    letters: int = 7
    times: int = 2
    ratio: int = 10
    tile: int = 2048
    rows: int = 50_000

    def __post_init__(self) -> None:
        if min(self.letters, self.times, self.ratio, self.tile, self.rows) <= 0:
            raise ValueError("all settings must be positive")


def thinned_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rule: Variants = Variants()) -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, of which one in 31 by the hash
    of id and run lost a letter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            release()
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                start = zlib.crc32(f"{'' if key.as_py() is None else key.as_py()}:".encode())
                for part in slices((text.as_py() or b"").translate(_FOLD)):
                    for word, n in Counter(_RUN.findall(part.decode())).items():
                        if len(word) < rule.letters:
                            continue
                        h = zlib.crc32(word.encode(), start)
                        if h % 31 == 0:
                            word = word[:h % len(word)] + word[h % len(word) + 1:]
                        if len(word) >= rule.letters:
                            total[word] += n
                    if len(total) >= _FLUSH:
                        yield flush()
        if total:
            yield flush()

    counted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "word string, n long")
    return (counted.groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= rule.times))


def _spelled(path: tuple | None) -> str:
    """The letters of a path, each step of which is (path before, letter)."""
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


class Acceptor:
    """Minimised acceptor of words. A state is the tuple of its (letter, state) pairs; states with
    equal continuations are one, whatever root they are reached from. State 0 ends a word."""

    def __init__(self) -> None:
        self.states: list[dict[str, int]] = [{}]
        self._known: dict[tuple, int] = {(): 0}
        self._common: dict[tuple[int, int], list[str]] = {}

    def root(self, words: list[str]) -> int | None:
        """The state that accepts `words`: ascending, distinct and equally long."""
        if not words:
            return None
        path: list[dict[str, int]] = [{}]
        last = ""

        def close(length: int) -> None:
            while len(path) > length + 1:
                state = self._state(path.pop())
                path[-1][last[len(path) - 1]] = state

        for word in words:
            same = 0
            while same < len(last) and last[same] == word[same]:
                same += 1
            close(same)
            path.extend({} for _ in word[same:])
            last = word
        close(0)
        return self._state(path[0])

    def _state(self, edges: dict[str, int]) -> int:
        key = tuple(edges.items())
        found = self._known.setdefault(key, len(self.states))
        if found == len(self.states):
            self.states.append(edges)
        return found

    def common(self, p: int, q: int) -> list[str]:
        """Continuations that both states accept."""
        key = (p, q) if p <= q else (q, p)
        found = self._common.get(key)
        if found is None:
            found, todo = [], [(p, q, None)]
            while todo:
                a, b, path = todo.pop()
                if a == 0 or b == 0:
                    if a == b:
                        found.append(_spelled(path))
                    continue
                other = self.states[b]
                todo += [(x, other[c], (path, c)) for c, x in self.states[a].items()
                         if c in other]
            self._common[key] = found
        return found

    def replaced(self, root: int, below: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs of equal length that differ in one letter, before the letter `below`."""
        pairs: dict[int, list[tuple[str, str, list[str]]]] = {}
        useful: dict[int, bool] = {}
        order, seen = [root], {root}
        for state in order:
            for x in self.states[state].values():
                if x not in seen:
                    seen.add(x)
                    order.append(x)
        for state in sorted(order):  # states are numbered after those that they lead to
            edges = sorted(self.states[state].items())
            own = [(c, d, both) for i, (c, x) in enumerate(edges) for d, y in edges[i + 1:]
                   if (both := self.common(x, y))]
            pairs[state] = own
            useful[state] = bool(own) or any(useful[x] for _, x in edges)
        todo = [(root, 0, None)]
        while todo:
            state, depth, path = todo.pop()
            if depth >= below or not useful[state]:
                continue
            so_far = _spelled(path) if pairs[state] else ""
            for c, d, both in pairs[state]:
                for rest in both:
                    yield so_far + c + rest, so_far + d + rest
            todo += [(x, depth + 1, (path, c)) for c, x in self.states[state].items()]

    def deleted(self, root: int, shorter: int, below: int, after: str = ""
                ) -> Iterator[tuple[str, str]]:
        """Accepted pairs of which the second lacks a letter of the first, before `below`. Of a
        run of equal letters the last counts as the missing one; `after` follows all words."""
        todo = [(root, shorter, 0, None)]
        while todo:
            p, q, depth, path = todo.pop()
            if depth >= below:
                continue
            other = self.states[q]
            for c, x in self.states[p].items():
                for rest in self.common(x, q):
                    if (rest or after)[:1] != c:
                        so_far = _spelled(path)
                        yield so_far + c + rest, so_far + rest
                if c in other:
                    todo.append((x, other[c], depth + 1, (path, c)))


def near_pairs(words: list[str], longer: int, begin: int = 0, end: int = 0,
               below: int | None = None) -> Iterator[tuple[str, str]]:
    """Near pairs of which the first word has `longer` letters, among words that share their first
    `begin` and last `end` letters, that differ first before the letter `below` (from 0)."""
    below = longer if below is None else below
    inner = [sorted(w[begin:len(w) - end] for w in set(words) if len(w) == n)
             for n in (longer, longer - 1)]
    if not inner[0]:
        return
    machine = Acceptor()
    root, shorter = (machine.root(x) for x in inner)
    head, tail = words[0][:begin], words[0][len(words[0]) - end:]
    for u, v in machine.replaced(root, below - begin):
        yield head + u + tail, head + v + tail
    if shorter is not None:
        for u, v in machine.deleted(root, shorter, below - begin, tail):
            yield head + u + tail, head + v + tail


def _cut(rows: DataFrame) -> DataFrame:
    """Each partition as two, by half of the letters that aren't fixed yet."""
    left = F.col("longer") - 1 - F.col("begin") - F.col("end")
    half = F.floor((left + 2) / 2).cast("int")
    first = F.struct("longer", (F.col("begin") + half).alias("begin"), "end", "below")
    second = F.struct("longer", "begin", (F.col("end") + left - half + 1).alias("end"),
                      (F.col("begin") + half).alias("below"))
    return (rows.select("word", "n", F.explode(F.array(first, second)).alias("to"))
            .select("to.*", F.expr("left(word, to.begin)").alias("head"),
                    F.expr("right(word, to.end)").alias("tail"), "word", "n"))


def partitions(words: DataFrame, rule: Variants = Variants()) -> tuple[DataFrame, int]:
    """The words (word, n) at their partitions, and the number of rows."""
    length, zero = F.char_length("word"), F.lit(0)
    whole = words.select(
        F.explode(F.array(length, length + 1)).alias("longer"), zero.alias("begin"),
        zero.alias("end"), "word", "n").withColumn("below", F.col("longer"))
    level, done, rows = stored(_cut(whole)), None, 0
    while True:
        sizes = level.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("words"))
        more = F.col("longer") - 1 > F.col("begin") + F.col("end")
        large = stored(sizes.where((F.col("words") > rule.tile) & more).select(*_KEY))
        cut = not large.isEmpty()
        ready = stored(level.join(large, _KEY, "left_anti")) if cut else level
        rows += ready.count()
        done = ready if done is None else done.unionByName(ready.select(*done.columns))
        if not cut:
            return done, rows
        level = stored(_cut(level.join(large, _KEY, "left_semi")))


def neighbours(words: DataFrame, rule: Variants = Variants()) -> DataFrame:
    """(word, n_near, best): how many near words each word has, if any, and the one of largest n
    as a struct (minus n, word)."""
    placed, rows = partitions(words, rule)
    buckets = max(1, -(-rows // rule.rows))

    def run(table: pa.Table) -> pa.Table:
        release()
        groups = defaultdict(list)
        for *key, word, n in zip(*(table.column(c).to_pylist() for c in (*_KEY, "word", "n"))):
            groups[tuple(key)].append((word, n))
        n_near: Counter[str] = Counter()
        best: dict[str, tuple[int, str]] = {}
        for (longer, begin, end, below, _, _), group in groups.items():
            if len(group) < 2:
                continue
            times = dict(group)
            for pair in near_pairs(list(times), longer, begin, end, below):
                for word, other in (pair, pair[::-1]):
                    n_near[word] += 1
                    rank = (-times[other], other)
                    if word not in best or rank < best[word]:
                        best[word] = rank
        names = list(n_near)
        return pa.table({
            "word": pa.array(names, pa.string()),
            "n_near": pa.array([n_near[w] for w in names], pa.int64()),
            "less": pa.array([best[w][0] for w in names], pa.int64()),
            "near": pa.array([best[w][1] for w in names], pa.string())})

    found = (placed.withColumn("bucket", F.pmod(F.xxhash64(*_KEY), F.lit(buckets)))
             .groupBy("bucket").applyInArrow(run, "word string, n_near long, less long, near string"))
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("less", "near")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following `form` from each word of (word, form) ends. A form is more
    frequent than its word, so this ends; each round doubles the steps taken."""
    links = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        step = links.select(F.col("word").alias("at"), F.col("root").alias("to"))
        longer = stored(links.join(step, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")))
        links = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return links


def variants(words: DataFrame, rule: Variants = Variants()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n): the near word of largest
    n if that is at least `ratio` times the word's own, and where following forms ends."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")))
    best_n = -F.col("best.less")
    enough = best_n >= rule.ratio * F.col("n")
    known = stored(words.join(neighbours(words, rule), "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, best_n).alias("form_n")))
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

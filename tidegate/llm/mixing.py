"""Mixing sources to target weights by iterative proportional fitting.

Token counts per cell (source, language, topic) are raked until the expected sample's sums by
source, by language and by topic meet the target shares, and each document of a cell is kept with a
probability that follows from the cell's raked weight. Only the table of cells is iterated on;
documents are read once for their topic and token count and once to be chosen.

* The expected sample has `keep` of all tokens. A value that has fewer tokens than its share of
  these keeps all it has, and the others share the rest in proportion to their targets: a rare value
  costs what it lacks, and not the size of the sample. `gaps` tells what each value got.
* A probability is at most 1. A round meets each margin in turn by scaling the cells below 1, until
  all margins are within `gap`. Margins that contradict each other never are; the fit then ends when
  `patience` rounds have not brought it nearer, and warns.
* Documents of a cell are taken in the order of a hash of their id until their tokens reach the
  cell's part; the one that would exceed it is kept with the probability that makes up for it. So
  the sample itself has the expected shares but for a part of a document per cell. Equal ids are kept or dropped together, and a rerun chooses the same.

Cells of at most `BROADCAST_BYTES` are fitted on the driver, larger tables by a Spark job per
round; both take the same steps.

Defined cases: null source or language is a value of its own; a null text is empty; documents
without words have no weight in the fit and are kept with the probability `keep`; a target may
name a value that no document has, and a value without a target keeps its share: in both cases
the targets are scaled to add up to 1 over the values that occur; an empty table stays empty; rows
that repeat an id, or have none, are drawn as one; extra columns stay, whatever their names.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.linear import share_of
from tidegate.llm.memory import release
from tidegate.llm.storing import stored, unused
from tidegate.llm.text import TERMS, blocks, words
from tidegate.operators.running import running_total

MARGINS = ("source", "lang", "topic")


#: Names of cells up to this size go to the driver, or from there to the executors.
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class Mix:
    """Expected share of tokens to keep; exponent by which shares without a given target are
    evened out (1: as they are, 0: all equal); number of topics; least bytes of a topic's word; the
    largest relative gap to a target at which the fit ends, and the rounds without progress after
    which it ends with a larger one."""

    keep: float = 0.8
    evenness: float = 0.7
    topics: int = 8
    topic_bytes: int = 5
    gap: float = 1e-3
    patience: int = 20
    seed: int = 41

    def __post_init__(self) -> None:
        if not 0 < self.keep <= 1 or self.topics <= 0 or self.patience <= 0:
            raise ValueError("keep must be in (0, 1], topics and patience positive")


def subject(text: Column, rule: Mix = Mix()) -> Column:
    """Struct (tokens, topic): the number of words, and a topic from the whole text: the hash of
    its most frequent word of at least `topic_bytes` bytes, ties to the smaller hash; topic 0 for
    texts without such a word."""
    @F.arrow_udf("struct<tokens: long, topic: int>")
    def of(texts: pa.Array) -> pa.Array:
        release()
        tokens, topic = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int32)
        for first, data, offsets in blocks(texts):
            hashes, begin, end, starts, _ = words(data, offsets, TERMS)
            count = len(offsets) - 1
            owner = np.repeat(np.arange(count), np.diff(starts))
            tokens[first:first + count] = np.diff(starts)
            long = end - begin + 1 >= rule.topic_bytes
            own, word = owner[long], hashes[long]
            if not len(own):
                continue
            order = np.lexsort((word, own))
            own, word = own[order], word[order]
            fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (word[1:] != word[:-1])))
            at = np.flatnonzero(fresh)
            times = np.diff(np.append(at, len(own)))
            best = np.lexsort((word[at], -times, own[at]))
            lead = best[np.concatenate(([True], own[at][best][1:] != own[at][best][:-1]))]
            topic[first + own[at][lead]] = 1 + word[at][lead] % np.uint64(max(1, rule.topics - 1))
        return pa.StructArray.from_arrays([pa.array(tokens), pa.array(topic)],
                                          ["tokens", "topic"])
    return of(text)


def cells_of(docs: DataFrame) -> DataFrame:
    """(source, lang, topic, tokens) of documents that have words."""
    return (docs.where("tokens > 0").groupBy(*MARGINS)
            .agg(F.sum("tokens").cast("double").alias("tokens")))


def targets_of(cells: DataFrame, margin: str, given: dict | None, rule: Mix) -> DataFrame:
    """(value, sum, asked): the tokens of each value, and the share that it is to have."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("sum"))
    total = F.lit(float(sums.agg(F.sum("sum")).first()[0] or 1.0))
    own = F.pow(F.col("sum") / total, F.lit(rule.evenness))
    wish = F.lit(None).cast("double")
    for value, share in (given or {}).items():
        wish = F.when(F.col(margin).eqNullSafe(F.lit(value)), float(share)).otherwise(wish)
    if given:
        own = F.coalesce(wish, F.col("sum") / total)
    rows = stored(sums.select(F.col(margin).alias("value"), "sum", own.alias("asked")))
    whole = F.lit(float(rows.agg(F.sum("asked")).first()[0] or 1.0))
    return stored(rows.select("value", "sum", (F.col("asked") / whole).alias("asked")))


def reachable(wanted: DataFrame, kept: float) -> DataFrame:
    """`wanted` with `target`, the tokens of each value in a sample of `kept`: the share asked for,
    or all that the value has if that is less, and then the others have more."""
    scale = 1.0
    while True:
        lacks = F.col("asked") * F.lit(scale * kept) >= F.col("sum")
        got = wanted.agg(F.sum(F.when(lacks, F.col("sum")).otherwise(0.0)).alias("all"),
                         F.sum(F.when(lacks, 0.0).otherwise(F.col("asked"))).alias("rest")).first()
        new = (kept - got["all"]) / (got.rest * kept) if got.rest else scale
        if new <= scale * (1 + 1e-12):  # each step sets more values aside, of which there are few
            return stored(wanted.withColumn(
                "target", F.least("sum", F.col("asked") * F.lit(scale * kept))))
        scale = new


class _Progress:
    """Whether a fit goes on after a round that left the largest relative gap `worst`."""

    def __init__(self, rule: Mix) -> None:
        self.rule, self.best, self.waited = rule, float("inf"), 0

    def goes_on(self, worst: float) -> bool:
        if worst < self.rule.gap:
            return False
        self.waited = 0 if worst < 0.9 * self.best else self.waited + 1
        self.best = min(worst, self.best)
        if self.waited < self.rule.patience:
            return True
        warnings.warn(f"the margins contradict each other: a share is off by {worst:.3g} of it")
        return False


#: Factors may grow without end where margins contradict each other.
_MOST = 1e9


def _fit_many(cells: DataFrame, targets: dict[str, DataFrame], rule: Mix) -> DataFrame:
    rate, full = F.col("rate"), F.col("rate") >= 1
    fit, progress, worst = cells.withColumn("rate", F.lit(rule.keep)), _Progress(rule), None
    while worst is None or progress.goes_on(worst):
        seen = []
        for margin, target in targets.items():
            sums = fit.groupBy(margin).agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("full"),
                F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * rate)).alias("free"),
                F.sum(F.col("tokens") * rate).alias("every"))
            wish = F.col("target")
            factor = (F.when((wish > F.col("full")) & (F.col("free") > 0),
                             F.try_divide(wish - F.col("full"), F.col("free")))
                      .when(wish >= F.col("full"), 1.0)
                      .otherwise(F.try_divide(wish, F.col("every"))))
            gap = F.abs(F.try_divide(F.col("full") + F.col("free"), wish) - 1)
            step = sums.join(target, F.col(margin).eqNullSafe(F.col("value"))).select(
                "value", factor.alias("factor"), gap.alias(f"gap_{margin}"))
            fit = fit.join(step, F.col(margin).eqNullSafe(F.col("value")), "left").select(
                *MARGINS, "tokens", F.least(rate * F.coalesce("factor", F.lit(1.0)), F.lit(_MOST))
                .alias("rate"), *seen, F.coalesce(f"gap_{margin}", F.lit(0.0))
                .alias(f"gap_{margin}"))
            seen.append(f"gap_{margin}")
        fit = stored(fit)
        worst = fit.agg(F.max(F.greatest(*seen))).first()[0] or 0.0
        fit = fit.drop(*seen)
    return fit.withColumn("rate", F.least(F.lit(1.0), rate))


def _fit_few(cells: DataFrame, targets: dict[str, DataFrame], rule: Mix) -> DataFrame:
    table = cells.toArrow()
    tokens, margins = table.column("tokens").to_numpy(), []
    for margin, target in targets.items():
        own = table.column(margin).combine_chunks().dictionary_encode("encode")
        wish = {r.value: r.target for r in target.collect()}
        margins.append((own.indices.to_numpy(),
                        np.array([wish[v] for v in own.dictionary.to_pylist()], float)))
    rate, progress, worst = np.full(len(tokens), rule.keep), _Progress(rule), None
    while worst is None or progress.goes_on(worst):
        worst = 0.0
        for code, wish in margins:
            def added(values: np.ndarray) -> np.ndarray:
                return np.bincount(code, values, len(wish))
            full, every = rate >= 1, added(tokens * rate)
            ones, free = added(tokens * full), added(tokens * rate * ~full)
            some = wish > 0
            worst = max(worst, np.abs((ones + free)[some] / wish[some] - 1).max(initial=0.0))
            factor = np.where(wish >= ones, 1.0, wish / np.where(every > 0, every, 1.0))
            step = (wish > ones) & (free > 0)
            factor[step] = (wish - ones)[step] / free[step]
            rate = np.minimum(rate * factor[code], _MOST)
    return cells.sparkSession.createDataFrame(
        table.append_column("rate", pa.array(np.minimum(1.0, rate))))


def _small(cells: DataFrame) -> bool:
    """Whether the cells, with their names, are at most `BROADCAST_BYTES`."""
    size = F.coalesce(F.octet_length("source"), F.lit(0)) + F.coalesce(
        F.octet_length("lang"), F.lit(0)) + F.lit(64)
    return (cells.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES


def _same_cell(suffix: str) -> Column:
    source, lang, topic = (F.col(m).eqNullSafe(F.col(m + suffix)) for m in MARGINS)
    return source & lang & topic


def fitted(own: DataFrame, targets: dict[str, dict] | None = None, rule: Mix = Mix()
           ) -> DataFrame:
    """(source_of, lang_of, topic_of, rate, cutoff) of each cell of documents (doc_id, source, lang,
    topic, tokens): the probability, and the draw from which on documents are dropped (null: none).
    `targets` may give shares by margin; the shares of the others are evened out."""
    cells = stored(cells_of(own))
    kept = rule.keep * float(cells.agg(F.sum("tokens")).first()[0] or 0.0)
    wanted = {m: reachable(targets_of(cells, m, (targets or {}).get(m), rule), kept)
              for m in MARGINS}
    fit = stored((_fit_few if _small(cells) else _fit_many)(cells, wanted, rule).select(
        *[F.col(m).alias(f"{m}_of") for m in MARGINS],
        (F.col("tokens") * F.col("rate")).alias("part"), "rate"))
    drawn = own.where("tokens > 0").join(
        F.broadcast(fit) if _small(cells) else fit, _same_cell("_of")).select(
        *MARGINS, "tokens", "part", share_of(F.col("doc_id"), rule.seed).alias("draw"),
        (F.col("tokens") * share_of(F.col("doc_id"), rule.seed + 1)).alias("luck"))
    upto = running_total(drawn, list(MARGINS), ["draw", "tokens"], "upto", F.col("tokens"))
    beyond = upto.where(F.col("upto") - F.col("luck") > F.col("part"))
    cutoffs = beyond.groupBy(*MARGINS).agg(F.min("draw").alias("cutoff"))
    return stored(fit.join(cutoffs, _same_cell("_of"), "left").select(
        *[f"{m}_of" for m in MARGINS], "rate", "cutoff"))


def chosen(docs: DataFrame, key: Column, cell: Column, cells: DataFrame, name: str,
           rule: Mix = Mix()) -> DataFrame:
    """`docs` with the struct `name` of `rate` and `keep`. `cell` is a struct of the margins and
    `tokens` of each row; `cells` comes from `fitted`."""
    own = unused(docs, "cell")
    named = cells.select(*[F.col(f"{m}_of").alias(m) for m in MARGINS])
    small = F.broadcast if _small(named) else (lambda frame: frame)
    told, at = unused(docs, "fit"), F.col(own)
    marked = docs.withColumn(own, cell).join(
        small(cells.select(F.struct("*").alias(told))),
        at["source"].eqNullSafe(F.col(f"{told}.source_of"))
        & at["lang"].eqNullSafe(F.col(f"{told}.lang_of"))
        & at["topic"].eqNullSafe(F.col(f"{told}.topic_of")), "left")
    draw, some = share_of(key, rule.seed), at["tokens"] > 0
    rate = F.when(some, F.col(f"{told}.rate")).otherwise(F.lit(rule.keep))
    keep = F.when(some, draw < F.coalesce(f"{told}.cutoff", F.lit(2.0))).otherwise(
        draw < F.lit(rule.keep))
    return marked.withColumn(name, F.struct(rate.alias("rate"), keep.alias("keep"))).drop(own, told)


def described(docs: DataFrame, rule: Mix = Mix()) -> DataFrame:
    """(doc_id, source, lang, topic, tokens) of each document, kept in the shared folder so that
    texts are read once."""
    own = docs.select("doc_id", "source", "lang", subject(F.col("text"), rule).alias("s"))
    return stored(own.select("doc_id", "source", "lang", "s.topic", "s.tokens"))


def mixed(docs: DataFrame, targets: dict[str, dict] | None = None, rule: Mix = Mix()
          ) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, rate, keep) of each document."""
    own = described(docs, rule)
    out = chosen(own, F.col("doc_id"), F.struct(*MARGINS, "tokens"), fitted(own, targets, rule),
                 "mix", rule)
    return out.select("doc_id", *MARGINS, "tokens", "mix.rate", "mix.keep")


def sampled(docs: DataFrame, targets: dict[str, dict] | None = None, rule: Mix = Mix()
            ) -> DataFrame:
    """The documents that `mixed` keeps, with all their columns."""
    cells, told, mix = fitted(described(docs, rule), targets, rule), *unused(docs, "told", "mix")
    about = F.struct("source", "lang", F.col(f"{told}.topic"), F.col(f"{told}.tokens"))
    out = chosen(docs.withColumn(told, subject(F.col("text"), rule)), F.col("doc_id"), about, cells,
                 mix, rule)
    return out.where(F.col(f"{mix}.keep")).drop(told, mix)


def gaps(sample: DataFrame, targets: dict[str, dict] | None = None, rule: Mix = Mix()
         ) -> DataFrame:
    """(margin, value, asked, expected, got): the share that each value of each margin was to have
    in a result of `mixed`, has by the probabilities, and has in what was kept."""
    cells = stored(cells_of(sample))
    expected, got = F.col("tokens") * F.col("rate"), F.when(F.col("keep"), F.col("tokens"))
    whole = sample.agg(F.sum(expected).alias("expected"), F.sum(got).alias("got")).first()
    out = None
    for margin in MARGINS:
        sums = sample.groupBy(F.col(margin).cast("string").alias("is")).agg(
            (F.sum(expected) / F.lit(float(whole.expected or 1.0))).alias("expected"),
            (F.coalesce(F.sum(got), F.lit(0)) / F.lit(float(whole.got or 1.0))).alias("got"))
        wish = targets_of(cells, margin, (targets or {}).get(margin), rule)
        rows = wish.join(sums, F.col("value").cast("string").eqNullSafe(F.col("is"))).select(
            F.lit(margin).alias("margin"), F.col("value").cast("string").alias("value"), "asked",
            "expected", "got")
        out = rows if out is None else out.unionByName(rows)
    return out

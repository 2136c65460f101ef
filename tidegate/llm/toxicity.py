"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models over hashed terms. A later model also
sees the probabilities of the earlier categories; it is trained with out-of-fold ones, so that it
learns how far they can be trusted on unseen texts. The probability from which a document counts
as having a category is the one of the best F0.5 score among the out-of-fold predictions: a clean
document found toxic weighs more than a toxic one missed. Fitting
sees a bounded sample (`Chain.sample` documents per label value), each fold in its own task;
every document is scored.

Defined cases: a null text is empty; labels that are null or contradict each other for one id
aren't used; a category without a positive or without a negative example in the sample has the
probability 0 or 1 that all examples have; without labels no document is toxic; equal texts get
equal scores, repeated rows among them; an empty table gives no rows (and an empty one to fit on is
one without labels); the answer is a column, and other columns of any name are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm import linear
from tidegate.llm.memory import release
from tidegate.llm.storing import stored


@dataclass(frozen=True)
class Chain:
    """Documents per label value that a fit sees, folds, slots of the hashed terms as a power of
    two, and weight of the penalty."""

    sample: int = 4000
    folds: int = 3
    bits: int = 20
    ridge: float = 0.03
    rounds: int = 40
    seed: int = 29


@dataclass
class Link:
    """One category's model: hashed weights, weights of the earlier probabilities, threshold of
    the score, and the probability from which on it holds."""

    name: str
    weights: np.ndarray
    earlier: np.ndarray
    threshold: float
    cut: float

    def probability(self, rows: linear.Rows, before: np.ndarray) -> np.ndarray:
        score = linear.times(rows, self.weights) + before @ self.earlier - self.threshold
        return linear.sigmoid(score)


def best_cut(probability: np.ndarray, holds: np.ndarray, weight: np.ndarray) -> float:
    """The probability with the best F0.5 score, halfway to the next smaller one."""
    order = np.argsort(-probability, kind="stable")
    p, hit = probability[order], np.cumsum((holds * weight)[order])
    told = np.cumsum(weight[order])
    if not len(p) or hit[-1] == 0:
        return 1.0
    score = np.where(np.append(p[1:] != p[:-1], True), 1.25 * hit / (told + 0.25 * hit[-1]), -1.0)
    at = int(score.argmax())
    return float((p[at] + p[at + 1]) / 2) if at + 1 < len(p) else float(p[at])


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], target: str,
        rule: Chain = Chain()) -> list[Link]:
    """`docs` has id, text and what the categories read, `labels` id and the integer `target`.
    Categories are conditions, predicted in the order given."""
    names = list(categories)
    sample = linear.labelled_sample(docs, labels, target, rule.sample, rule.seed)
    rows = stored(sample.select(
        "id", F.col(target).cast("long").alias("target"),
        *[F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, c in enumerate(categories.values())],
        F.floor(linear.share_of(F.col("id"), rule.seed + 1) * rule.folds).cast("int")
        .alias("fold"),
        linear.feature_column(F.col("text"), linear.term_features, rule.bits).alias("row")))
    share = {r.target: (r["count"]) for r in rows.groupBy("target").count().collect()}
    whole = {r[target]: r["count"] for r in
             labels.where(F.col(target).isNotNull()).groupBy(target).count().collect()}
    weight = F.lit(1.0)
    for value, n in share.items():
        weight = F.when(F.col("target") == value, whole[value] / n).otherwise(weight)
    before = rows.select("id", "fold", "target", weight.alias("weight"))
    chain: list[Link] = []
    for i, name in enumerate(names):
        data = (rows.select("id", F.col(f"c{i}").alias("holds"), "row")
                .join(F.broadcast(before), "id")
                .withColumn("job", F.explode(F.sequence(F.lit(0), F.lit(rule.folds)))))
        earlier = [f"p{j}" for j in range(i)]
        found = stored(data.groupBy("job").applyInArrow(
            _fit_job(i, rule), "job int, id long, p double, holds boolean, weight double, "
            "weights binary, earlier array<double>, threshold double"))
        outside = found.where("weights is null").select("id", F.col("p").alias(f"p{i}"))
        told = found.where("weights is null").select("p", "holds", "weight").toArrow()
        cut = best_cut(*(np.array(told.column(c).to_pylist(), float)
                         for c in ("p", "holds", "weight")))
        for model in found.where("weights is not null").collect():
            chain.append(Link(name, np.frombuffer(model.weights, np.float32),
                              np.array(model.earlier, float), model.threshold, cut))
        before = stored(before.join(outside, "id").select("id", "fold", "target", "weight",
                                                          *earlier, f"p{i}"))
    return chain


def _fit_job(i: int, rule: Chain):
    """Fit without one fold and predict it; the last job fits on all and gives the model."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        release()
        job = key[0].as_py()
        table = table.sort_by([("id", "ascending")])
        rows, holds = linear.rows_of(table.column("row")), np.asarray(table.column("holds"), bool)
        before = np.column_stack([np.zeros((len(holds), 0)), *[
            np.asarray(table.column(f"p{j}"), float)[:, None] for j in range(i)]])
        out = np.asarray(table.column("fold")) == job
        ids, load = (np.asarray(table.column(c))[out] for c in ("id", "weight"))
        del table  # its features are the better part of the memory
        seen, told = holds[~out], linear.take_rows(rows, out)
        rows = linear.take_rows(rows, ~out)
        if seen.all() or not seen.any():
            weights, earlier = np.zeros(1 << rule.bits, np.float32), np.zeros(i)
            threshold = -40.0 if len(seen) and seen.all() else 40.0
        else:
            model = linear.fit_ordinal(rows, seen.astype(int), 2, 1 << rule.bits, rule.ridge,
                                       rule.rounds, before[~out])
            weights = model.weights[:1 << rule.bits].astype(np.float32)
            earlier, threshold = model.weights[1 << rule.bits:], float(model.thresholds[0])
        del rows
        release()
        link = Link("", weights, earlier, threshold, 0.5)
        last = job == rule.folds
        if last:
            ids, p, own, load = [None], [None], [None], [None]
        else:
            p, own = link.probability(told, before[out]), holds[out]
        n = len(ids)
        return pa.table({
            "job": pa.array([job] * n, pa.int32()), "id": pa.array(ids, pa.int64()),
            "p": pa.array(p, pa.float64()), "holds": pa.array(own, pa.bool_()),
            "weight": pa.array(load, pa.float64()),
            "weights": pa.array([weights.tobytes() if last else None] * n, pa.binary()),
            "earlier": pa.array([earlier.tolist()] * n, pa.list_(pa.float64())),
            "threshold": pa.array([threshold] * n, pa.float64())})
    return run


def assess(docs: DataFrame, text: Column, chain: list[Link], rule: Chain = Chain()) -> Column:
    """Struct of each text: `probabilities` in the order of the chain, and `toxic`, whether the
    last category holds."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.arrow_udf("struct<probabilities: array<double>, toxic: boolean>")
    def of(texts: pa.Array) -> pa.Array:
        release()
        links, n = shared.value, len(texts)
        p = np.zeros((n, len(links)))
        for first, rows in linear.feature_rows(texts, linear.term_features, rule.bits):
            here = slice(first, first + len(rows[0]) - 1)
            for i, link in enumerate(links):
                p[here, i] = link.probability(rows, p[here, :i])
        toxic = p[:, -1] >= links[-1].cut if links else np.zeros(n, bool)
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(links))
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(ends, pa.array(p.reshape(-1))), pa.array(toxic)],
            ["probabilities", "toxic"])
    return of(text)

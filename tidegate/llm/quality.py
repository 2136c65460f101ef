"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w . x - threshold[k]): one weight vector over hashed style features is
shared by all grades, the thresholds are in order. A document gets its expected grade and the
probability of at least the grade asked for, by which it is selected. The model is fitted in one
task on a bounded sample (`Ratings.sample` documents per grade); every document is scored.

Defined cases: a null text is empty and gets the score of the features that every text has;
ratings that are null, or that contradict each other for one id, aren't used; without ratings, or
with a single grade, every document has that grade (the lowest without ratings) and is selected;
equal texts get equal scores, repeated rows among them; an empty table gives no rows (and an empty
one to fit on is one without ratings); the score is a column, and other columns of any name are left
alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm import linear
from tidegate.llm.memory import release


@dataclass(frozen=True)
class Ratings:
    """Documents per grade that the fit sees, slots of the hashed features as a power of two,
    weight of the penalty, the least grade to select, and the least probability of it."""

    sample: int = 4000
    bits: int = 18
    ridge: float = 0.01
    at_least: int = 1
    probability: float = 0.5
    seed: int = 17


@dataclass
class Model:
    grades: list[int]  # ascending
    ordinal: linear.Ordinal | None


def fit(docs: DataFrame, ratings: DataFrame, rule: Ratings = Ratings()) -> Model:
    """`docs` has id and text, `ratings` id and grade (an integer)."""
    sample = linear.labelled_sample(docs, ratings, "grade", rule.sample, rule.seed)
    rows = sample.select(F.lit(0).alias("all"), "id", F.col("grade").cast("long").alias("grade"), linear.feature_column(
        F.col("text"), linear.style_features, rule.bits).alias("row"))

    def run(table: pa.Table) -> pa.Table:
        release()
        table = table.sort_by([("id", "ascending")])
        grade = np.asarray(table.column("grade"), np.int64)
        grades, place = np.unique(grade, return_inverse=True)
        features = linear.rows_of(table.column("row"))
        del table  # its features are the better part of the memory
        release()
        model = linear.fit_ordinal(features, place, len(grades), 1 << rule.bits,
                                   rule.ridge) if len(grades) > 1 else None
        return pa.table({
            "grades": pa.array([grades.tolist()], pa.list_(pa.int64())),
            "weights": pa.array([model.weights.astype(np.float32).tobytes() if model else b""]),
            "thresholds": pa.array([model.thresholds.tolist() if model else []],
                                   pa.list_(pa.float64()))})

    found = rows.groupBy("all").applyInArrow(
        run, "grades array<long>, weights binary, thresholds array<double>").collect()
    if not found:
        return Model([0], None)
    got = found[0]
    ordinal = linear.Ordinal(np.frombuffer(got.weights, np.float32), np.array(got.thresholds))
    return Model(list(got.grades), ordinal if len(got.grades) > 1 else None)


def assess(docs: DataFrame, text: Column, model: Model, rule: Ratings = Ratings()) -> Column:
    """Struct (expected_grade, probability, selected) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<expected_grade: double, probability: double, selected: boolean>"

    @F.arrow_udf(kind)
    def of(texts: pa.Array) -> pa.Array:
        release()
        grades, ordinal = np.array(shared.value.grades, float), shared.value.ordinal
        expected, tail = np.full(len(texts), grades[0]), np.ones(len(texts))
        if ordinal is not None:
            for first, rows in linear.feature_rows(texts, linear.style_features, rule.bits):
                tails = ordinal.tails(rows)
                here = slice(first, first + len(tails))
                expected[here] = grades[0] + tails @ np.diff(grades)
                at = int(np.searchsorted(grades, rule.at_least))
                tail[here] = 1.0 if at == 0 else tails[:, at - 1] if at < len(grades) else 0.0
        return pa.StructArray.from_arrays(
            [pa.array(expected), pa.array(tail), pa.array(tail >= rule.probability)],
            ["expected_grade", "probability", "selected"])
    return of(text)

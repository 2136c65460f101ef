"""The fitted operators and the pipeline against held-out labels and plain versions."""

import hashlib
import math
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_tables import plain_groups
from tidegate.llm import linear, mixing, quality, toxicity
from tidegate.llm.queries import LANGUAGES, op9_mixing, rating, with_quality, with_toxicity

SF_DIR = "/root/testdata/sf0.01"
there = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="tables are not there")
ODD = [(1, None), (2, ""), (None, "text"), (3, "x " * 60_000), (3, "again"), (4, "\n")]


def dense(rows, size):
    out = np.zeros((len(rows[0]) - 1, size))
    for r, (a, b) in enumerate(zip(rows[0], rows[0][1:])):
        np.add.at(out[r], rows[1][a:b], rows[2][a:b])
    return out


@pytest.mark.parametrize("features", [linear.style_features, linear.term_features])
def test_features_belong_to_their_own_text(features):
    texts = ["One two two", None, "", "a", "One two two", "é!! Übung übung", "abcdefghij k"]
    together = linear.join_rows([r for _, r in linear.feature_rows(pa.array(texts), features, 10)])
    alone = [dense(linear.join_rows([r for _, r in linear.feature_rows(
        pa.array([t], pa.string()), features, 10)]), 1024)[0] for t in texts]
    assert np.allclose(dense(together, 1024), alone)
    weights = np.random.default_rng(0).normal(size=1024)
    assert np.allclose(linear.times(together, weights), np.array(alone) @ weights)
    assert np.allclose(linear.back(together, weights[:7], 1024), np.array(alone).T @ weights[:7])


def test_ordinal_fit_is_at_the_minimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    grade = np.digitize(x @ [2.0, -1.0, 0.0] + rng.logistic(size=400), [-1.0, 0.5, 2.0])
    rows = (np.arange(401) * 3, np.tile(np.arange(3), 400).astype(np.int32), x.reshape(-1))
    model = linear.fit_ordinal(rows, grade, 4, 3, ridge=0.01, rounds=200)
    assert np.allclose(model.weights, [2.0, -1.0, 0.0], atol=0.4)
    assert (np.diff(model.thresholds) > 0).all()
    assert np.allclose(model.thresholds, [-1.0, 0.5, 2.0], atol=0.4)

    def loss(w, cuts):
        edge = np.concatenate(([-np.inf], cuts, [np.inf]))
        score = x @ w
        return -np.log(linear.sigmoid(edge[grade + 1] - score)
                       - linear.sigmoid(edge[grade] - score)).sum() + 0.005 * (w @ w)
    best = loss(model.weights, model.thresholds)
    for i in range(3):
        for step in (-0.02, 0.02):
            moved = np.eye(3)[i] * step
            assert loss(model.weights + moved, model.thresholds) > best - 1e-2
            assert loss(model.weights, model.thresholds + moved) > best - 1e-2


def test_best_cut_has_the_best_score():
    rng = np.random.default_rng(2)
    p = np.round(rng.random(60), 1)
    holds, weight = rng.random(60) < p, rng.integers(1, 4, 60).astype(float)

    def score(cut):
        told = p >= cut
        return 1.25 * weight[told & holds].sum() / (weight[told].sum() + weight[holds].sum() / 4)
    assert score(toxicity.best_cut(p, holds, weight)) == pytest.approx(
        max(score(c) for c in set(p)))


@there
def test_held_out_quality_and_toxicity(spark):
    docs = spark.read.parquet(f"{SF_DIR}/../sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/../sf0.1/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(2)) == 0
    scored = with_toxicity(with_quality(docs, docs, labels.where(half)), docs, labels.where(half))
    rows = scored.join(labels.where(~half), "doc_id").select(
        "quality", "toxic", "_quality.selected", F.col("_toxicity.toxic").alias("found")).collect()
    good = [r for r in rows if r.quality == 1]
    assert sum(r.selected for r in good) / len(good) > 0.99
    junk = [r for r in rows if r.quality == 0]
    assert sum(not r.selected for r in junk) / len(junk) > 0.95
    clean = [r for r in rows if r.toxic == 0]
    assert sum(not r.found for r in clean) / len(clean) > 0.98
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.found for r in toxic) / len(toxic) > 0.7


@pytest.mark.parametrize("labels", [
    [], [(1, 0, 0)], [(1, 1, 1), (2, 0, 0)], [(1, None, None), (None, 1, 1), (2, 1, 0), (2, 0, 1)]])
def test_few_or_odd_labels(spark, labels):
    docs = spark.createDataFrame([(*r, "en", 1) for r in ODD],
                                 "doc_id long, text string, lang string, grade int")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for with_scores, name in ((with_quality, "_quality"), (with_toxicity, "_toxicity")):
        got = with_scores(docs, docs, frame)
        assert got.count() == len(ODD)
        assert with_scores(docs.limit(0), docs.limit(0), frame).count() == 0
        if not labels:
            flag = "selected" if name == "_quality" else "toxic"
            assert {r[0] for r in got.select(f"{name}.{flag}").collect()} == {name == "_quality"}


def plain_targets(cells, given, rule):
    """By margin: the share asked for of each value, and the tokens it gets in the sample."""
    whole, out = sum(cells.values()), []
    for i, margin in enumerate(mixing.MARGINS):
        sums = Counter()
        for c, n in cells.items():
            sums[c[i]] += n
        own = {v: given[margin].get(v, n / whole) if margin in given else (n / whole) ** rule.evenness
               for v, n in sums.items()}
        asked = {v: s / sum(own.values()) for v, s in own.items()}
        kept, lacking = rule.keep * whole, set()
        while True:
            rest = kept - sum(sums[v] for v in lacking)
            free = sum(s for v, s in asked.items() if v not in lacking)
            share = {v: sums[v] if v in lacking else asked[v] / free * rest for v in asked}
            more = {v for v in asked if v not in lacking and share[v] >= sums[v]}
            if not more:
                break
            lacking |= more
        out.append((asked, share))
    return out


def plain_rates(docs, given, rule):
    """Rates by cell of (source, lang, topic, tokens) rows, and the targets."""
    cells = Counter()
    for *cell, n in docs:
        if n:
            cells[tuple(cell)] += n
    targets = plain_targets(cells, given, rule)
    rate = {c: rule.keep for c in cells}
    for _ in range(3000):
        for i, (_, wish) in enumerate(targets):
            for v, want in wish.items():
                own = [c for c in cells if c[i] == v]
                ones = sum(cells[c] for c in own if rate[c] >= 1)
                free = sum(cells[c] * rate[c] for c in own if rate[c] < 1)
                if want > ones and free > 0:
                    factor = (want - ones) / free
                elif want >= ones:
                    factor = 1.0
                else:
                    factor = want / sum(cells[c] * rate[c] for c in own)
                for c in own:
                    rate[c] *= factor
    return {c: min(1.0, r) for c, r in rate.items()}, targets


def plain_choice(docs, rates, rule, draw):
    """Ids kept of (id, source, lang, topic, tokens) rows."""
    kept, members = [], {}
    for i, *cell, n in docs:
        if n:
            members.setdefault(tuple(cell), []).append((*draw[i], n, i))
        elif draw[i][0] < rule.keep:
            kept.append(i)
    for cell, rows in members.items():
        limit, upto, cut = rates[cell] * sum(n for *_, n, _ in rows), 0, 2.0
        for u, luck, n, _ in sorted(rows, key=lambda r: (r[0], r[2])):
            upto += n
            if upto - n * luck > limit + 1e-9:
                cut = u
                break
        kept += [i for u, *_, i in rows if u < cut]
    return kept


def mix_rows():
    rng = np.random.default_rng(5)
    rows = [(i, rng.choice(["a", "b", "c"], p=[0.7, 0.2, 0.1]), rng.choice(["en", "de", None]),
             " ".join(rng.choice(["apple", "bananas", "cherry", "x"], rng.integers(0, 60))))
            for i in range(600)] + [(None, "a", "en", None), (7, None, None, "apple apple")]
    return [(i, *(None if v is None else str(v) for v in rest)) for i, *rest in rows]


def draws(spark, ids, rule):
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    return {r.id: (r.u, r.luck) for r in frame.select(
        "id", linear.share_of(F.col("id"), rule.seed).alias("u"),
        linear.share_of(F.col("id"), rule.seed + 1).alias("luck")).collect()}


@pytest.mark.parametrize("few", [1 << 24, 0])
def test_rates_meet_the_targets(spark, few, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", few)
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, source string, "
                                 "lang string, text string, topic int, rate double")
    rule = mixing.Mix(keep=0.5, gap=1e-7)
    given = {"lang": {"en": 0.4, "de": 0.35, "xx": 0.1}}
    sample = mixing.stored(mixing.mixed(docs, given, rule))
    got = sample.collect()
    assert len(got) == len(rows)
    rates, targets = plain_rates([(r.source, r.lang, r.topic, r.tokens) for r in got], given, rule)
    for r in got:
        assert r.rate == pytest.approx(rates.get((r.source, r.lang, r.topic), rule.keep), 1e-4) \
            if r.tokens else r.rate == rule.keep
    whole = sum(r.tokens for r in got)
    assert sum(r.tokens * r.rate for r in got) == pytest.approx(rule.keep * whole, 1e-4)
    kept = sorted(r.doc_id for r in got if r.keep and r.doc_id is not None)
    own = {(r.source, r.lang, r.topic): r.rate for r in got if r.tokens}
    assert kept == sorted(i for i in plain_choice(
        [(r.doc_id, r.source, r.lang, r.topic, r.tokens) for r in got], own, rule,
        draws(spark, [r[0] for r in rows], rule)) if i is not None)
    for row in mixing.gaps(sample, given, rule).collect():
        asked, target = targets[mixing.MARGINS.index(row.margin)]
        value = {str(v) if v is not None else None: v for v in asked}[row.value]
        assert row.asked == pytest.approx(asked[value])
        assert row.expected == pytest.approx(target[value] / (rule.keep * whole), rel=1e-3)
    assert mixing.mixed(docs.limit(0), given, rule).count() == 0
    assert mixing.gaps(mixing.mixed(docs.limit(0), given, rule), given, rule).count() == 0


@there
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_sample_has_the_shares_that_can_be_had(spark, sf):
    """The tokens kept, and the shares of all values that don't lack tokens."""
    sample = mixing.stored(op9_mixing(spark, f"{SF_DIR}/../{sf}"))
    assert sample.where("rate < 0 or rate > 1").count() == 0
    found = sample.agg(F.sum("tokens"), F.sum(F.when(F.col("keep"), F.col("tokens")))).first()
    assert found[1] == pytest.approx(0.8 * found[0], rel=1e-2 if sf == "sf0.1" else 5e-2)
    cells = Counter()
    for r in sample.where("tokens > 0").collect():
        cells[r.source, r.lang, r.topic] += r.tokens
    targets = plain_targets(cells, {"lang": LANGUAGES}, mixing.Mix())
    for row in mixing.gaps(sample, {"lang": LANGUAGES}).collect():
        wish = targets[mixing.MARGINS.index(row.margin)][1]
        share = {str(v): n / sum(wish.values()) for v, n in wish.items()}[row.value]
        assert row.expected == pytest.approx(share, rel=5e-3)
        if share > 0.04 and sf == "sf0.1":  # a document of the smaller one is a tenth of a source
            assert row.got == pytest.approx(share, rel=3e-2)


@pytest.mark.parametrize("few", [1 << 24, 0])
@pytest.mark.parametrize("rows", [[("a", "en"), ("b", "de")], [("a", "en")], []])
def test_contradicting_or_no_margins(spark, rows, few, monkeypatch):
    """Where no sample can meet all margins the caller is told and no cell is lost."""
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", few)
    docs = spark.createDataFrame([(i, s, l, "x y z " * (i + 1)) for i, (s, l) in enumerate(rows)],
                                 "doc_id long, source string, lang string, text string")
    rule, given = mixing.Mix(keep=0.3, patience=3), {"lang": {"en": 0.9, "de": 0.1}}
    if len(rows) == 2:
        with pytest.warns(UserWarning, match="contradict"):
            got = mixing.mixed(docs, given, rule).collect()
    else:
        got = mixing.mixed(docs, given, rule).collect()
    assert len(got) == len(rows) and all(0 < r.rate <= 1 for r in got)


def test_topic_is_the_most_frequent_long_word(spark):
    texts = ["apple apple pears", "Pears apple PEARS", "x y z", "", None, "apple pears " * 40_000]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r[0] for r in frame.select(mixing.subject(F.col("text"))).collect()]
    assert [r.tokens for r in got] == [3, 3, 3, 0, 0, 80_000]
    assert got[2].topic == got[3].topic == got[4].topic == 0
    assert got[0].topic != 0 and got[5].topic in (got[0].topic, got[1].topic)


@there
def test_pipeline_stage_by_stage(spark):
    """Each stage's rows against a plain version of its decision."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    before = {r.doc_id: r for r in docs.collect()}

    def texts(rows):
        return pa.array([r.text for r in rows.values()], pa.string())

    def run(number, source):
        name, stage = corpus_pipeline.STAGES[number]
        frame = spark.createDataFrame(list(source.values()), docs.schema)
        return stage(spark, frame, sf_dir)

    model = quality.fit(docs.select(F.col("doc_id").alias("id"), "text"), rating(labels))
    rows = linear.join_rows([r for _, r in linear.feature_rows(
        texts(before), linear.style_features, quality.Ratings().bits)])
    score = dense(rows, 1 << quality.Ratings().bits) @ model.ordinal.weights
    kept = [i for i, s in zip(before, score) if 1 / (1 + math.exp(model.ordinal.thresholds[0] - s))
            >= 0.5]
    got = run(0, before)
    assert got.columns == docs.columns
    after = {r.doc_id: r for r in got.collect()}
    assert sorted(after) == sorted(kept) and 0 < len(kept) < len(before)

    clean = {r.doc_id: r for r in run(1, after).collect()}
    assert set(clean) <= set(after)

    first = {r.doc_id: r for r in run(2, clean).collect()}
    groups = plain_groups([(i, r.text) for i, r in clean.items()])
    assert sorted(first) == sorted({c if n else i for i, n, c in groups})

    chosen = {r.doc_id: r for r in run(3, first).collect()}
    told = mixing.mixed(spark.createDataFrame(list(first.values()), docs.schema),
                        {"lang": LANGUAGES}).collect()
    rule = mixing.Mix()
    own = {(r.source, r.lang, r.topic): r.rate for r in told if r.tokens}
    assert sorted(chosen) == sorted(plain_choice(
        [(r.doc_id, r.source, r.lang, r.topic, r.tokens) for r in told], own, rule,
        draws(spark, list(first), rule)))
    assert sum(len(r.text.split()) for r in chosen.values()) > 0.75 * sum(
        len(r.text.split()) for r in first.values())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in run(4, chosen).collect():
        ids = library.encode(chosen[row.doc_id].text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@there
def test_pipeline_stages_keep_columns_of_all_names(spark):
    """A column for each name that a stage uses on the way."""
    names = ["node", "_id", "copy", "quality", "toxicity", "_quality", "_toxicity", "told", "mix",
             "cell", "fit", "topic", "tokens", "rate", "keep", "_mix_rate", "draw", "Copy_", "id"]
    rows = [(*r, "en", "s", None, *range(len(names))) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                 "n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_DIR.replace("0.01", "0.001"))
        assert got.columns == docs.columns
        assert all(r[5:] == tuple(range(len(names))) for r in got.collect())


def test_pipeline_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, node int"
    docs = spark.createDataFrame([(*r, None, None, None, 5) for r in ODD], schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, frame, SF_DIR.replace("0.01", "0.001"))
            assert name == "bpe" or got.columns == docs.columns
            assert got.count() <= frame.count()

import random

import pytest
from pyspark.sql import functions as F

from tidegate import SampleSettings
from tidegate.operators import report


@pytest.mark.parametrize("hot_rows", [10**6, 9])
def test_floor_ranks(spark, hot_rows):
    rng = random.Random(1)
    groups = {"whole": list(range(1, 101)), "one": [7],
              "ties": [3] * 60 + [rng.randrange(100) for _ in range(41)]}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs],
                               "mode string, latency double").repartition(3)
    got = {r["mode"]: r for r in report.latency_ranks(df, ["mode"], hot_rows=hot_rows).collect()}
    for group, values in groups.items():
        values.sort()
        for name, p in report.LATENCY_RANKS:
            assert got[group][name] == values[int(len(values) * p)]
        assert got[group]["max_latency"] == values[-1] and got[group]["n"] == len(values)
    assert got["whole"]["p50"] == 51


@pytest.mark.parametrize("hot_rows", [10**6, 9])
def test_systematic_sample(spark, hot_rows):
    rng = random.Random(2)
    calls = [(w, i, rng.random() < 0.8) for w in range(3) for i in range(200 - 90 * w)]
    df = spark.createDataFrame(calls, "worker_id long, started long, ok boolean")
    got = {}
    for r in report.latency_sample(df, ["worker_id"], ["started"], SampleSettings(10, 7),
                                   hot_rows).collect():
        got.setdefault(r["worker_id"], set()).add(r["started"])
    for w in range(3):
        kept = [i for k, (_, i, ok) in enumerate([c for c in calls if c[0] == w], 1)
                if k % 10 == 0 and ok][:7]
        assert got.get(w, set()) == set(kept)


def test_load_summary(spark):
    rows = [("unary", True, 1, 1, 0), ("unary", False, 1, 0, 1), ("batch", True, 100, 100, 0),
            ("batch", False, 100, 60, 40), ("stream", True, 50, 30, 20), ("stream", False, 9, 0, 0)]
    df = spark.createDataFrame(
        rows, "mode string, ok boolean, n_events int, accepted_count int, rejected_count int")
    got = {r["mode"]: r for r in report.load_summary(df, F.max(F.lit(2.0))).collect()}
    assert (got["unary"]["ok_events"], got["unary"]["error_events"]) == (1, 1)
    assert (got["batch"]["ok_events"], got["batch"]["error_events"]) == (100, 100)
    assert (got["stream"]["ok_events"], got["stream"]["error_events"]) == (30, 29)
    assert got["batch"]["events_per_sec"] == 50.0 and got["batch"]["error_pct"] == 50.0
    assert got["unary"]["rpcs_per_sec"] == 0.5
    empty = spark.createDataFrame(
        [("stream", True, 0, 0, 0)],
        "mode string, ok boolean, n_events int, accepted_count int, rejected_count int")
    assert report.load_summary(empty, F.max(F.lit(0.0))).first()["error_pct"] == 0.0


def test_runs_are_joined_by_name(spark):
    one = spark.createDataFrame([("a", 1.0)], "mode string, latency double")
    two = spark.createDataFrame([(3.0, "a")], "latency double, mode string")
    both = report.combine_runs([one, two])
    assert report.latency_ranks(both, ["mode"]).first()["max_latency"] == 3.0


def test_approximate_ranks(spark):
    df = spark.range(1, 10001).select(F.lit("a").alias("mode"), F.col("id").cast("double")
                                      .alias("latency"))
    exact = report.latency_ranks(df, ["mode"]).first()
    near = report.approx_latency_ranks(df, ["mode"]).first()
    assert near["n"] == exact["n"] and near["max_latency"] == exact["max_latency"]
    assert all(abs(near[p] - exact[p]) <= 2 for p, _ in report.LATENCY_RANKS)


def test_counter_set(spark):
    outcomes = spark.createDataFrame([(5, 2)], "accepted_total long, rejected_total long")
    failures = spark.createDataFrame(
        [(1, 3, 3)], "publish_errors long, async_errors long, dead_lettered long")
    waiting = spark.createDataFrame([], "tenant_id string, waiting long")
    got = {r["counter"]: r["value"]
           for r in report.counter_set([outcomes], waiting, failures).collect()}
    assert got == {"events_accepted_total": 5, "events_rejected_total": 2, "worker_queue_depth": 0,
                   "worker_publish_errors_total": 1, "kafka_async_errors_total": 3,
                   "dlq_persisted_total": 3}


def test_a_null_group_keeps_its_ranks(spark):
    samples = spark.createDataFrame(
        [(g, float(i)) for g in ("a", None) for i in range(1, 101)], "mode string, latency double")
    got = {r["mode"]: r["p50"] for r in report.latency_ranks(samples, ["mode"]).collect()}
    assert got == {"a": 51.0, None: 51.0}

import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators.running import find_slices, running_total


def check(spark, rows, schema, order, hot_rows, weight=None):
    df = spark.createDataFrame(rows, schema).repartition(4)
    slices = find_slices(df, ["g"], order, hot_rows)
    got = running_total(df, ["g"], order, "t", weight, slices)
    plain = running_total(df, ["g"], order, "t", weight, hot_rows=10**9)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    return slices, got


def test_no_hot_group_means_plain_window(spark):
    df = spark.range(20).select((F.col("id") % 4).alias("g"), F.col("id").alias("a"))
    slices = find_slices(df, ["g"], ["a"], 100)
    assert slices.levels == ()


def test_hot_group_is_cut(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(30)}", rng.randrange(10**12), i,
             rng.randrange(5)) for i in range(3000)]
    slices, _ = check(spark, rows, "g string, a long, seq long, w long", ["a", "seq"], 40)
    assert len(slices.levels) >= 1
    check(spark, rows, "g string, a long, seq long, w long", ["a", "seq"], 40, F.col("w"))


def test_one_instant_is_cut_by_the_next_column(spark):
    # Most rows share one arrival, and one row lies far away.
    rows = [("hot", 7, i, 1) for i in range(1500)] + [("hot", 10**15, 0, 1), ("cold", 1, 1, 1)]
    slices, got = check(spark, rows, "g string, a long, seq long, w long", ["a", "seq"], 50)
    assert len(slices.levels) >= 2


def test_neighbouring_large_numbers_are_told_apart(spark):
    # 2**61 + k for small k is one double, so ranges must be formed on exact numbers.
    base, rng = 2**61, random.Random(2)
    rows = [("hot", base + rng.randrange(3), s, 1) for s in rng.sample(range(10**6), 900)]
    check(spark, rows, "g string, a long, seq long, w long", ["a", "seq"], 30)


def test_ranges_stay_small(spark):
    rng = random.Random(3)
    rows = [("hot", int(rng.expovariate(1) ** 9 * 1000), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, a long, seq long")
    from tidegate.operators.running import _into_slices
    sizes = (_into_slices(df, find_slices(df, ["g"], ["a", "seq"], 100))
             .groupBy("_slice").count().agg(F.max("count")).first()[0])
    assert sizes <= 100


def test_a_frequent_value_is_parted_soon(spark):
    rng = random.Random(6)
    rows = [("hot", 7.25 if i % 3 else rng.random() * 1000, i) for i in range(3000)]
    slices, _ = check(spark, rows, "g string, a double, seq long", ["a", "seq"], 100)
    assert len(slices.levels) <= 6


def test_null_and_double_order(spark):
    rng = random.Random(4)
    rows = [("hot", None if i == 5 else rng.random() * 100, i) for i in range(500)]
    check(spark, rows, "g string, a double, seq long", ["a", "seq"], 20)
    odd = {5: float("nan"), 6: float("inf"), 7: float("-inf")}
    rows = [("hot", odd.get(i, rng.random()), i) for i in range(500)]
    slices, cut = check(spark, rows, "g string, a double, seq long", ["a", "seq"], 20)
    assert slices.levels
    assert cut.where("isnan(a)").first()["t"] == 500


def test_nulls_before_one_value(spark):
    rng = random.Random(5)
    rows = [("hot", rng.choice([None, 7]), s) for s in rng.sample(range(10**6), 300)]
    check(spark, rows, "g string, a long, seq long", ["a", "seq"], 20)


def test_dates_and_times_as_order(spark):
    df = spark.range(400).select(
        F.lit("hot").alias("g"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7)
                                            .cast("int")).alias("d"),
        F.timestamp_seconds(F.col("id") * 3).alias("ts"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ntz"))
    for order in (["d", "ts"], ["ntz"]):
        cut = running_total(df, ["g"], order, "t", hot_rows=25)
        plain = running_total(df, ["g"], order, "t")
        assert sorted(cut.collect(), key=str) == sorted(plain.collect(), key=str)


def test_text_order_is_refused(spark):
    df = spark.createDataFrame([("a", "b")], "g string, a string")
    with pytest.raises(TypeError):
        find_slices(df, ["g"], ["a"])


def test_null_key_is_cut(spark):
    rows = [(None, i, i) for i in range(200)] + [("x", i, i) for i in range(200)]
    check(spark, rows, "g string, a long, seq long", ["a", "seq"], 30)
    frame = spark.createDataFrame(rows[:100], "g string, a long, seq long")
    assert find_slices(frame, ["g"], ["a", "seq"], 10).levels


@pytest.mark.parametrize("values", [
    [None, 7], [-2**63, 2**63 - 1], [-2**63, None, 0, 2**63 - 1]])
def test_partly_null_and_wide_columns_are_cut(spark, values):
    rows = [("x", values[i % len(values)], i) for i in range(100)]
    check(spark, rows, "g string, a long, seq long", ["a", "seq"], 10)
    frame = spark.createDataFrame(rows, "g string, a long, seq long")
    assert find_slices(frame, ["g"], ["a", "seq"], 10).levels


def test_infinite_and_missing_numbers_are_cut(spark):
    values = [float("nan"), float("inf"), float("-inf"), None, 1.0]
    for some in (values, values[:2], values[:4], values[3:], [values[0], 1.0]):
        rows = [("x", some[i % len(some)], i) for i in range(100)]
        check(spark, rows, "g string, a double, seq long", ["a", "seq"], 10)


def test_no_window_gathers_a_hot_group(spark):
    df = spark.range(1000).select(F.lit("hot").alias("g"), F.col("id").alias("a"), "id")
    plan = running_total(df, ["g"], ["a"], "t", hot_rows=50)._jdf.queryExecution().executedPlan()
    windows = [line for line in plan.toString().splitlines() if "- Window [" in line]
    rows = [line for line in windows if "row_number" in line]
    assert len(windows) == 2 and len(rows) == 1
    # The rows are partitioned by group and range; only the ranges' totals meet per group.
    assert "_slice" in rows[0].split("windowspecdefinition")[1].split("ASC")[0]

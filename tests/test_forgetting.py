"""State that forgets tenants by the clock."""

import pytest
from pyspark.sql import functions as F

from tidegate import QuotaPolicy
from tidegate.operators.quota import with_quota_keys
from tidegate.plans import streams
from tidegate.streaming.admission import start_quota
from tidegate.streaming.flush import run_to_end, size_options
from tidegate.streaming.forgetting import HEARD_SCHEMA, Forgetting

SCHEMA = "tenant_id string, timestamp long, seq long"
USED = "quota_tenant string, window_idx long, used long"


def drained(spark, path, policy, batches, forgetting):
    """`batches` of tenant names, one file and micro-batch each: sequence numbers admitted."""
    numbers = iter(range(1000))
    for names in batches:
        rows = [(name, next(numbers) * 1000) for name in names]
        spark.createDataFrame([(n, s, s) for n, s in rows], SCHEMA).coalesce(1).write.mode(
            "append").parquet(f"{path}/in")
    events = with_quota_keys(spark.readStream.schema(SCHEMA).options(**size_options("parquet"))
                             .parquet(f"{path}/in"), policy)
    run_to_end(start_quota(events, policy, ["timestamp", "seq"], f"{path}/out", f"{path}/state",
                           f"{path}/cp", forgetting=forgetting, drain=True))
    out = spark.read.parquet(f"{path}/out").where("accepted").collect()
    return sorted(r.seq // 1000 for r in out)


@pytest.mark.parametrize(("lease", "admitted"), [
    (1, range(12)),  # a: 3 at first, 5 when it is back, and not its last one
    (4, range(11))])  # a: the fourth token of its first lease is lost
def test_no_second_quota(spark, tmp_path, lease, admitted):
    policy = QuotaPolicy(limit=8, lease=lease, window_sec=10_000)
    ticks = iter(range(1, 9))
    batches = [["a", "a", "a"], ["b"], ["b"], ["c", "c", "a", "a", "a", "a", "a", "a"]]
    got = drained(spark, tmp_path, policy, batches,
                  Forgetting(1.5, lambda: next(ticks) * 1_000_000))
    assert got == list(admitted)
    sweeps = spark.read.parquet(f"{tmp_path}/out-sweeps").orderBy("batch_id").collect()
    assert [(r.tenants_held, r.ledger_rows, r.tenants_forgotten, r.tenants_back)
            for r in sweeps] == [(1, 1, 0, 0), (2, 2, 0, 0), (1, 1, 1, 0), (3, 3, 0, 1)]
    used = spark.read.parquet(f"{tmp_path}/state/used/1").where("quota_tenant = 'a'").first()
    assert used.used == 8


def test_a_sweep_that_comes_again_replaces_itself(spark, tmp_path):
    before = {"heard": spark.createDataFrame([("a", 0), ("b", 50)], HEARD_SCHEMA),
              "used": spark.createDataFrame([("a", 1, 3), ("a", 2, 4), ("b", 1, 2)], USED)}
    path, clock = str(tmp_path / "forgotten"), iter([100, 200, 300])
    forgetting = Forgetting(60e-6, lambda: next(clock), parts=3)

    def swept(names, before, batch_id):
        batch = spark.createDataFrame([(n,) for n in names], "quota_tenant string")
        after, told, _ = forgetting.sweep(batch, before, path, batch_id)
        return (sorted(map(tuple, after["used"].collect())),
                sorted(map(tuple, told["heard"].collect())))

    assert swept(["c"], before, 0) == ([("b", 1, 2)], [("b", 50), ("c", 100)])
    # Later by the clock, with the same number: b goes as well, and nothing is archived twice.
    assert swept(["c"], before, 0) == ([], [("c", 200)])
    archive = spark.read.parquet(path)
    assert sorted(archive.select("quota_tenant", "used").collect()) == [
        ("a", 3), ("a", 4), ("b", 2)]
    state = {"heard": spark.createDataFrame([("c", 200)], HEARD_SCHEMA),
             "used": spark.createDataFrame([("c", 1, 1)], USED)}
    assert swept(["a", "new"], state, 1) == (
        [("a", 1, 3), ("a", 2, 4)], [("a", 300), ("new", 300)])


def test_wrong_settings_are_refused():
    with pytest.raises(ValueError):
        Forgetting(0)
    with pytest.raises(ValueError):
        Forgetting(1, parts=0)


def test_the_largest_number_lands(spark):
    top = 2**62
    frame = spark.createDataFrame([(i, i) for i in range(3)] + [(top, 3)], "stamp long, seq long")
    landings, found = streams.Landings(frame, F.col("stamp"), 8), []

    def start():
        return (spark.readStream.schema(landings.schema).options(**landings.OPTIONS)
                .parquet(landings.path).writeStream
                .foreachBatch(lambda batch, _: found.extend(r.seq for r in batch.collect()))
                .option("checkpointLocation", landings.path + "-cp")
                .trigger(availableNow=True).start())

    landings.each(start)
    assert sorted(found) == [0, 1, 2, 3]

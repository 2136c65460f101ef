"""State that holds the tenants heard of lately by the clock, and no others.

A tenant not heard of for `idle_sec` is forgotten: the tokens it holds are lost, and what it used
leaves the state for an archive, a folder per micro-batch, which is at the same time the report of
who was forgotten. When the tenant comes back, its use comes back from there before anything is
charged, so that no window gives its quota twice. The archive is dealt into `parts` by tenant, and a
micro-batch reads the parts of the tenants that the state does not know, none if it knows all.

The clock is asked once per micro-batch, on the driver. A micro-batch that comes again starts from
the state before it and replaces its folder, whatever the clock says by then.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators.running import broadcast_if_small

HEARD_SCHEMA = "quota_tenant string, heard_us long"
ARCHIVE_SCHEMA = "quota_tenant string, window_idx long, used long, batch_id long, part int"
SWEEP_SCHEMA = ("batch_id long, clock_us long, tenants_held long, ledger_rows long, "
                "tenants_forgotten long, tenants_back long")


def wall_clock() -> int:
    """Microseconds since 1970."""
    return time.time_ns() // 1000


class Forgetting:
    """Idle limit in seconds by `clock` (microseconds), and the parts of the archive."""

    def __init__(self, idle_sec: float, clock: Callable[[], int] = wall_clock,
                 parts: int = 16) -> None:
        if idle_sec <= 0 or parts <= 0:
            raise ValueError("idle_sec and parts must be positive")
        self.idle_us, self.clock, self.parts = int(idle_sec * 1_000_000), clock, parts

    def _archived(self, spark: SparkSession, path: str, back: DataFrame,
                  batch_id: int) -> DataFrame:
        """What the tenants in `back` had used when they were forgotten before this batch."""
        parts = [r.part for r in back.select("part").distinct().collect()] if batch_id else []
        if not parts:
            return spark.createDataFrame([], ARCHIVE_SCHEMA)
        rows = spark.read.schema(ARCHIVE_SCHEMA).parquet(path)
        rows = rows.where((F.col("batch_id") < batch_id) & F.col("part").isin(parts))
        return rows.join(broadcast_if_small(back), ["quota_tenant", "part"], "left_semi")

    def sweep(self, batch: DataFrame, before: dict[str, DataFrame], path: str,
              batch_id: int) -> tuple[dict[str, DataFrame], dict[str, DataFrame], int]:
        """The state before the batch without the tenants that are forgotten now, and with those
        that come back; whom the state has heard of after the batch, who is forgotten and who is
        back; and the time by the clock."""
        spark, now = batch.sparkSession, self.clock()
        here = batch.select("quota_tenant").distinct()
        heard, used = before["heard"], before["used"]
        idle = F.col("heard_us") < now - self.idle_us
        gone = heard.where(idle).join(here, "quota_tenant", "left_anti").select("quota_tenant")
        part = F.pmod(F.xxhash64("quota_tenant"), F.lit(self.parts)).cast("int")
        (used.join(gone, "quota_tenant", "left_semi")
         .select("quota_tenant", "window_idx", "used", part.alias("part")).repartition("part")
         .write.mode("overwrite").partitionBy("part").parquet(f"{path}/batch_id={batch_id}"))
        unknown = here.join(heard, "quota_tenant", "left_anti").withColumn("part", part)
        back = self._archived(spark, path, unknown, batch_id)
        after = {
            **before,
            "used": used.join(gone, "quota_tenant", "left_anti").unionByName(
                back.groupBy("quota_tenant", "window_idx").agg(F.max("used").alias("used")))}
        if "tokens" in before:
            after["tokens"] = before["tokens"].join(
                heard.where(idle), "quota_tenant", "left_anti")
        kept = (heard.where(~idle).unionByName(here.withColumn("heard_us", F.lit(now).cast("long")))
                .groupBy("quota_tenant").agg(F.max("heard_us").alias("heard_us")))
        return after, {"heard": kept, "gone": gone,
                       "back": back.select("quota_tenant").distinct()}, now


def sweep_report(spark: SparkSession, batch_id: int, now: int, held: DataFrame, used: DataFrame,
                 gone: DataFrame, back: DataFrame) -> DataFrame:
    """One row: what the state holds after a micro-batch, and what its sweep did."""
    counted = {"tenants_held": held, "ledger_rows": used, "tenants_forgotten": gone,
               "tenants_back": back}
    names = [rows.select(F.lit(name).alias("name")) for name, rows in counted.items()]
    row = reduce(DataFrame.unionByName, names).agg(
        *[F.count_if(F.col("name") == name).alias(name) for name in counted])
    return row.select(F.lit(batch_id).cast("long").alias("batch_id"),
                      F.lit(now).cast("long").alias("clock_us"), *counted)

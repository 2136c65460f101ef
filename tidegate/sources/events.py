"""Events as single rows, in batches and on client streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate import schema as S
from tidegate.functions.keys import batch_tenant, quota_tenant, with_event_defaults


def read_events(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """Events from files, with the defaults for absent fields."""
    return with_event_defaults(
        spark.read.format(format).schema(S.EVENT).options(**options).load(path))


def read_event_stream(spark: SparkSession, path: str, format: str = "parquet",
                      **options) -> DataFrame:
    """The same as a stream; `maxFilesPerTrigger` bounds a micro-batch."""
    return with_event_defaults(
        spark.readStream.format(format).schema(S.EVENT).options(**options).load(path))


def batch_requests(batches: DataFrame) -> DataFrame:
    """What the quota needs of batches (`tenant_id`, `events`): the size `n` and the tenant
    charged. The events themselves are dropped."""
    first = F.get(F.col("events"), F.lit(0))["tenant_id"]
    return batches.withColumns({
        "n": F.coalesce(F.array_size("events"), F.lit(0)),
        "quota_tenant": quota_tenant(batch_tenant(F.coalesce("tenant_id", F.lit("")), first)),
    }).drop("events")


def unpack_batches(batches: DataFrame, keep: list[str] | None = None,
                   accepted: str | None = None) -> DataFrame:
    """The events of batches with their position from 0, next to the columns to `keep`
    (default `batch_id`); with `accepted`, only the prefix of that length."""
    keep = ["batch_id"] if keep is None else keep
    events = F.col("events") if accepted is None else F.slice(
        "events", F.lit(1), F.col(accepted))
    rows = batches.select(*keep, F.posexplode(events).alias("position", "event"))
    return with_event_defaults(rows.select(*keep, "position", "event.*"))

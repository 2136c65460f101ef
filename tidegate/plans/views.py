"""Views that shape the given tables as events, batches, deliveries and calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.functions.keys import (batch_tenant, nanos_to_timestamp, ntz_to_micros,
                                     ntz_to_nanos, quota_tenant)
from tidegate.operators.delivery import to_records
from tidegate.operators.running import running_total
from tidegate.settings import TopicSettings

MONTH_SEC = 2_592_000
BATCH_EVENTS = 1000
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
DELIVERY_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
CALL_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tenant_of(number: Column) -> Column:
    """Ten tenants, one of them unnamed."""
    return F.when(number % 10 == 9, "").otherwise(F.concat(F.lit("tenant-"), number % 10))


def event_columns(events: DataFrame) -> DataFrame:
    """The `events` table, or a stream of it, as events; `seq` breaks ties of arrival."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_id").alias("seq"),
        tenant_of(F.col("user_id")).alias("tenant_id"),
        F.col("props").alias("payload"),
        ntz_to_nanos(F.col("ts")).alias("timestamp"),
        F.col("user_id").alias("stream_id"),
        "event_type")


def misdated(events: DataFrame) -> DataFrame:
    """Events of which every 97th of one tenant is stamped a century ahead."""
    ahead = (F.col("tenant_id") == "tenant-3") & (F.col("seq") % 97 == 0)
    return events.withColumn("timestamp", F.when(
        ahead, F.col("timestamp") + 36_500 * 86_400 * 10**9).otherwise(F.col("timestamp")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(table(spark, sf_dir, "events"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _supplier_tenant(supplier: Column) -> Column:
    return F.concat(F.lit("tenant-"), supplier % 10)


def _order_columns() -> list[Column]:
    return [
        F.col("o_orderkey").alias("batch_id"),
        tenant_of(F.col("o_custkey")).alias("tenant_id"),
        ntz_to_nanos(F.col("o_orderdate")).alias("timestamp"),
    ]


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as batches of the events their lines stand for; an order without lines is an
    empty batch. An order of more than `BATCH_EVENTS` lines comes in several parts, so that no
    list grows with the data."""
    lines = running_total(_lines(spark, sf_dir), ["l_orderkey"], LINE_ORDER, "_no")
    event = F.struct(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("event_id"),
        _supplier_tenant(F.col("l_suppkey")).alias("tenant_id"),
        F.col("l_returnflag").alias("payload"),
        ntz_to_nanos(F.col("l_shipdate")).alias("timestamp"))
    lists = lines.groupBy("l_orderkey", F.expr(f"(_no - 1) div {BATCH_EVENTS}").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_no", event.alias("event")))).alias("lines"))
    orders = table(spark, sf_dir, "orders").select(*_order_columns())
    return orders.join(lists, orders.batch_id == lists.l_orderkey, "left").select(
        "batch_id", F.coalesce("part", F.lit(0)).alias("part"), "tenant_id", "timestamp",
        F.coalesce(F.transform("lines", lambda x: x["event"]), F.array()).alias("events"))


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quota needs of `batches`, counted without building the lists."""
    line = F.struct(*LINE_ORDER)
    sizes = _lines(spark, sf_dir).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.min(line)["l_suppkey"].alias("supplier"))
    orders = table(spark, sf_dir, "orders").select(*_order_columns())
    return orders.join(sizes, orders.batch_id == sizes.l_orderkey, "left").select(
        "batch_id", "tenant_id", "timestamp", F.coalesce("n", F.lit(0)).alias("n"),
        quota_tenant(batch_tenant(F.col("tenant_id"), _supplier_tenant(F.col("supplier"))))
        .alias("quota_tenant"),
        F.expr(f"(timestamp div 1000000000) div {MONTH_SEC}").alias("window_idx"))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_columns(_lines(spark, sf_dir))


def delivery_columns(lines: DataFrame) -> DataFrame:
    """Order lines, or a stream of them, as deliveries; many keys come more than once."""
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("event_id"),
        _supplier_tenant(F.col("l_suppkey")).alias("tenant_id"),
        F.col("l_partkey").cast("string").alias("payload"),
        ntz_to_nanos(F.col("l_shipdate")).alias("timestamp"),
        *DELIVERY_ORDER)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as calls of a load run."""
    flag, lines = F.col("l_returnflag"), F.col("l_quantity").cast("int")
    rejected = F.least(lines, F.col("l_linenumber") - 1)
    return _lines(spark, sf_dir).select(
        F.when(flag == "A", "unary").when(flag == "N", "batch").otherwise("stream").alias("mode"),
        (F.col("l_suppkey") % 10).alias("worker_id"),
        F.col("l_extendedprice").alias("latency"),
        (F.col("l_discount") < 0.09).alias("ok"),
        lines.alias("n_events"), (lines - rejected).alias("accepted_count"),
        rejected.alias("rejected_count"),
        ntz_to_micros(F.col("l_shipdate")).alias("started_us"),
        *CALL_ORDER)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded events; every 97th value cannot be decoded, every 5th topic is missing."""
    ev = events(spark, sf_dir)
    stamped = ev.withColumn("time", nanos_to_timestamp(F.col("timestamp")))
    encoded = to_records(
        stamped.withColumn("topic", F.when(F.col("seq") % 5 == 0, "").otherwise("events")),
        F.col("topic"), time=F.col("time"))
    bad = F.col("key").cast("string").cast("long") % 97 == 0
    return encoded.withColumn("value", F.when(bad, F.lit(b"\xff\xff\xff")).otherwise(F.col("value")))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose delivery failed, with the number of their publishing batch."""
    ev = events(spark, sf_dir).where("event_type = 'error'")
    return ev.select(
        "seq", F.expr(f"seq div {TopicSettings().publish_batch}").alias("batch_id"),
        nanos_to_timestamp(F.col("timestamp")).alias("failed_at"),
        F.lit("events").alias("topic"), F.col("event_id").alias("key"),
        F.lit("delivery\tfailed").alias("error"), F.col("payload").cast("binary").alias("value"))


def wide_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as events whose key is the whole text; most are too long."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("event_id"),
        F.col("lang").alias("tenant_id"), F.col("text").alias("payload"),
        F.lit(0).cast("long").alias("timestamp"))

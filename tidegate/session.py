"""Session settings and scratch space shared by the batch and streaming operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "tidegate", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators assume; everything else stays Spark's default."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (`spark.checkpoint.dir`).

    Only a local session without that setting and without a checkpoint folder gets one of
    ours, which is a local folder. On a cluster the setting is required.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidegate-"))
    return (configured or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tidegate/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small intermediate result with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def move_path(spark: SparkSession, path: str, to: str) -> bool:
    """Move a folder, if it is there, and tell whether it was."""
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return False
    _, target = _hadoop(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(at, target):
        raise OSError(f"cannot move {path} to {to}")
    return True


def order_files(spark: SparkSession, path: str) -> int:
    """Give the files of a folder times that follow their names, the order in which a stream
    reads them; returns their number. For file systems that keep such times."""
    files, at = _hadoop(spark, path)
    found = sorted((str(f.getPath()), f.getPath(), f.getModificationTime())
                   for f in files.listStatus(at) if f.getPath().getName().startswith("part-"))
    last = max((time for *_, time in found), default=0)
    for number, (_, file, _) in enumerate(found):
        files.setTimes(file, last + 10 * (number - len(found)), -1)
    return len(found)
